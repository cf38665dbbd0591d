"""Expected results as ANSI SQL over the driver tables, written independently of the Spark plans.

Sessions are derived here event by event, pairs by plain ranks and evaluation by plain
joins; nothing is folded, salted or ranged, so agreement checks those steps.
"""

from __future__ import annotations

from ..functions.privacy import hmac_pads
from ..functions.text import STOP_WORDS
from ..operators.evaluation import default_thresholds
from ..schemas import FEATURE_COLS
from .fixture import BROWSERS, SYSTEMS, TOPICS

_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def _rnd(expr: str, digits: int) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _by_device(table: dict[str, list[str]]) -> str:
    arms = " ".join(f"WHEN '{d}' THEN {_list(v)}[eid % {len(v)} + 1]" for d, v in table.items())
    return f"CASE device_type {arms} END"


def _hmac(expr: str, salt: str) -> str:
    inner, outer = hmac_pads(salt)
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({expr}))))"


def _clean(expr: str) -> str:
    return f"trim(regexp_replace(regexp_replace(coalesce({expr}, ''), '\\|+', ' ', 'g'), '[{_SPACE}]+', ' ', 'g'))"


def _marked_words(expr: str) -> str:
    marked = f"regexp_replace(lower(coalesce({expr}, '')), '[^\\p{{L}}\\p{{N}}{_SPACE}]+', ' | ', 'g')"
    words = f"string_split_regex({marked}, '[{_SPACE}]+')"
    keep = f"regexp_full_match(w, '\\p{{L}}{{3,}}') AND NOT list_contains({_list(STOP_WORDS)}, w)"
    joined = f"array_to_string(list_transform({words}, lambda w: CASE WHEN {keep} THEN w ELSE '|' END), ' ')"
    return f"string_split_regex({joined}, '[ |]*\\|[ |]*')"


def _phrases(source: str, key: str, text: str, name: str) -> str:
    """CTEs giving distinct phrases per key in first-seen order as list ``p``."""
    return f"""
{name}_split AS (SELECT {key}, {_marked_words(text)} AS parts FROM {source}),
{name}_each AS (SELECT {key}, unnest(parts) AS phrase, generate_subscripts(parts, 1) AS i FROM {name}_split),
{name}_first AS (SELECT {key}, phrase, min(i) AS i FROM {name}_each WHERE phrase <> '' GROUP BY ALL),
{name}_some AS (SELECT {key}, list(phrase ORDER BY i) AS p FROM {name}_first GROUP BY ALL),
{name} AS (SELECT s.{key}, coalesce(p, []) AS p FROM {name}_split s LEFT JOIN {name}_some USING ({key}))"""


_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, needs: list[str], body: str) -> None:
    _CTES[name] = (needs, body)


_cte("ev", [], """
ev AS (SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS us,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
_cte("numbered", ["ev"], f"""
opened AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= 21600000000
                          THEN 0 ELSE 1 END AS opens FROM ev),
numbered AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY us, event_id
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sno,
                    {_list(TOPICS)}[(user_id + k % 4) % 15 + 1] AS category FROM opened)""")
_cte("hours", ["ev"], """
user_total AS (SELECT user_id, count(*) AS total FROM ev GROUP BY ALL),
hour_count AS (SELECT user_id, hour(ts) AS hour, count(*) AS n FROM ev GROUP BY ALL),
hour_share AS (SELECT t.user_id, h.hour, coalesce(c.n, 0) / t.total AS share
               FROM user_total t CROSS JOIN (SELECT range AS hour FROM range(24)) h
               LEFT JOIN hour_count c ON c.user_id = t.user_id AND c.hour = h.hour),
hours AS (SELECT user_id, list(share ORDER BY hour) AS active_hours_profile FROM hour_share GROUP BY ALL)""")
_cte("sessions", ["numbered", "hours"], f"""
grouped AS (
  SELECT user_id, sno, min(event_id) AS eid, min(ts) AS session_start,
         10 + 3 * CAST(sum(k) AS BIGINT) AS session_duration_s, count(*) AS pages_visited,
         count(*) FILTER (event_type = 'click') AS click_count,
         {_rnd("least(greatest(max(k) / 99.0::DOUBLE, 0.05::DOUBLE), 1.0::DOUBLE)", 4)} AS scroll_depth_avg,
         list_sort(list(DISTINCT category)) AS content_categories,
         array_to_string(list_sort(list(DISTINCT event_type || ' ' || replace(category, '_', ' '))), ' | ')
           AS interaction_text
  FROM numbered GROUP BY user_id, sno),
typed AS (
  SELECT *, CASE WHEN user_id % 5 = 0 THEN 'mobile'
                 WHEN user_id % 5 = 1 THEN CASE WHEN eid % 17 < 10 THEN 'mobile' ELSE 'desktop' END
                 WHEN eid % 20 < 10 THEN 'mobile' WHEN eid % 20 < 17 THEN 'desktop' ELSE 'tablet' END AS device_type,
         'user_' || user_id AS real_user_id,
         (user_id % 250 + 1) || '.' || CASE WHEN eid % 10 < 6 THEN user_id % 7 WHEN eid % 10 < 9 THEN 100 ELSE 200 END
           AS ip_prefix FROM grouped),
named AS (SELECT *, {_by_device(SYSTEMS)} AS os, {_by_device(BROWSERS)} AS browser FROM typed),
sessions AS MATERIALIZED (
  SELECT user_id || '-' || sno AS session_id, real_user_id, sha256(real_user_id) AS user_id_hash, device_type, os,
         browser, ip_prefix, sha256(ip_prefix) AS ip_prefix_hash,
         sha256(real_user_id || '|' || device_type || '|' || os || '|' || ((sno - 1) // 3)) AS device_fingerprint_hash,
         sha256(browser || ' ' || os) AS user_agent_hash, session_start, session_duration_s, pages_visited,
         click_count, scroll_depth_avg, content_categories, interaction_text, active_hours_profile,
         {_rnd("click_count / greatest(session_duration_s, 1)", 6)} AS click_rate,
         {_rnd("pages_visited / (greatest(session_duration_s, 1) / 60.0::DOUBLE)", 4)} AS pages_per_minute,
         CASE device_type WHEN 'mobile' THEN 0 WHEN 'desktop' THEN 1 WHEN 'tablet' THEN 2 ELSE -1 END
           AS device_type_enc,
         CAST(device_type = 'mobile' AS INTEGER) AS is_mobile, CAST(hour(session_start) AS INTEGER) AS hour_of_day,
         CAST(isodow(session_start) - 1 AS INTEGER) AS day_of_week,
         CAST(len(content_categories) AS INTEGER) AS n_content_categories, eid AS first_event_id
  FROM named JOIN hours USING (user_id))""")
_cte("positives", ["sessions"], """
pos_keys AS (SELECT user_id_hash, session_id, draw, md5('pos|42|' || draw || '|' || session_id) AS h
             FROM sessions CROSS JOIN (SELECT CAST(range AS INTEGER) AS draw FROM range(3))),
positives AS (SELECT arg_min(session_id, h) AS session_id_a, arg_max(session_id, h) AS session_id_b, 1 AS label, draw
              FROM pos_keys GROUP BY user_id_hash, draw HAVING count(*) >= 2)""")
_cte("negatives", ["sessions"], """
per_user AS (SELECT user_id_hash, count(*) AS n FROM sessions GROUP BY ALL),
totals AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (n >= 2) AS users,
                  sum(n::DOUBLE * n::DOUBLE) AS same FROM per_user),
sizes AS (SELECT CAST(floor(users * 3 * 1.5::DOUBLE) AS BIGINT) AS wanted, greatest(1, total // 2048) AS groups,
                 1 - same / (total::DOUBLE * total::DOUBLE) AS accepted, total FROM totals),
planned AS (SELECT wanted, groups,
                   CAST(ceil(1.25 * wanted / (greatest(total - groups, 1) * accepted)) AS BIGINT) + 1 AS draws FROM sizes),
neg_keys AS (SELECT session_id, user_id_hash, CAST(d.range AS INTEGER) AS draw, groups,
                    md5('neg|42|' || d.range || '|' || session_id) AS h
             FROM sessions CROSS JOIN planned CROSS JOIN range(100) d WHERE d.range < draws),
neighbours AS (SELECT session_id AS session_id_a, user_id_hash AS user_a, draw,
                      lead(session_id) OVER g AS session_id_b, lead(user_id_hash) OVER g AS user_b
               FROM neg_keys
               WINDOW g AS (PARTITION BY draw, ('0x' || substr(h, 1, 8))::BIGINT % groups ORDER BY h, session_id)),
negatives AS (SELECT session_id_a, session_id_b, 0 AS label, draw FROM neighbours WHERE user_a <> user_b
              ORDER BY md5('pick|42|' || draw || '|' || session_id_a || '|' || session_id_b), session_id_a, session_id_b
              LIMIT (SELECT wanted FROM planned))""")
_cte("pairs", ["positives", "negatives"], """
pairs AS MATERIALIZED (SELECT * FROM positives UNION ALL SELECT * FROM negatives)""")
_cte("split_pairs", ["pairs"], """
keyed_pairs AS (SELECT *, draw || '|' || session_id_a || '|' || session_id_b AS ends FROM pairs),
ranked_pairs AS (
  SELECT session_id_a, session_id_b, label, draw,
         row_number() OVER (ORDER BY md5('pair|42|' || ends), label, draw, session_id_a, session_id_b) AS pair_id,
         row_number() OVER (PARTITION BY label ORDER BY md5('split|42|' || ends), draw, session_id_a, session_id_b) AS r,
         count(*) OVER (PARTITION BY label) AS n FROM keyed_pairs),
split_pairs AS (SELECT session_id_a, session_id_b, label, draw, pair_id,
                       CASE WHEN r <= floor(n * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split
                FROM ranked_pairs)""")
_HOURS_APART = "abs(epoch_us(a.session_start) - epoch_us(b.session_start)) / 3.6e9"
_SHARED = "len(list_intersect(a.content_categories, b.content_categories))"
_UNION = "len(list_distinct(list_concat(a.content_categories, b.content_categories)))"
_cte("features", ["split_pairs"], f"""
features AS MATERIALIZED (
  SELECT p.*,
    CAST(a.ip_prefix_hash = b.ip_prefix_hash AS INTEGER) AS ip_prefix_match,
    CAST(a.device_fingerprint_hash = b.device_fingerprint_hash AS INTEGER) AS device_fp_match,
    CAST(a.device_type = b.device_type AS INTEGER) AS device_type_same,
    CASE WHEN a.device_type = b.device_type THEN 3 + a.device_type_enc
         ELSE a.device_type_enc + b.device_type_enc - 1 END AS device_pair_enc,
    CAST(a.device_type <> b.device_type AS INTEGER) AS is_cross_device,
    {_rnd(_HOURS_APART, 2)} AS time_delta_hours,
    {_rnd(f"({_HOURS_APART}) / 24.0::DOUBLE", 3)} AS time_delta_days,
    CAST(a.hour_of_day = b.hour_of_day AS INTEGER) AS same_hour_of_day,
    CAST(a.day_of_week = b.day_of_week AS INTEGER) AS same_day_of_week,
    {_rnd("list_cosine_similarity(a.active_hours_profile, b.active_hours_profile)", 6)} AS active_hours_cosine,
    abs(a.click_rate - b.click_rate) AS click_rate_diff,
    abs(a.scroll_depth_avg - b.scroll_depth_avg) AS scroll_depth_diff,
    abs(a.pages_per_minute - b.pages_per_minute) AS pages_diff,
    least(a.session_duration_s, b.session_duration_s)::DOUBLE
      / greatest(a.session_duration_s, b.session_duration_s, 1)::DOUBLE AS duration_ratio,
    {_rnd(f"{_SHARED} / {_UNION}", 6)} AS content_jaccard,
    CAST({_SHARED} AS INTEGER) AS n_shared_categories
  FROM split_pairs p JOIN sessions a ON a.session_id = p.session_id_a JOIN sessions b ON b.session_id = p.session_id_b)""")
_cte("scored", ["features"], """
scored AS MATERIALIZED (
  SELECT *, CAST(probability >= 0.5 AS INTEGER) AS predicted_label FROM (
    SELECT pair_id, session_id_a, session_id_b, label,
           (6 * ip_prefix_match + device_fp_match + same_hour_of_day + 3 * least(n_shared_categories, 1))
             / 11.0::DOUBLE AS probability, split FROM features))""")
_cte("outcome", ["scored"], """
outcome AS (SELECT count(*) FILTER (label = 1 AND predicted_label = 1) AS tp,
                   count(*) FILTER (label = 0 AND predicted_label = 1) AS fp,
                   count(*) FILTER (label = 0 AND predicted_label = 0) AS tn,
                   count(*) FILTER (label = 1 AND predicted_label = 0) AS fn FROM scored)""")
_cte("points", ["scored"], """
points AS (SELECT t.probability AS threshold, count(*) FILTER (s.label = 1) AS tp, count(*) FILTER (s.label = 0) AS fp,
                  (SELECT count(*) FROM scored WHERE label = 1) AS p, (SELECT count(*) FROM scored WHERE label = 0) AS n
           FROM (SELECT DISTINCT probability FROM scored) t JOIN scored s ON s.probability >= t.probability
           GROUP BY t.probability)""")
_cte("enriched", ["sessions"], f"""{_phrases("sessions", "session_id", "interaction_text", "words")},
enriched AS MATERIALIZED (
  SELECT s.*, {_clean("interaction_text")} AS clean_text, array_to_string(w.p, ' ') AS keywords,
         CAST(len(w.p) AS INTEGER) AS n_keywords, e.label AS segment_id
  FROM sessions s JOIN words w USING (session_id)
  JOIN embeddings e ON e.vec_id = s.first_event_id % (SELECT count(*) FROM embeddings))""")
_cte("terms", ["enriched"], """
each_term AS (
  SELECT segment_id, 'keyword' AS kind, unnest(string_split(keywords, ' ')) AS term FROM enriched
  UNION ALL SELECT segment_id, 'category', unnest(content_categories) FROM enriched),
terms AS (SELECT * FROM (
    SELECT segment_id, kind, term, count(*) AS n,
           CAST(row_number() OVER (PARTITION BY segment_id, kind ORDER BY count(*) DESC, term) AS INTEGER) AS rank
    FROM each_term WHERE term <> '' GROUP BY segment_id, kind, term)
  WHERE rank <= CASE kind WHEN 'keyword' THEN 8 ELSE 5 END)""")
_cte("sizes_by_segment", ["enriched"], f"""
sizes_by_segment AS (
  SELECT segment_id, count(*) AS n_sessions,
         {_rnd("100.0::DOUBLE * count(*) / (SELECT count(*) FROM enriched)", 2)} AS pct_of_total,
         {_rnd("avg(scroll_depth_avg)", 3)} AS avg_scroll_depth,
         {_rnd("avg(session_duration_s)", 1)} AS avg_session_duration_s,
         {_rnd("avg(click_count)", 1)} AS avg_click_count, {_rnd("avg(pages_visited)", 1)} AS avg_pages_visited,
         {_rnd("100.0::DOUBLE * count(*) FILTER (device_type = 'mobile') / count(*)", 1)} AS pct_mobile
  FROM enriched GROUP BY segment_id)""")
_cte("devices_by_segment", ["enriched"], f"""
devices_by_segment AS (
  SELECT segment_id, device_type, count(*) AS n_sessions,
         {_rnd("count(*) / sum(count(*)) OVER (PARTITION BY segment_id)", 3)} AS share
  FROM enriched GROUP BY segment_id, device_type)""")
_TITLE = "upper(substr(w, 1, 1)) || lower(substr(w, 2))"
_cte("profiles", ["terms", "sizes_by_segment", "devices_by_segment"], f"""
term_lists AS (SELECT segment_id, list(term ORDER BY rank) FILTER (kind = 'keyword') AS words,
                      list(term ORDER BY rank) FILTER (kind = 'category') AS cats FROM terms GROUP BY segment_id),
device_lists AS (SELECT segment_id, string_agg(device_type || ':' || CAST(floor(share * 1000 + 0.5) AS BIGINT), ','
                                               ORDER BY device_type) AS device_distribution
                 FROM devices_by_segment GROUP BY segment_id),
profiles AS MATERIALIZED (
  SELECT segment_id,
         array_to_string(list_transform(list_concat(cats[1:2], words[1:1]), lambda x: array_to_string(
           list_transform(string_split(replace(x, '_', ' '), ' '), lambda w: {_TITLE}), ' ')), ' & ') AS segment_label,
         n_sessions, pct_of_total, array_to_string(words, ', ') AS top_keywords,
         array_to_string(cats, ', ') AS top_categories, device_distribution, avg_scroll_depth,
         avg_session_duration_s, avg_click_count, avg_pages_visited, pct_mobile
  FROM sizes_by_segment JOIN term_lists USING (segment_id) JOIN device_lists USING (segment_id))""")


def _with(needs: list[str], select: str) -> str:
    """The select preceded by the CTEs it needs, each once, dependencies first."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for other in _CTES[name][0]:
            add(other)
        done.append(name)

    for name in needs:
        add(name)
    bodies = ",".join(_CTES[n][1] for n in done)
    return f"WITH {bodies.strip()}\n{select}" if bodies else select


def _sample(columns: str, source: str, tag: str, seed: int, n: int, key: str = "session_id") -> str:
    return f"SELECT {columns} FROM {source} ORDER BY md5('{tag}|{seed}|' || {key}), {key} LIMIT {n}"


def _metrics(tp: str = "tp", fp: str = "fp", tn: str = "tn", fn: str = "fn") -> str:
    def safe(a: str, b: str) -> str:
        return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b})::DOUBLE END"

    return ", ".join(
        [
            _rnd(safe(f"{tp} + {tn}", f"{tp} + {fp} + {tn} + {fn}"), 4) + " AS accuracy",
            _rnd(safe(tp, f"{tp} + {fp}"), 4) + " AS precision",
            _rnd(safe(tp, f"{tp} + {fn}"), 4) + " AS recall",
            _rnd(safe(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"), 4) + " AS f1",
        ]
    )


_STAMP = "strftime(session_start, '%Y-%m-%d %H:%M:%S.%f') AS session_start"
_JSON_LIST = "'[' || array_to_string(list_transform(content_categories, lambda c: '\"' || c || '\"'), ',') || ']'"


def _short(expr: str) -> str:
    return f"CASE WHEN length({expr}) > 40 THEN substr({expr}, 1, 40) || '…' ELSE {expr} END"


def _violations(source: str, rules: dict[str, str], key: str) -> str:
    parts = [f"SELECT '{r}' AS rule, count(*) FILTER ({c}) AS violations FROM {source}" for r, c in rules.items()]
    parts.append(f"SELECT '{key}_duplicate', count(*) - count(DISTINCT {key}) FROM {source}")
    return " UNION ALL ".join(parts)


def _report_row(name: str, precision: str, recall: str, f1: str, support: str) -> str:
    return (
        f"SELECT '{name}' AS class_name, {_rnd(precision, 6)} AS precision, {_rnd(recall, 6)} AS recall, "
        f"{_rnd(f1, 6)} AS f1, {support} AS support FROM rates"
    )


_RATES = """, rates AS (
  SELECT *, tn / greatest(tn + fn, 1)::DOUBLE AS p0, tn / greatest(tn + fp, 1)::DOUBLE AS r0,
         2 * tn / greatest(2 * tn + fn + fp, 1)::DOUBLE AS f0, tp / greatest(tp + fp, 1)::DOUBLE AS p1,
         tp / greatest(tp + fn, 1)::DOUBLE AS r1, 2 * tp / greatest(2 * tp + fp + fn, 1)::DOUBLE AS f1_,
         tn + fp AS n0, tp + fn AS n1, tp + fp + tn + fn AS n, (tp + tn) / (tp + fp + tn + fn)::DOUBLE AS acc
  FROM outcome)"""


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sessions"] = _with(["sessions"], f"""
SELECT session_id, real_user_id, user_id_hash, device_type, os, browser, ip_prefix, ip_prefix_hash,
       device_fingerprint_hash, user_agent_hash, {_STAMP}, session_duration_s, pages_visited, click_count,
       scroll_depth_avg, array_to_string(content_categories, ',') AS content_categories, interaction_text
FROM sessions""")
    q["session_sample"] = _with(["sessions"], _sample("session_id, user_id_hash, device_type", "sessions", "sample", 42, 5000))
    q["bounded_scan"] = _with(
        ["sessions"], _sample("session_id, device_type, session_duration_s", "sessions", "scan", 0, 20000)
    )
    q["csv_round_trip"] = _with(["sessions"],
        f"SELECT session_id, device_type, {_STAMP}, session_duration_s, scroll_depth_avg, "
        "array_to_string(content_categories, ',') AS content_categories, "
        "CAST(len(active_hours_profile) AS INTEGER) AS n_hours, "
        "interaction_text || chr(10) || 'back\\slash' || chr(13) AS interaction_text FROM sessions")
    q["table_round_trip"] = _with(["sessions"], "SELECT device_type, count(*) AS n_sessions FROM sessions GROUP BY ALL")
    q["session_quality"] = _with(["sessions"], _violations("sessions", {
        "session_id_null": "session_id IS NULL",
        "user_id_hash_null": "user_id_hash IS NULL",
        "device_type_null": "device_type IS NULL",
        "device_type_unknown": "device_type NOT IN ('mobile', 'desktop', 'tablet')",
        "scroll_out_of_range": "scroll_depth_avg NOT BETWEEN 0 AND 1",
        "categories_invalid": "content_categories IS NULL OR len(content_categories) < 1",
        "hours_not_24": "active_hours_profile IS NULL OR len(active_hours_profile) <> 24",
        "hours_not_normalised": "abs(list_sum(active_hours_profile) - 1) >= 1e-6",
    }, "session_id"))
    q["pair_quality"] = _with(["scored"], _violations("scored", {
        "ends_null": "session_id_a IS NULL OR session_id_b IS NULL",
        "label_invalid": "label IS NULL OR label NOT IN (0, 1)",
        "probability_out_of_range": "probability NOT BETWEEN 0 AND 1",
        "split_unknown": "split NOT IN ('train', 'test')",
    }, "pair_id"))
    q["enriched_quality"] = _with(["enriched"], _violations("enriched", {
        "session_id_null": "session_id IS NULL",
        "clean_text_null": "clean_text IS NULL",
        "clean_text_has_pipe": "contains(clean_text, '|')",
        "n_keywords_negative": "n_keywords < 0",
        "segment_id_null": "segment_id IS NULL",
    }, "session_id"))
    q["segment_quality"] = _with(["profiles"], _violations("profiles", {
        "segment_id_null": "segment_id IS NULL",
        "size_not_positive": "coalesce(n_sessions, 0) <= 0",
        "pct_mobile_out_of_range": "pct_mobile NOT BETWEEN 0 AND 100",
    }, "segment_id"))

    q["session_features"] = _with(["sessions"], """
SELECT session_id, click_rate, pages_per_minute, device_type_enc, is_mobile, hour_of_day, day_of_week,
       n_content_categories FROM sessions""")
    q["activity_hours"] = _with(["hours"], f"""
SELECT user_id, CAST(hour AS INTEGER) AS hour, {_rnd("share", 6)} AS share FROM hour_share""")
    q["session_hours"] = _with(["sessions"], f"""
SELECT session_id, CAST(i - 1 AS INTEGER) AS hour, {_rnd("share", 6)} AS share FROM (
  SELECT session_id, unnest(active_hours_profile) AS share, generate_subscripts(active_hours_profile, 1) AS i
  FROM sessions)""")
    q["document_clean_text"] = f"SELECT doc_id, {_clean('text')} AS clean_text FROM documents"
    q["network_prefix"] = """
SELECT event_id, ip[1] AS p1, ip[1] || '.' || ip[2] AS p2, ip[1] || '.' || ip[2] || '.' || ip[3] AS p3
FROM (SELECT event_id, string_split((user_id % 250 + 1) || '.' || event_id % 256 || '.' || (user_id * 7) % 256
                                    || '.' || (event_id % 254 + 1), '.') AS ip FROM events)"""
    q["json_edges"] = _with(["sessions"], f"""
SELECT session_id, {_JSON_LIST} AS categories_json, CAST(len(content_categories) AS INTEGER) AS n_back,
       {_short("interaction_text")} AS short_text,
       least(greatest(session_duration_s, 60), 300) AS clipped_duration FROM sessions""")
    q["agent_hash"] = _with(["sessions"], """
SELECT browser, os, count(*) AS n_sessions, sha256(browser || ' ' || os) AS agent_hash FROM sessions GROUP BY ALL""")
    q["keyed_hash"] = _with(["sessions"], f"""
SELECT session_id, {_hmac("ip_prefix", "pepper")} AS prefix_hmac,
       {_hmac("CAST(session_duration_s AS VARCHAR)", "s" * 80)} AS duration_hmac FROM sessions""")
    q["document_hash"] = f"SELECT doc_id, {_hmac('text', 'salt')} AS text_hmac FROM documents"
    q["anonymised_sessions"] = _with(["sessions"], "SELECT session_id, user_id_hash, " + ", ".join(
        f"{_hmac(c, 'pepper')} AS {c}"
        for c in ("ip_prefix", "user_agent_hash", "device_fingerprint_hash", "ip_prefix_hash")) + ", device_type FROM sessions")
    q["hash_audit"] = _with(["sessions"], """
SELECT device_type, count(*) AS n_valid, count(*) FILTER (device_type = 'mobile') AS n_tampered_valid,
       count(*) AS n_sessions FROM sessions GROUP BY device_type""")

    q["eligible_users"] = _with(["sessions"], """
SELECT user_id_hash, count(*) AS n_sessions FROM sessions GROUP BY user_id_hash HAVING count(*) >= 2""")
    q["positive_pairs"] = _with(["positives"], "SELECT * FROM positives")
    q["negative_pairs"] = _with(["negatives"], "SELECT * FROM negatives")
    q["negative_shortfall"] = _with(["negatives"], "SELECT (SELECT wanted FROM planned) AS wanted, count(*) AS found FROM negatives")
    q["checked_pairs"] = _with(["pairs"], """
SELECT session_id_a, CASE WHEN label = 0 AND draw = 0 THEN 'no such ' || session_id_b ELSE session_id_b END AS session_id_b,
       label, draw, label = 0 AND draw = 0 AS unknown_session,
       a.scroll_depth_avg > 0.9 OR (b.scroll_depth_avg > 0.9 AND NOT (label = 0 AND draw = 0)) AS ambiguous_session
FROM pairs JOIN sessions a ON a.session_id = session_id_a JOIN sessions b ON b.session_id = session_id_b""")
    q["sampled_pairs"] = _with(["pairs"], "SELECT * FROM pairs")
    q["numbered_split"] = _with(["split_pairs"], "SELECT * FROM split_pairs")
    q["pair_features"] = _with(
        ["features"], f"SELECT session_id_a, session_id_b, label, draw, {', '.join(FEATURE_COLS)} FROM features"
    )
    q["pair_integrity"] = _with(["pairs"], """
SELECT count(*) AS n_pairs,
       count(*) FILTER (session_id_a IN (SELECT session_id FROM sessions WHERE device_type = 'tablet')) AS missing_a,
       count(*) FILTER (session_id_b IN (SELECT session_id FROM sessions WHERE device_type = 'tablet')) AS missing_b,
       CAST(0 AS BIGINT) AS ambiguous_ends FROM pairs""")

    q["identity_pairs"] = _with(["scored"], """
SELECT pair_id, session_id_a, session_id_b, label, probability, predicted_label, split FROM scored""")
    q["classification_metrics"] = _with(["outcome"], f"""
SELECT {_metrics()}, 0.5::DOUBLE AS threshold, tp + fp + tn + fn AS n_test FROM outcome""")
    q["roc_auc"] = _with(["scored"], f"""
SELECT {_rnd("sum(CASE WHEN a.probability > b.probability THEN 1.0 WHEN a.probability = b.probability THEN 0.5 ELSE 0 END) / count(*)::DOUBLE", 6)}
         AS roc_auc, (SELECT count(*) FROM scored WHERE label = 1) AS n_pos,
       (SELECT count(*) FROM scored WHERE label = 0) AS n_neg
FROM (SELECT probability FROM scored WHERE label = 1) a CROSS JOIN (SELECT probability FROM scored WHERE label = 0) b""")
    q["confusion_matrix"] = _with(["scored"], """
SELECT l.v AS label, p.v AS predicted_label, count(s.label) AS n_pairs
FROM (VALUES (0), (1)) l(v) CROSS JOIN (VALUES (0), (1)) p(v)
LEFT JOIN scored s ON s.label = l.v AND s.predicted_label = p.v GROUP BY ALL""")
    report = [
        _report_row("Different User", "p0", "r0", "f0", "n0"),
        _report_row("Same User", "p1", "r1", "f1_", "n1"),
        _report_row("accuracy", "acc", "acc", "acc", "n"),
        _report_row("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1_) / 2", "n"),
        _report_row("weighted avg", "(p0 * n0 + p1 * n1) / n", "(r0 * n0 + r1 * n1) / n", "(f0 * n0 + f1_ * n1) / n", "n"),
    ]
    q["classification_report"] = _with(["outcome"], _RATES + " " + " UNION ALL ".join(report))
    q["roc_points"] = _with(["points"], f"""
SELECT {_rnd("threshold", 6)} AS threshold, {_rnd("fp / n", 6)} AS fpr, {_rnd("tp / p", 6)} AS tpr FROM points
UNION ALL SELECT NULL, 0.0, 0.0""")
    q["precision_recall_points"] = _with(["points"], f"""
SELECT {_rnd("threshold", 6)} AS threshold, {_rnd("tp / (tp + fp)", 6)} AS precision, {_rnd("tp / p", 6)} AS recall
FROM points UNION ALL SELECT NULL, 1.0, 0.0""")
    levels = ", ".join(f"({t!r}::DOUBLE)" for t in default_thresholds())
    q["threshold_sweep"] = _with(["scored"], f"""
, counted AS (SELECT t.v AS v, count(*) FILTER (label = 1 AND probability >= t.v) AS tp,
                     count(*) FILTER (label = 0 AND probability >= t.v) AS fp,
                     count(*) FILTER (label = 0 AND probability < t.v) AS tn,
                     count(*) FILTER (label = 1 AND probability < t.v) AS fn
              FROM (VALUES {levels}) t(v) CROSS JOIN scored GROUP BY t.v)
SELECT round(v, 2) AS threshold, {_metrics()} FROM counted""")
    q["identity_graph_stats"] = _with(["scored"], f"""
, matched AS MATERIALIZED (
  SELECT m.*, a.device_type <> b.device_type AS crosses
  FROM (SELECT * FROM scored WHERE predicted_label = 1) m
  JOIN sessions a ON a.session_id = m.session_id_a JOIN sessions b ON b.session_id = m.session_id_b)
SELECT (SELECT count(*) FROM scored) AS total_pairs_evaluated, count(*) AS matched_pairs,
       {_rnd("100.0::DOUBLE * count(*) / (SELECT count(*) FROM scored)", 2)} AS match_rate_pct,
       (SELECT count(*) FROM (SELECT session_id_a FROM matched UNION SELECT session_id_b FROM matched))
         AS sessions_in_identity_graph,
       count(*) FILTER (crosses) AS cross_device_matches,
       {_rnd("avg(probability)", 4)} AS avg_match_probability FROM matched""")

    q["model_scored_pairs"] = _with(["split_pairs"], """
SELECT split, label, count(*) AS n_pairs, count(*) AS n_probabilities, count(*) AS n_decisions
FROM split_pairs GROUP BY split, label""")
    for name, model in (("random_forest", "random_forest"), ("boosted_trees", "xgboost"), ("logistic_regression",) * 2):
        q[name] = _with(["split_pairs"], f"""
SELECT '{model}' AS model, 0.5::DOUBLE AS threshold, count(*) FILTER (split = 'train') AS n_train,
       count(*) FILTER (split = 'test') AS n_test, count(*) AS n_pairs, count(*) AS n_probabilities,
       count(*) AS n_decisions, true AS metrics_agree FROM split_pairs""")
    # one importance for each feature of the contract, whatever the data
    q["feature_importance"] = f"""
SELECT CAST({len(FEATURE_COLS)} AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_negative, true AS makes_one,
       true AS top_are_the_largest"""
    q["saved_model_scores"] = _with(["pairs"], """
SELECT count(*) AS n_scored, count(*) AS n_same, count(*) AS n_decisions
FROM (SELECT DISTINCT session_id_a, session_id_b FROM pairs)""")
    q["embedding_norms"] = """
SELECT doc_id, CAST(384 AS INTEGER) AS n_dims,
       CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}]') THEN 1.0 ELSE 0.0 END AS squared_length FROM documents"""
    q["kmeans_segments"] = """
SELECT CAST(10 AS BIGINT) AS n_segments, count(*) AS n_vectors, true AS inertia_agrees FROM embeddings"""
    q["kmeans_search"] = "SELECT CAST(range AS INTEGER) AS k, true AS scored, true AS best_agrees FROM range(6, 13)"
    q["segmentation_run"] = _with(["sessions"], """
SELECT count(*) AS n_sessions, true AS segments_in_range, true AS one_row_each, true AS all_labelled,
       true AS shares_make_all FROM sessions""")
    q["run_summary"] = _with(["sessions"], """
SELECT count(*) AS sessions, count(DISTINCT user_id_hash) AS unique_users, true AS accuracy_valid,
       true AS roc_auc_valid, true AS segments_in_range FROM sessions""")
    ranged = ["accuracy", "precision", "recall", "f1", "roc_auc", *[f"fi_{c}" for c in FEATURE_COLS]]
    found = ["n_clusters", "inertia", "silhouette_final", *[f"silhouette_k{k}" for k in range(6, 13)]]
    q["run_metrics"] = _with(["split_pairs"], f"""
SELECT 'run_identity' AS run, unnest({_list(ranged)}) AS metric, NULL::DOUBLE AS value, true AS in_range
UNION ALL SELECT 'run_segmentation', unnest({_list(found)}), NULL, true
UNION ALL SELECT 'run_identity', 'threshold', 0.5, true
UNION ALL SELECT 'run_identity', 'n_' || split, count(*)::DOUBLE, true FROM split_pairs GROUP BY split
UNION ALL SELECT 'run_segmentation', 'n_sessions', count(*)::DOUBLE, true FROM sessions""")
    q["kmeans_assignment"] = """
SELECT count(*) AS n_assigned, count(DISTINCT vec_id) AS n_vectors, CAST(10 AS BIGINT) AS n_segments,
       CAST(0 AS BIGINT) AS n_misplaced FROM embeddings"""
    q["document_keywords"] = "WITH " + _phrases("documents", "doc_id", "text", "words").strip() + """
SELECT doc_id, array_to_string(p, ';') AS keywords, CAST(len(p) AS INTEGER) AS n_keywords FROM words"""
    q["session_text"] = _with(["enriched"], "SELECT session_id, clean_text, keywords, n_keywords FROM enriched")
    q["unit_vectors"] = f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, {_rnd("x / norm", 6)} AS value FROM (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i, sqrt(list_dot_product(v, v)) AS norm FROM (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v FROM embeddings))"""

    q["vector_subsample"] = _with(
        ["sessions"], _sample("session_id, device_type", "sessions", "subsample", 42, 5000)
    )
    q["silhouette"] = """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
parts AS (SELECT label, unnest(x) AS value, generate_subscripts(x, 1) AS i FROM v),
sums AS (SELECT label, list(s ORDER BY i) AS y FROM (SELECT label, i, sum(value) AS s FROM parts GROUP BY label, i) GROUP BY label),
sizes AS (SELECT label, count(*) AS n, sum(list_inner_product(x, x)) AS psi FROM v GROUP BY label),
distance AS (
  SELECT vec_id, v.label, s.label AS other, n,
    list_inner_product(x, x) + psi / n - 2 * list_inner_product(x, y) / n AS d
  FROM v CROSS JOIN sums s JOIN sizes z ON z.label = s.label),
point AS (
  SELECT vec_id, max(n) FILTER (label = other) AS n, max(d * n / greatest(n - 1, 1)) FILTER (label = other) AS inside,
    min(d) FILTER (label <> other) AS outside
  FROM distance GROUP BY vec_id)
SELECT CAST(floor(avg(CASE WHEN n = 1 THEN 0 ELSE (outside - inside) / greatest(inside, outside) END) * 1e6 + 0.5) AS BIGINT)
         AS silhouette_millionths, count(*) AS n_points FROM point"""
    q["segment_terms"] = _with(["terms"], "SELECT segment_id, kind, term, n, rank FROM terms")
    q["segment_devices"] = _with(["devices_by_segment"], "SELECT * FROM devices_by_segment")
    q["segment_sizes"] = _with(["sizes_by_segment"], "SELECT * FROM sizes_by_segment")
    q["segment_profiles"] = _with(["profiles"], "SELECT * FROM profiles")

    q["device_summary"] = _with(["sessions"], f"""
SELECT device_type, count(*) AS n_sessions, {_rnd("avg(session_duration_s)", 1)} AS avg_duration_s,
       {_rnd("avg(scroll_depth_avg)", 3)} AS avg_scroll_depth, {_rnd("avg(click_count)", 1)} AS avg_clicks
FROM sessions GROUP BY device_type""")
    q["cross_device_users"] = _with(["sessions"], """
SELECT user_id_hash, count(DISTINCT device_type) AS n_device_types, count(*) AS total_sessions FROM sessions
GROUP BY user_id_hash HAVING count(DISTINCT device_type) > 1 ORDER BY n_device_types DESC, user_id_hash LIMIT 20""")
    q["category_sets"] = _with(["sessions"], f"""
SELECT {_JSON_LIST} AS content_categories, count(*) AS n_sessions FROM sessions GROUP BY 1
ORDER BY n_sessions DESC, 1 LIMIT 20""")
    q["top_categories"] = _with(["sessions"], """
SELECT category, count(*) AS n_sessions FROM (SELECT unnest(content_categories) AS category FROM sessions)
GROUP BY category ORDER BY n_sessions DESC, category LIMIT 20""")
    q["hourly_volume"] = _with(["sessions"], f"""
SELECT hour_of_day, count(*) AS n_sessions, {_rnd("avg(scroll_depth_avg)", 3)} AS avg_scroll
FROM sessions GROUP BY hour_of_day""")
    q["segment_overview"] = _with(["enriched", "profiles"], f"""
SELECT e.segment_id, g.segment_label, count(*) AS n_sessions, {_rnd("avg(s.scroll_depth_avg)", 3)} AS avg_scroll,
       {_rnd("avg(s.session_duration_s)", 1)} AS avg_duration_s,
       {_rnd("sum(CASE WHEN s.device_type = 'mobile' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*)", 6)} AS pct_mobile
FROM enriched e JOIN sessions s USING (session_id) JOIN profiles g ON g.segment_id = e.segment_id
GROUP BY e.segment_id, g.segment_label""")
    q["match_rate_by_devices"] = _with(["scored"], f"""
SELECT a.device_type AS device_a, b.device_type AS device_b, count(*) AS n_pairs,
       CAST(sum(p.predicted_label) AS BIGINT) AS n_matched,
       {_rnd("100.0::DOUBLE * sum(p.predicted_label) / count(*)", 2)} AS match_rate_pct
FROM scored p JOIN sessions a ON a.session_id = p.session_id_a JOIN sessions b ON b.session_id = p.session_id_b
WHERE p.split = 'test' GROUP BY ALL""")
    q["confident_pairs"] = _with(["scored"], f"""
SELECT session_id_a, session_id_b, {_rnd("probability", 4)} AS match_probability FROM scored
WHERE predicted_label = 1 AND probability > 0.80 ORDER BY probability DESC, session_id_a, session_id_b LIMIT 50""")
    q["diverse_users"] = _with(["sessions"], f"""
SELECT user_id_hash, count(DISTINCT device_type) AS devices, count(*) AS sessions,
       {_rnd("avg(scroll_depth_avg)", 3)} AS avg_scroll, {_rnd("avg(session_duration_s)", 0)} AS avg_duration
FROM sessions GROUP BY user_id_hash ORDER BY devices DESC, sessions DESC, user_id_hash LIMIT 20""")

    q["kpi_row"] = _with(["sessions", "profiles"], """
SELECT count(*) AS total_sessions, count(DISTINCT user_id_hash) AS unique_users,
       (SELECT count(*) FROM profiles) AS n_segments FROM sessions""")
    q["device_distribution"] = _with(
        ["sessions"], "SELECT device_type, count(*) AS n_sessions FROM sessions GROUP BY device_type"
    )
    q["hourly_by_device"] = _with(["sessions"], """
SELECT device_type, hour_of_day, count(*) AS n_sessions FROM sessions GROUP BY ALL""")
    q["users_by_device_count"] = _with(["sessions"], """
SELECT devices_used, count(*) AS users FROM (
  SELECT user_id_hash, count(DISTINCT device_type) AS devices_used FROM sessions GROUP BY user_id_hash)
GROUP BY devices_used""")
    q["segments_by_size"] = _with(
        ["profiles"], "SELECT segment_id, segment_label, n_sessions, pct_mobile FROM profiles"
    )
    q["segment_radar"] = _with(["profiles"], f"""
SELECT segment_id, segment_label, {_rnd("least(avg_scroll_depth / 1.0::DOUBLE, 1)", 6)} AS scroll_depth,
       {_rnd("least(avg_click_count / 30.0::DOUBLE, 1)", 6)} AS click_count,
       {_rnd("least(avg_pages_visited / 15.0::DOUBLE, 1)", 6)} AS pages_per_session
FROM (SELECT * FROM profiles ORDER BY n_sessions DESC, segment_id LIMIT 5)""")
    q["segment_table"] = _with(["profiles"], """
SELECT segment_label AS "Label", n_sessions AS "Sessions", pct_of_total AS "% of Total",
       top_categories AS "Top Categories", pct_mobile AS "% Mobile", avg_session_duration_s AS "Avg Duration (s)"
FROM profiles""")
    q["scroll_box_stats"] = _with(["sessions"], f"""
SELECT device_type, count(*) AS n_sessions, {_rnd("min(scroll_depth_avg)", 6)} AS min_value,
       {_rnd("quantile_cont(scroll_depth_avg, 0.25)", 6)} AS q1, {_rnd("quantile_cont(scroll_depth_avg, 0.5)", 6)} AS median,
       {_rnd("quantile_cont(scroll_depth_avg, 0.75)", 6)} AS q3, {_rnd("max(scroll_depth_avg)", 6)} AS max_value
FROM sessions GROUP BY device_type""")
    q["duration_histogram"] = _with(["sessions"], """
, bounds AS (SELECT min(session_duration_s)::DOUBLE AS lo, max(session_duration_s)::DOUBLE AS hi FROM sessions)
SELECT device_type, CAST(least(floor((session_duration_s - lo) / greatest((hi - lo) / 50.0::DOUBLE, 1e-9)), 49) AS INTEGER)
         AS bin, count(*) AS n_sessions FROM sessions CROSS JOIN bounds GROUP BY ALL""")
    q["scatter_sample"] = _with(
        ["sessions"], _sample("session_id, device_type, pages_visited, click_count", "sessions", "scatter", 42, 3000)
    )
    q["session_browser"] = _with(["enriched"], f"""
SELECT session_id, device_type, os, browser, session_duration_s, pages_visited, click_count, scroll_depth_avg,
       {_short("cats")} AS content_categories, segment_id
FROM (SELECT *, {_JSON_LIST} AS cats FROM (SELECT * FROM enriched WHERE pages_visited >= 2
      ORDER BY session_duration_s DESC, session_id LIMIT 5000))""")

    q["dataset_profile"] = _with(["sessions"], """
SELECT 'sessions_n_rows' AS metric, count(*) AS value FROM sessions
UNION ALL SELECT 'sessions_n_cols', CAST(25 AS BIGINT)
UNION ALL SELECT 'sessions_n_unique_users', count(DISTINCT user_id_hash) FROM sessions
UNION ALL SELECT 'sessions_sessions_' || device_type, count(*) FROM sessions GROUP BY device_type""")
    q["segment_listing"] = _with(["profiles"], """
SELECT segment_id, substr(segment_label, 1, 35) AS segment_label, n_sessions, pct_of_total, top_categories
FROM profiles""")
    return {name: sql.strip() for name, sql in q.items()}
