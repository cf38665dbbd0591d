"""Expected results of the corpus queries that SQL can state, for DuckDB over the driver tables.

They follow the definitions, not the plans: whole-table windows and joins on the texts themselves.
"""

from __future__ import annotations

from . import chat_rotation, mixing, quality_rules
from .queries import SHARDS

WORD = r"'[^\x20\x09-\x0D]+'"


def _order_key(tag: str) -> str:
    return f"md5('{tag}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(md5(text), 'null'))"


def _fraction(digest: str) -> str:
    return f"((('0x' || substr({digest}, 1, 13))::BIGINT::DOUBLE + 0.5) / {float(16**13)!r})"


def shards() -> str:
    crc_table = (
        "list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: "
        "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"
    )
    data = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"""
WITH fixed AS (SELECT {crc_table} AS t),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {_order_key("slot")} AS o,
    xor(list_reduce({data}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, fixed
),
cost AS (
  SELECT k.doc_id, s, -ln({_fraction("md5(coalesce(k.doc_id::VARCHAR, 'null') || ':' || s::VARCHAR)")}) AS c
  FROM (SELECT DISTINCT doc_id FROM documents) k, range({SHARDS + 1}) r(s)
),
placed AS (
  SELECT doc_id, arg_min(s, c) FILTER (s < {SHARDS}) AS shard, arg_min(s, c) AS grown_shard FROM cost GROUP BY doc_id
)
SELECT d.doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY o, d.doc_id, size) - 1 AS slot, grown_shard::INT AS grown_shard
FROM d JOIN placed p ON d.doc_id IS NOT DISTINCT FROM p.doc_id
"""


def lines() -> str:
    return f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
),
w AS (
  SELECT doc_id, pos AS a, lead(pos) OVER p AS b, lead(pos, 2) OVER p AS c, line AS x, lead(line) OVER p AS y, lead(line, 2) OVER p AS z
  FROM l WHERE regexp_matches(line, {WORD}) WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
),
later AS (
  SELECT doc_id, a, b, c FROM w WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, a) > 1
),
covered AS (
  SELECT doc_id, a AS pos FROM later UNION SELECT doc_id, b FROM later UNION SELECT doc_id, c FROM later
),
island AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM covered),
span AS (SELECT doc_id, g, min(pos) AS s, max(pos) AS e FROM island GROUP BY doc_id, g),
spans AS (SELECT doc_id, string_agg(s || '-' || e, ',' ORDER BY s) AS spans FROM span GROUP BY doc_id),
rest AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
    string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL) AS text
  FROM l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(spans, '') AS spans,
  CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id LEFT JOIN spans s ON d.doc_id = s.doc_id
"""


def chat() -> str:
    return f"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{chat_rotation.SYSTEM}'),
m AS (
  SELECT t.*, speaker, turn // {chat_rotation.PART} AS part, role = speaker AS mine,
    CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = '{chat_rotation.SYSTEM}' THEN '<|system|>'
      ELSE '<|user name=' || role || '|>' END || chr(10) AS head
  FROM t JOIN p ON t.conv_id = p.conv_id
),
s AS (
  SELECT *, head || text || chr(10) || '<|end|>' || chr(10) AS shown,
    sum(length(head) + length(text) + 9) OVER (
      PARTITION BY conv_id, speaker, part ORDER BY turn, role, text) - length(text) - 9 AS start
  FROM m
)
SELECT conv_id, speaker, part, count(*) AS n_messages, string_agg(shown, '' ORDER BY turn, role, text) AS rendered,
  coalesce(string_agg(start::BIGINT || '-' || (start + length(text))::BIGINT, ',' ORDER BY turn, role, text) FILTER (mine), '') AS mask,
  coalesce(sum(length(text)) FILTER (mine), 0)::BIGINT AS n_masked
FROM s GROUP BY conv_id, speaker, part
"""


def quality() -> str:
    base = f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents
),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
  )
),
r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, range(3) s(k) WHERE n > 1 GROUP BY doc_id
),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, {WORD}) GROUP BY doc_id
),
b AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
),
f AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars * 10000 // n_words ELSE 0 END AS word_length,
    CASE WHEN word_chars > 0 THEN n_symbols * 10000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 10000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 10000 // n_words ELSE 0 END AS repeats
  FROM b
)"""
    rules = list(quality_rules.RULES)
    unions = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {r} AS v FROM f WHERE n_words > 0" for r in rules)
    width = "greatest(length(bin(v::BIGINT)) - 7, 0)"
    value = lambda q: f"(({q} % 128) * pow(2.0, {q} // 128))"
    checks = []
    for r, (above, below) in quality_rules.RULES.items():
        lower = "" if below is None else f" OR {r} < {r}_low"
        checks.append(f"coalesce({r} > {r}_high{lower}, false)")
    fences = []
    for r, (above, below) in quality_rules.RULES.items():
        fences.append(f"max(q75 + {quality_rules.FENCE} * (q75 - q50) + {above}) FILTER (rule = '{r}') AS {r}_high")
        if below is not None:
            fences.append(f"max(q25 - {quality_rules.FENCE} * (q50 - q25) - {below}) FILTER (rule = '{r}') AS {r}_low")
    quantiles = ", ".join(
        f"{value(f'min(band) FILTER (share >= {q / 100})')} AS q{q}" for q in (25, 50, 75)
    )
    return f"""{base},
v AS ({unions}),
n AS (SELECT lang, source, rule, ({width} * 128 + floor(v / pow(2.0, {width})))::INT AS band, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
p AS (
  SELECT lang, rule, band, {quality_rules.PRIOR} * sum(n) / sum(sum(n)) OVER (PARTITION BY lang, rule) AS n
  FROM n GROUP BY lang, rule, band
),
x AS (
  SELECT lang, source, rule, band, sum(n) AS n FROM (
    SELECT * FROM n UNION ALL
    SELECT p.lang, source, rule, band, p.n FROM p JOIN (SELECT DISTINCT lang, source FROM n) s ON p.lang IS NOT DISTINCT FROM s.lang
  ) GROUP BY lang, source, rule, band
),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY band) / sum(n) OVER (PARTITION BY lang, source, rule) AS share
  FROM x
),
q AS (SELECT lang, source, rule, {quantiles} FROM c GROUP BY lang, source, rule),
h AS (SELECT lang, source, {", ".join(fences)} FROM q GROUP BY lang, source),
j AS (
  SELECT f.*, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > {quality_rules.MOST_REPEATED} * n_words AS base_failed,
    {" OR ".join(checks)} AS odd
  FROM f LEFT JOIN h ON f.lang IS NOT DISTINCT FROM h.lang AND f.source IS NOT DISTINCT FROM h.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT odd AS kept FROM j
"""


def mixture() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    width = "greatest(length(bin(size)) - 7, 0)"
    return f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD}))::BIGINT AS size, {_order_key("mix")} AS k FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    ([{weights}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
),
o AS (
  SELECT *, source_size * {mixing.MOST_COPIES} AS cap, row_number() OVER (ORDER BY source_size * {mixing.MOST_COPIES} / w, source NULLS LAST) AS pos,
    sum(source_size) OVER () * {mixing.SHARE} AS total FROM s
),
e AS (
  SELECT *, (total - coalesce((SELECT sum(cap) FROM o b WHERE b.pos < o.pos), 0)) / (SELECT sum(w) FROM o b WHERE b.pos >= o.pos) AS level FROM o
),
first AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM e WHERE w * level < cap),
g AS (
  SELECT source, source_size, CASE WHEN f.pos IS NULL OR e.pos < f.pos THEN cap ELSE w * f.level END::DOUBLE AS target
  FROM e, first f
),
r AS (
  SELECT *, row_number() OVER (
    PARTITION BY source ORDER BY length(bin(size)) * 128 + floor(size / pow(2.0, {width})) DESC, k, doc_id) - 1 AS pos
  FROM d
),
c AS (
  SELECT r.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    {_fraction("md5('mix|' || coalesce(r.source, 'null'))")} AS u
  FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  ((floor(rate * (pos + 1) + u) - floor(rate * pos + u)) * size)::BIGINT AS taken
FROM c
"""


def divergence() -> str:
    """Dense over every group and kept term; 10 documents, 1e9 scale and 10 terms stated here."""
    return r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS rid
  FROM documents
),
t AS (
  SELECT lang, source, rid, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d
),
gt AS (SELECT lang, source, term, count(*) AS cnt, count(DISTINCT rid) AS ndocs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(cnt) AS lcnt FROM gt GROUP BY lang, term HAVING sum(ndocs) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS nv, sum(lcnt)::HUGEINT AS nl FROM k GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
gk AS (
  SELECT g.lang, g.source, k.term, coalesce(gt.cnt, 0)::HUGEINT AS cnt
  FROM grp g JOIN k ON g.lang = k.lang
  LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source AND gt.term = k.term
),
gn AS (SELECT lang, source, sum(cnt) AS n FROM gk GROUP BY ALL),
gp AS (
  SELECT gk.lang, gk.source, gk.term, gk.cnt, 1 + (1000000000 * (gk.cnt + 2)) // (gn.n + 2 * v.nv) AS p
  FROM gk JOIN gn ON gk.lang = gn.lang AND gk.source = gn.source JOIN v ON gk.lang = v.lang
),
lp AS (SELECT k.lang, k.term, 1 + (1000000000 * (k.lcnt + 2)) // (v.nl + 2 * v.nv) AS q FROM k JOIN v ON k.lang = v.lang),
ps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(ps.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN ps ON ps.lang = a.lang AND ps.source = a.source AND ps.item = b.source
),
terms AS (
  SELECT gp.lang, gp.source, 'term' AS part, gp.term AS item, (gp.p - lp.q) * (gp.p - lp.q) // (gp.p + lp.q) AS value
  FROM gp JOIN lp ON gp.lang = lp.lang AND gp.term = lp.term
  WHERE gp.cnt > 0 AND gp.p > lp.q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= 10
"""


def llm_expected() -> dict[str, str]:
    return {
        "op3_rendezvous_shards": shards(),
        "op4_line_dedup": lines(),
        "op5_chat_rotation": chat(),
        "op6_adaptive_quality": quality(),
        "op8_systematic_mix": mixture(),
        "op13_source_divergence": divergence(),
    }
