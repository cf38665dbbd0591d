"""Every operator as a named query over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import DEFAULTS
from ..functions.numeric import clip, round_half_up
from ..functions.privacy import anonymise, hash_matches, hmac_sha256, ip_prefix, user_agent_hash
from ..functions.text import array_to_json, clean_text, keyword_phrases, strings_from_json, truncate
from ..operators import evaluation as ev
from ..operators import matching as mt
from ..operators import pairs as pr
from ..operators import quality as ql
from ..operators import reports as rp
from ..operators import segments as sg
from ..operators import summaries as sm
from ..operators import textsignals as tx
from ..schemas import FEATURE_COLS
from ..session import shared_dir
from ..sources import tables as tb
from ..sources.events import activity_histogram
from .job import STORED_PII
from .workspace import TEST_SALT, Workspace


def _micros(col: str) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(col)


# -- sources, sinks, contracts -------------------------------------------------------


def sessions(w: Workspace) -> DataFrame:
    """Adapter output as derived from events; arrays as text."""
    return w.derive_sessions().select(
        "session_id", "real_user_id", "user_id_hash", "device_type", "os", "browser", "ip_prefix",
        "ip_prefix_hash", "device_fingerprint_hash", "user_agent_hash", _micros("session_start"),
        "session_duration_s", "pages_visited", "click_count", "scroll_depth_avg",
        F.array_join("content_categories", ",").alias("content_categories"), "interaction_text",
    )


def session_sample(w: Workspace) -> DataFrame:
    return tb.session_sample(w.sessions()).select("session_id", "user_id_hash", "device_type")


def bounded_scan(w: Workspace) -> DataFrame:
    return tb.bounded_scan(w.contract_sessions()).select("session_id", "device_type", "session_duration_s")


def csv_round_trip(w: Workspace) -> DataFrame:
    """CSV sink and source: the whole table, with line breaks in its text, written and read back."""
    path = shared_dir(w.spark, "csv")
    broken = F.concat("interaction_text", F.lit("\nback\\slash\r"))
    tb.write_csv(w.contract_sessions().withColumn("interaction_text", broken), path)
    return tb.read_sessions_csv(w.spark, path).select(
        "session_id", "device_type", _micros("session_start"), "session_duration_s", "scroll_depth_avg",
        F.array_join("content_categories", ",").alias("content_categories"),
        F.size("active_hours_profile").alias("n_hours"), "interaction_text",
    )


def table_round_trip(w: Workspace) -> DataFrame:
    """Catalog sink, existence test and SQL source on an external table in the shared folder."""
    path = shared_dir(w.spark, "table")
    name = "loom_" + path.rsplit("-", 1)[-1]
    tb.write_table(w.contract_sessions(), name, "replace", path, "session_id", 8)
    assert tb.table_exists(w.spark, name)
    return tb.read_table(
        w.spark, name, f"SELECT device_type, count(*) AS n_sessions FROM {name} GROUP BY device_type"
    )


def session_quality(w: Workspace) -> DataFrame:
    return ql.session_quality(w.contract_sessions())


def pair_quality(w: Workspace) -> DataFrame:
    return ql.pair_quality(w.scored_pairs())


def enriched_quality(w: Workspace) -> DataFrame:
    return ql.enriched_quality(w.enriched())


def segment_quality(w: Workspace) -> DataFrame:
    return ql.segment_quality(w.profiles())


# -- scalar and row operators --------------------------------------------------------


def session_features(w: Workspace) -> DataFrame:
    return w.derive_sessions().select(
        "session_id", "click_rate", "pages_per_minute", "device_type_enc", "is_mobile", "hour_of_day",
        "day_of_week", "n_content_categories",
    )


def activity_hours(w: Workspace) -> DataFrame:
    """Per-user share of events by hour, one row per hour."""
    profile = activity_histogram(w.events())
    return profile.select("user_id", F.posexplode("active_hours_profile").alias("hour", "share")).select(
        "user_id", "hour", round_half_up("share", 6).alias("share")
    )


def session_hours(w: Workspace) -> DataFrame:
    """The histogram each session carries, one row per hour."""
    return w.sessions().select("session_id", F.posexplode("active_hours_profile").alias("hour", "share")).select(
        "session_id", "hour", round_half_up("share", 6).alias("share")
    )


def document_clean_text(w: Workspace) -> DataFrame:
    return w.documents().select("doc_id", clean_text("text").alias("clean_text"))


def network_prefix(w: Workspace) -> DataFrame:
    """IPv4 coarsening to one, two and three octets of an address built from each event."""
    address = F.concat_ws(
        ".",
        (F.pmod("user_id", F.lit(250)) + 1).cast("string"),
        F.pmod("event_id", F.lit(256)).cast("string"),
        F.pmod(F.col("user_id") * 7, F.lit(256)).cast("string"),
        (F.pmod("event_id", F.lit(254)) + 1).cast("string"),
    )
    return w.events().withColumn("ip", address).select(
        "event_id", ip_prefix("ip", 1).alias("p1"), ip_prefix("ip").alias("p2"), ip_prefix("ip", 3).alias("p3")
    )


def json_edges(w: Workspace) -> DataFrame:
    """Array to JSON text and back, truncation of long text, clipping."""
    text = array_to_json("content_categories")
    return w.sessions().select(
        "session_id",
        text.alias("categories_json"),
        F.size(strings_from_json(text)).alias("n_back"),
        truncate("interaction_text", 40).alias("short_text"),
        clip("session_duration_s", 60, 300).alias("clipped_duration"),
    )


def agent_hash(w: Workspace) -> DataFrame:
    return (
        w.sessions()
        .groupBy("browser", "os")
        .agg(F.count(F.lit(1)).alias("n_sessions"))
        .withColumn("agent_hash", user_agent_hash("browser", "os"))
    )


def keyed_hash(w: Workspace) -> DataFrame:
    """HMAC of several columns, with a short and with a long salt."""
    return w.sessions().select(
        "session_id",
        hmac_sha256("ip_prefix", TEST_SALT).alias("prefix_hmac"),
        hmac_sha256("session_duration_s", "s" * 80).alias("duration_hmac"),
    )


def document_hash(w: Workspace) -> DataFrame:
    """HMAC of whole non-ASCII texts."""
    return w.documents().select("doc_id", hmac_sha256("text", "salt").alias("text_hmac"))


def anonymised_sessions(w: Workspace) -> DataFrame:
    return anonymise(w.contract_sessions(), STORED_PII, TEST_SALT).select(
        "session_id", "user_id_hash", *STORED_PII, "device_type"
    )


def hash_audit(w: Workspace) -> DataFrame:
    """How many stored digests verify against their original, per device class."""
    stored = w.sessions().withColumn("stored", hmac_sha256("ip_prefix", "salt"))
    tampered = F.when(F.col("is_mobile") == 1, F.col("ip_prefix")).otherwise(F.concat("ip_prefix", F.lit("x")))
    return stored.groupBy("device_type").agg(
        F.count_if(hash_matches("ip_prefix", "stored", "salt")).alias("n_valid"),
        F.count_if(hash_matches(tampered, "stored", "salt")).alias("n_tampered_valid"),
        F.count(F.lit(1)).alias("n_sessions"),
    )


# -- pairs ---------------------------------------------------------------------------


def eligible_users(w: Workspace) -> DataFrame:
    return pr.eligible_users(w.sessions())


def positive_pairs(w: Workspace) -> DataFrame:
    return pr.positive_pairs(w.sessions())


def negative_pairs(w: Workspace) -> DataFrame:
    return pr.negative_pairs(w.sessions())


def negative_shortfall(w: Workspace) -> DataFrame:
    """Negatives wanted and found."""
    return pr.negative_shortfall(w.sessions())


def checked_pairs(w: Workspace) -> DataFrame:
    """Id pairs against sessions, some ids being unknown and some sessions stored twice."""
    sessions = w.sessions().select("session_id", "scroll_depth_avg")
    twice = sessions.unionByName(sessions.where("scroll_depth_avg > 0.9"))
    strange = F.when((F.col("label") == 0) & (F.col("draw") == 0), F.concat(F.lit("no such "), F.col("session_id_b")))
    return pr.checked_pairs(w.pairs().withColumn("session_id_b", F.coalesce(strange, "session_id_b")), twice)


def sampled_pairs(w: Workspace) -> DataFrame:
    return pr.sample_pairs(w.sessions())


def numbered_split(w: Workspace) -> DataFrame:
    return pr.stratified_split(pr.number_pairs(w.pairs()))


def pair_features(w: Workspace) -> DataFrame:
    """The 16 features of every sampled pair."""
    features = pr.build_feature_matrix(w.pairs(), w.sessions())
    return features.select("session_id_a", "session_id_b", "label", "draw", *FEATURE_COLS)


def pair_integrity(w: Workspace) -> DataFrame:
    """Pairs against the tablet-free sessions: ends without a session are counted, not dropped."""
    return pr.pair_integrity(w.pairs(), w.sessions().where(F.col("device_type") != "tablet"))


# -- evaluation ----------------------------------------------------------------------


def identity_pairs(w: Workspace) -> DataFrame:
    return w.scored_pairs()


def classification_metrics(w: Workspace) -> DataFrame:
    return ev.classification_metrics(w.scored_pairs())


def roc_auc(w: Workspace) -> DataFrame:
    return ev.roc_auc(w.scored_pairs())


def confusion_matrix(w: Workspace) -> DataFrame:
    return ev.confusion_matrix(w.scored_pairs())


def classification_report(w: Workspace) -> DataFrame:
    return ev.classification_report(w.scored_pairs())


def roc_points(w: Workspace) -> DataFrame:
    return _rounded_threshold(ev.roc_points(w.scored_pairs()))


def precision_recall_points(w: Workspace) -> DataFrame:
    return _rounded_threshold(ev.precision_recall_points(w.scored_pairs()))


def _rounded_threshold(points: DataFrame) -> DataFrame:
    return points.withColumn("threshold", round_half_up("threshold", 6))


def threshold_sweep(w: Workspace) -> DataFrame:
    return ev.threshold_sweep(w.scored_pairs())


def identity_graph_stats(w: Workspace) -> DataFrame:
    return ev.identity_graph_stats(w.sessions(), w.scored_pairs())


# -- fitted models: facts about the fit that any right fit has ---------------------------


def _fit_facts(w: Workspace, model: str) -> DataFrame:
    """One row: sizes, and whether the reported metrics equal those recomputed from the stored pairs.

    Counts are recomputed with plain filters, AUC with Spark's own evaluator.
    """
    result = w.trained(model)
    label, decision, p = F.col("label"), F.col("predicted_label"), F.col("probability")
    test = F.col("split") == "test"
    tp, fp, fn = test & (label == 1) & (decision == 1), test & (label == 0) & (decision == 1), test & (label == 1) & (decision == 0)
    counted = result.pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(p.between(0.0, 1.0)).alias("n_probabilities"),
        F.count_if(decision == (p >= 0.5).cast("int")).alias("n_decisions"),
        F.count_if(test).alias("in_test"),
        F.count_if(test & (label == decision)).alias("hit"),
        F.count_if(tp).alias("tp"), F.count_if(fp).alias("fp"), F.count_if(fn).alias("fn"),
    )
    area = BinaryClassificationEvaluator(
        rawPredictionCol="probability", labelCol="label", metricName="areaUnderROC", numBins=0
    ).evaluate(result.pairs.where(test))

    def agrees(metric: str, value: F.Column | float) -> F.Column:
        return F.abs(F.col(metric) - F.coalesce(value, F.lit(0.0))) <= 0.5e-4 + 1e-9

    one = counted.select(F.struct("*").alias("c")).scalar()
    return result.metrics.withColumn("c", one).select("*", "c.*").select(
        "model", "threshold", "n_train", "n_test", "n_pairs", "n_probabilities", "n_decisions",
        (
            (F.col("in_test") == F.col("n_test"))
            & agrees("accuracy", F.try_divide("hit", "in_test"))
            & agrees("precision", F.try_divide("tp", F.col("tp") + F.col("fp")))
            & agrees("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))
            & agrees("f1", F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
            & agrees("roc_auc", F.lit(area))
        ).alias("metrics_agree"),
    )


def random_forest(w: Workspace) -> DataFrame:
    return _fit_facts(w, "random_forest")


def boosted_trees(w: Workspace) -> DataFrame:
    return _fit_facts(w, "xgboost")


def logistic_regression(w: Workspace) -> DataFrame:
    return _fit_facts(w, "logistic_regression")


def model_scored_pairs(w: Workspace) -> DataFrame:
    """Pairs scored by a fitted model: per split and label, all, with a probability, with the right decision."""
    model = w.trained("logistic_regression").model
    p, decision = F.col("probability"), F.col("predicted_label")
    return (
        mt.identity_pairs(mt.score(w.feature_pairs(), model, 0.7))
        .groupBy("split", "label")
        .agg(
            F.count(F.lit(1)).alias("n_pairs"),
            F.count_if(p.between(0.0, 1.0)).alias("n_probabilities"),
            F.count_if((p >= 0.7) == (decision == 1)).alias("n_decisions"),
        )
    )


def feature_importance(w: Workspace) -> DataFrame:
    """Every feature has one importance, none negative, in falling order, and together they make 1."""
    importance = w.trained("random_forest").feature_importance
    top = mt.top_features(importance).agg(F.collect_list("importance")).scalar()  # 15 values
    falling = F.reverse(F.array_sort(F.collect_list("importance")))  # 16 values
    return importance.agg(
        F.count_distinct("feature").alias("n_features"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("makes_one"),
        falling.alias("falling"),
    ).select(
        "n_features", "n_negative", "makes_one", (F.slice("falling", 1, 15) == top).alias("top_are_the_largest")
    )


def saved_model_scores(w: Workspace) -> DataFrame:
    """Score id pairs with the model kept in memory and with its saved and loaded copy."""
    model = w.trained("random_forest").model
    path = shared_dir(w.spark, "model")
    mt.save_model(model, path)
    ids = w.pairs().select("session_id_a", "session_id_b").distinct()
    kept = mt.predict_match(ids, w.sessions(), model)
    loaded = mt.predict_match(ids, w.sessions(), mt.load_model(path))
    both = kept.alias("k").join(loaded.alias("l"), ["session_id_a", "session_id_b"])
    same = (F.col("k.probability") == F.col("l.probability")) & (F.col("k.is_same_user") == F.col("l.is_same_user"))
    return both.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(same).alias("n_same"),
        F.count_if(F.col("l.is_same_user") == (F.col("l.probability") >= 0.5)).alias("n_decisions"),
    )


# -- text ----------------------------------------------------------------------------


def document_keywords(w: Workspace) -> DataFrame:
    phrases = w.documents().select("doc_id", keyword_phrases("text").alias("p"))
    return phrases.select("doc_id", F.array_join("p", ";").alias("keywords"), F.size("p").alias("n_keywords"))


def session_text(w: Workspace) -> DataFrame:
    return tx.text_columns(w.sessions()).select("session_id", "clean_text", "keywords", "n_keywords")


def unit_vectors(w: Workspace) -> DataFrame:
    """Unit-length copies of the vectors (stretched first so the scaling shows), one row per component."""
    stretched = w.source("embeddings").withColumn(
        "embedding", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    )
    unit = tx.normalised(stretched)
    return unit.select("vec_id", F.posexplode("embedding").alias("position", "value")).select(
        "vec_id", "position", round_half_up("value", 6).alias("value")
    )


def text_embeddings(w: Workspace) -> DataFrame:
    docs = w.documents().select("doc_id", clean_text("text").alias("clean_text"))
    return tx.embed_texts(docs).select("doc_id", "embedding")


def embedding_norms(w: Workspace) -> DataFrame:
    """Dimension and squared length of every document's embedding (0 for a text without words)."""
    embedded = text_embeddings(w)
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return embedded.select(
        "doc_id", F.size("embedding").alias("n_dims"), round_half_up(squares, 3).alias("squared_length")
    )


# -- segments ------------------------------------------------------------------------


def vector_subsample(w: Workspace) -> DataFrame:
    return sg.subsample(w.sessions().select("session_id", "device_type"), 5_000, "session_id")


def silhouette(w: Workspace) -> DataFrame:
    """Squared silhouette of all vectors under their labels."""
    vectors = w.source("embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").alias("segment_id")
    )
    score = sg.squared_silhouette(vectors)
    return vectors.agg(
        F.floor(F.lit(score) * 1e6 + 0.5).alias("silhouette_millionths"), F.count(F.lit(1)).alias("n_points")
    )


def segment_terms(w: Workspace) -> DataFrame:
    return sg.top_terms(w.enriched())


def segment_devices(w: Workspace) -> DataFrame:
    return sg.device_shares(w.enriched())


def segment_sizes(w: Workspace) -> DataFrame:
    return sg.segment_sizes(w.enriched()).drop("device_distribution")


def segment_profiles(w: Workspace) -> DataFrame:
    shares = F.transform(
        F.array_sort(F.map_entries("device_distribution")),
        lambda e: F.concat_ws(":", e["key"], F.floor(e["value"] * 1000 + 0.5).cast("string")),
    )
    profiles = sg.label_segments(w.enriched())
    return profiles.withColumn("device_distribution", F.array_join(shares, ","))


def kmeans_segments(w: Workspace) -> DataFrame:
    """Fit on unit vectors: segments used, vectors assigned, and the inertia against its recomputed value."""
    vectors, model, inertia = _fitted_on_vectors(w)
    return _placed(vectors, model).agg(
        F.countDistinct("segment_id").alias("n_segments"),
        F.count(F.lit(1)).alias("n_vectors"),
        (F.abs(F.sum("own") - inertia) < 1e-6 * F.sum("own") + 1e-9).alias("inertia_agrees"),
    )


def _fitted_on_vectors(w: Workspace) -> tuple[DataFrame, KMeansModel, float]:
    """Unit vectors, the best of the default number of fits on them, and its inertia."""
    seg = DEFAULTS["segmentation"]
    vectors = tx.unit_features(w.source("embeddings").select("vec_id", "embedding"))
    held = vectors.persist()
    try:
        fit = sg.train_kmeans(held, seg["n_clusters"], max_iter=seg["kmeans_max_iter"], restarts=seg["kmeans_restarts"])
    finally:
        held.unpersist()
    return vectors, *fit


def _placed(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    """Assigned vectors with their squared distance to the own and to the nearest centre."""
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])

    def apart(centre: F.Column) -> F.Column:
        gaps = F.zip_with(F.col("v"), centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)

    measured = sg.assign_segments(vectors, model).select(
        "vec_id", "segment_id", vector_to_array("features").alias("v")
    ).withColumn("distances", F.transform(centres, apart))
    own = F.element_at("distances", F.col("segment_id") + 1)
    return measured.select("vec_id", "segment_id", own.alias("own"), F.array_min("distances").alias("nearest"))


def kmeans_assignment(w: Workspace) -> DataFrame:
    """Every vector is assigned once, all segments are used and each vector sits at its nearest centre."""
    vectors, model, _ = _fitted_on_vectors(w)
    return _placed(vectors, model).agg(
        F.count(F.lit(1)).alias("n_assigned"),
        F.countDistinct("vec_id").alias("n_vectors"),
        F.countDistinct("segment_id").alias("n_segments"),
        F.count_if(F.col("own") > F.col("nearest") + F.lit(1e-9)).alias("n_misplaced"),
    )


def kmeans_search(w: Workspace) -> DataFrame:
    """Each k of the default range with a score in its range; one is the best, the first of equals."""
    best, scores = sg.find_best_k(w.source("embeddings"), DEFAULTS["segmentation"]["k_search_range"], "vec_id")
    table = sg.search_scores(w.spark, scores)
    first = F.min_by("k", F.struct(-F.col("silhouette"), "k")).over(W.partitionBy(F.lit(1)))  # one row per k
    return table.select(
        "k", F.col("silhouette").between(-1.0, 1.0).alias("scored"), (first == best).alias("best_agrees")
    )


# -- analytical queries and reports ----------------------------------------------------


def device_summary(w: Workspace) -> DataFrame:
    return rp.device_summary(w.sessions())


def cross_device_users(w: Workspace) -> DataFrame:
    return rp.cross_device_users(w.sessions())


def category_sets(w: Workspace) -> DataFrame:
    return rp.category_sets(w.sessions())


def top_categories(w: Workspace) -> DataFrame:
    return rp.top_categories(w.sessions())


def hourly_volume(w: Workspace) -> DataFrame:
    return rp.hourly_volume(w.sessions())


def segment_overview(w: Workspace) -> DataFrame:
    return rp.segment_overview(w.enriched(), w.sessions(), w.profiles())


def match_rate_by_devices(w: Workspace) -> DataFrame:
    return rp.match_rate_by_devices(w.scored_pairs(), w.sessions())


def confident_pairs(w: Workspace) -> DataFrame:
    return rp.confident_pairs(w.scored_pairs())


def diverse_users(w: Workspace) -> DataFrame:
    return rp.diverse_users(w.sessions())


def kpi_row(w: Workspace) -> DataFrame:
    return rp.kpi_row(w.sessions(), w.profiles())


def device_distribution(w: Workspace) -> DataFrame:
    return rp.device_distribution(w.sessions())


def hourly_by_device(w: Workspace) -> DataFrame:
    return rp.hourly_by_device(w.sessions())


def users_by_device_count(w: Workspace) -> DataFrame:
    return rp.users_by_device_count(w.sessions())


def segments_by_size(w: Workspace) -> DataFrame:
    return rp.segments_by_size(w.profiles())


def segment_radar(w: Workspace) -> DataFrame:
    radar = rp.segment_radar(w.profiles())
    return radar.withColumns({c: round_half_up(c, 6) for c in ("scroll_depth", "click_count", "pages_per_session")})


def segment_table(w: Workspace) -> DataFrame:
    return rp.segment_table(w.profiles())


def scroll_box_stats(w: Workspace) -> DataFrame:
    return rp.scroll_box_stats(w.sessions())


def duration_histogram(w: Workspace) -> DataFrame:
    return rp.duration_histogram(w.sessions())


def scatter_sample(w: Workspace) -> DataFrame:
    return rp.scatter_sample(w.sessions())


def session_browser(w: Workspace) -> DataFrame:
    """The browser over enriched sessions, filtered and sorted by the caller."""
    return rp.session_browser(
        w.enriched(), condition=F.col("pages_visited") >= 2, order=[F.desc("session_duration_s"), "session_id"]
    )


# -- summaries and jobs ------------------------------------------------------------------


def dataset_profile(w: Workspace) -> DataFrame:
    return sm.dataset_profile(w.contract_sessions())


def segment_listing(w: Workspace) -> DataFrame:
    return sm.segment_listing(w.profiles())


def _segments_in_range(n: F.Column) -> F.Column:
    searched = DEFAULTS["segmentation"]["k_search_range"]
    return n.between(2, max(searched)).alias("segments_in_range")


def segmentation_run(w: Workspace) -> DataFrame:
    """k search, fit and profiles of the run with default settings: the profiles cover every session once."""
    return w.job_table("audience_segments").agg(
        F.sum("n_sessions").alias("n_sessions"),
        _segments_in_range(F.count_distinct("segment_id")),
        (F.count_distinct("segment_id") == F.count(F.lit(1))).alias("one_row_each"),
        F.every(F.length("segment_label") > 0).alias("all_labelled"),
        (F.abs(F.sum("pct_of_total") - 100) < 0.1).alias("shares_make_all"),
    )


def run_summary(w: Workspace) -> DataFrame:
    """One full run of the job with default settings: sessions, users, and figures inside their ranges."""
    summary = w.job_table("run_summary")
    return summary.select(
        "sessions", "unique_users",
        F.col("accuracy").between(0.0, 1.0).alias("accuracy_valid"),
        F.col("roc_auc").between(0.0, 1.0).alias("roc_auc_valid"),
        _segments_in_range(F.col("n_segments")),
    )


def run_metrics(w: Workspace) -> DataFrame:
    """The metrics a run keeps: the value where the data alone decide it, else whether it is in range."""
    metric, value = F.col("metric"), F.col("value")
    decided = metric.isin("threshold", "n_train", "n_test", "n_sessions")
    signed = metric.startswith("silhouette")
    unit = metric.isin("accuracy", "precision", "recall", "f1", "roc_auc") | metric.startswith("fi_")
    top = F.when(unit | signed, 1.0).otherwise(float("inf"))
    return w.job_table("run_metrics").select(
        "run", "metric",
        F.when(decided, value).alias("value"),
        value.between(F.when(signed, -1.0).otherwise(0.0), top).alias("in_range"),
    )


_QUERIES = [
    sessions, session_sample, bounded_scan, csv_round_trip, table_round_trip,
    session_quality, pair_quality, enriched_quality, segment_quality,
    session_features, activity_hours, session_hours, document_clean_text, network_prefix, json_edges, agent_hash,
    keyed_hash, document_hash, anonymised_sessions, hash_audit,
    eligible_users, positive_pairs, negative_pairs, negative_shortfall, checked_pairs, sampled_pairs, numbered_split, pair_features, pair_integrity,
    identity_pairs, classification_metrics, roc_auc, confusion_matrix, classification_report,
    roc_points, precision_recall_points, threshold_sweep, identity_graph_stats,
    random_forest, boosted_trees, logistic_regression, model_scored_pairs, feature_importance, saved_model_scores,
    document_keywords, session_text, unit_vectors, text_embeddings, embedding_norms,
    vector_subsample, silhouette, segment_terms, segment_devices, segment_sizes, segment_profiles,
    kmeans_segments, kmeans_assignment, kmeans_search, segmentation_run,
    device_summary, cross_device_users, category_sets, top_categories, hourly_volume, segment_overview,
    match_rate_by_devices, confident_pairs, diverse_users,
    kpi_row, device_distribution, hourly_by_device, users_by_device_count, segments_by_size, segment_radar,
    segment_table, scroll_box_stats, duration_histogram, scatter_sample, session_browser,
    dataset_profile, segment_listing, run_summary, run_metrics,
]


def _bind(query: Callable[[Workspace], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(Workspace(spark, sf_dir))

    call.__name__, call.__doc__ = query.__name__, query.__doc__
    return call


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _bind(q) for q in _QUERIES}
