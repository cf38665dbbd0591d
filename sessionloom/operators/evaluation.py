"""Evaluation of scored pairs: counts first, then small tables.

Input: a DataFrame with ``label`` (0/1), ``probability`` and, where a decision is
needed, ``predicted_label``. Everything starts from one aggregate with map-side
combining, so a label or score shared by a third of all rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, round_half_up
from .ranking import range_splits, running_sums

CLASS_NAMES = {0: "Different User", 1: "Same User"}


def default_thresholds() -> list[float]:
    """17 operating points from 0.10 to 0.90."""
    return [float(t) for t in np.linspace(0.1, 0.9, 17)]


def outcome_counts(predictions: DataFrame) -> DataFrame:
    """One row: tp, fp, tn, fn."""
    truth, guess = F.col("label") == 1, F.col("predicted_label") == 1
    return predictions.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(truth & ~guess).alias("fn"),
    )


def quality_columns(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """accuracy, precision, recall and F1 (0 where undefined), 4 decimals."""
    return {
        "accuracy": round_half_up(ratio(tp + tn, tp + fp + tn + fn), 4),
        "precision": round_half_up(ratio(tp, tp + fp), 4),
        "recall": round_half_up(ratio(tp, tp + fn), 4),
        "f1": round_half_up(ratio(2 * tp, 2 * tp + fp + fn), 4),
    }


def classification_metrics(predictions: DataFrame, threshold: float = 0.50) -> DataFrame:
    """One row of quality figures with the threshold they belong to and the number of rows."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    named = [c.alias(n) for n, c in quality_columns(tp, fp, tn, fn).items()]
    return outcome_counts(predictions).select(
        *named, F.lit(float(threshold)).alias("threshold"), (tp + fp + tn + fn).alias("n_test")
    )


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Four rows (label, predicted_label, n_pairs), empty cells included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    cell = F.explode(
        F.array(
            *[
                F.struct(F.lit(t).alias("label"), F.lit(p).alias("predicted_label"), F.col(c).alias("n_pairs"))
                for t, p, c in cells
            ]
        )
    )
    return outcome_counts(predictions).select(cell.alias("c")).select("c.*")


def classification_report(predictions: DataFrame) -> DataFrame:
    """Per-class rows, accuracy, macro and weighted averages of precision, recall and F1.

    Values are unrounded apart from 6 decimals; ``support`` is the number of pairs.
    """
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def scores(hit: Column, wrong: Column, missed: Column) -> list[Column]:
        return [ratio(hit, hit + wrong), ratio(hit, hit + missed), ratio(2 * hit, 2 * hit + wrong + missed)]

    negative, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    n_negative, n_positive = tn + fp, tp + fn
    total = n_negative + n_positive
    accuracy = ratio(tp + tn, total)
    macro = [(x + y) / F.lit(2.0) for x, y in zip(negative, positive)]
    weighted = [ratio(x * n_negative + y * n_positive, total) for x, y in zip(negative, positive)]
    rows = [
        (CLASS_NAMES[0], negative, n_negative),
        (CLASS_NAMES[1], positive, n_positive),
        ("accuracy", [accuracy] * 3, total),
        ("macro avg", macro, total),
        ("weighted avg", weighted, total),
    ]
    structs = [
        F.struct(
            F.lit(name).alias("class_name"),
            round_half_up(values[0], 6).alias("precision"),
            round_half_up(values[1], 6).alias("recall"),
            round_half_up(values[2], 6).alias("f1"),
            support.alias("support"),
        )
        for name, values, support in rows
    ]
    return outcome_counts(predictions).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def score_counts(predictions: DataFrame) -> DataFrame:
    """Positives and negatives per distinct probability."""
    return predictions.groupBy("probability").agg(
        F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg")
    )


def ranked_scores(predictions: DataFrame) -> DataFrame:
    """Distinct probabilities with positives and negatives at or above each of them."""
    counts = score_counts(predictions)
    return running_sums(
        counts, "probability", {"tp": "n_pos", "fp": "n_neg"}, range_splits(counts, "probability")
    )


def _totals(predictions: DataFrame) -> tuple[Column, Column]:
    """Total positives and negatives as scalar subqueries."""
    positives = predictions.agg(F.count_if(F.col("label") == 1).alias("p")).scalar()
    negatives = predictions.agg(F.count_if(F.col("label") == 0).alias("n")).scalar()
    return positives, negatives


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Exact area under the ROC curve, ties counted half (null when a class is absent)."""
    ranked = ranked_scores(predictions)
    # fp counts negatives at or above: a positive at this score beats the rest, and ties count half
    tied_or_above = F.col("fp").cast("double") - F.col("n_neg") / F.lit(2.0)
    sums = ranked.agg(
        F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"), F.sum(F.col("n_pos") * tied_or_above).alias("lost")
    )
    area = F.lit(1.0) - F.try_divide(F.col("lost"), F.col("p").cast("double") * F.col("n").cast("double"))
    return sums.select(round_half_up(area, 6).alias("roc_auc"), F.col("p").alias("n_pos"), F.col("n").alias("n_neg"))


def roc_points(predictions: DataFrame) -> DataFrame:
    """ROC points (threshold, fpr, tpr), one per distinct probability plus the origin (null threshold)."""
    positives, negatives = _totals(predictions)
    points = ranked_scores(predictions).select(
        F.col("probability").alias("threshold"),
        round_half_up(ratio(F.col("fp"), negatives), 6).alias("fpr"),
        round_half_up(ratio(F.col("tp"), positives), 6).alias("tpr"),
    )
    return points.unionByName(_one_row(predictions, threshold=None, fpr=0.0, tpr=0.0))


def precision_recall_points(predictions: DataFrame) -> DataFrame:
    """Precision-recall points per distinct probability plus the (precision 1, recall 0) end point."""
    positives, _ = _totals(predictions)
    points = ranked_scores(predictions).select(
        F.col("probability").alias("threshold"),
        round_half_up(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"),
        round_half_up(ratio(F.col("tp"), positives), 6).alias("recall"),
    )
    return points.unionByName(_one_row(predictions, threshold=None, precision=1.0, recall=0.0))


def _one_row(df: DataFrame, **values: float | None) -> DataFrame:
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


def threshold_sweep(predictions: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Quality figures at each threshold: one pass, two counters per threshold, no row is multiplied."""
    points = sorted(float(t) for t in (default_thresholds() if thresholds is None else thresholds))
    positive, negative = F.col("label") == 1, F.col("label") == 0
    counts = predictions.agg(
        *[F.count_if(positive & (F.col("probability") >= t)).alias(f"tp{j}") for j, t in enumerate(points)],
        *[F.count_if(negative & (F.col("probability") >= t)).alias(f"fp{j}") for j, t in enumerate(points)],
        F.count_if(positive).alias("p"),
        F.count_if(negative).alias("n"),
    )
    rows = []
    for j, t in enumerate(points):
        tp, fp = F.col(f"tp{j}"), F.col(f"fp{j}")
        quality = quality_columns(tp, fp, F.col("n") - fp, F.col("p") - tp)
        rows.append(F.struct(F.lit(round(t, 2)).alias("threshold"), *[c.alias(n) for n, c in quality.items()]))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def identity_graph_stats(sessions: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row of statistics of the graph formed by predicted matches."""
    matched = predictions.where(F.col("predicted_label") == 1)
    devices = sessions.select("session_id", "device_type")
    dev_a = devices.select(F.col("session_id").alias("session_id_a"), F.col("device_type").alias("dt_a"))
    dev_b = devices.select(F.col("session_id").alias("session_id_b"), F.col("device_type").alias("dt_b"))
    cross = (
        matched.select("session_id_a", "session_id_b")
        .join(dev_a, "session_id_a")
        .join(dev_b, "session_id_b")
        .agg(F.count_if(F.col("dt_a") != F.col("dt_b")).alias("n"))
    )
    linked = (
        matched.select(F.explode(F.array("session_id_a", "session_id_b")).alias("session_id"))
        .agg(F.countDistinct("session_id").alias("n"))
    )
    hit = F.col("predicted_label") == 1
    totals = predictions.agg(
        F.count(F.lit(1)).alias("total_pairs_evaluated"),
        F.count_if(hit).alias("matched_pairs"),
        F.avg(F.when(hit, F.col("probability"))).alias("mean_probability"),
    )
    share = F.lit(100.0) * F.col("matched_pairs") / F.greatest(F.col("total_pairs_evaluated"), F.lit(1))
    return totals.select(
        "total_pairs_evaluated",
        "matched_pairs",
        round_half_up(share, 2).alias("match_rate_pct"),
        linked.scalar().alias("sessions_in_identity_graph"),
        cross.scalar().alias("cross_device_matches"),
        round_half_up("mean_probability", 4).alias("avg_match_probability"),
    )
