import random

import numpy as np
import pytest

from conftest import make_sessions
from sessionloom.operators.evaluation import (
    classification_metrics, classification_report, confusion_matrix, identity_graph_stats, precision_recall_points,
    ranked_scores, roc_auc, roc_points, threshold_sweep,
)

SCHEMA = "label int, probability double, predicted_label int"


@pytest.fixture(scope="module")
def scored():
    rng = random.Random(3)
    rows = []
    for _ in range(700):
        label = int(rng.random() < 0.3)
        p = round(min(max(rng.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0), 2 if rng.random() < 0.5 else 6)
        rows.append((label, p, int(p >= 0.5)))
    return rows


def _brute_auc(rows):
    pos = [p for y, p, _ in rows if y == 1]
    neg = [p for y, p, _ in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_auc_equals_brute_force(spark, scored):
    assert abs(roc_auc(spark.createDataFrame(scored, SCHEMA)).first()["roc_auc"] - _brute_auc(scored)) < 1e-6


def test_auc_without_negatives_is_null(spark):
    assert roc_auc(spark.createDataFrame([(1, 0.5, 1)], SCHEMA)).first()["roc_auc"] is None


def test_curves_equal_brute_force(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA)
    p_all, n_all = sum(y for y, _, _ in scored), sum(1 - y for y, _, _ in scored)
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in roc_points(df).collect()}
    prc = {r["threshold"]: (r["precision"], r["recall"]) for r in precision_recall_points(df).collect()}
    assert roc.pop(None) == (0.0, 0.0) and prc.pop(None) == (1.0, 0.0)
    assert set(roc) == set(prc) == {p for _, p, _ in scored}
    for t in roc:
        tp = sum(1 for y, p, _ in scored if y == 1 and p >= t)
        fp = sum(1 for y, p, _ in scored if y == 0 and p >= t)
        assert np.allclose(roc[t], (fp / n_all, tp / p_all), atol=1e-6)
        assert np.allclose(prc[t], (tp / (tp + fp), tp / p_all), atol=1e-6)


def test_many_scores_are_ranked_in_ranges(spark, scored):
    plan = ranked_scores(spark.createDataFrame(scored, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan


def test_metrics_and_confusion(spark):
    rows = [(1, 0.9, 1)] * 3 + [(1, 0.1, 0)] + [(0, 0.8, 1)] * 2 + [(0, 0.2, 0)] * 4
    df = spark.createDataFrame(rows, SCHEMA)
    m = classification_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"], m["n_test"]) == (0.7, 0.6, 0.75, 0.6667, 10)
    cells = {(r["label"], r["predicted_label"]): r["n_pairs"] for r in confusion_matrix(df).collect()}
    assert cells == {(0, 0): 4, (0, 1): 2, (1, 0): 1, (1, 1): 3}


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.1, 0)] * 5, SCHEMA)
    m = classification_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)
    empty = classification_metrics(spark.createDataFrame([], SCHEMA)).first()
    assert (empty["accuracy"], empty["n_test"]) == (0.0, 0)
    assert confusion_matrix(df).count() == 4


def test_report_rows(spark, scored):
    rows = {r["class_name"]: r for r in classification_report(spark.createDataFrame(scored, SCHEMA)).collect()}
    assert list(rows) == ["Different User", "Same User", "accuracy", "macro avg", "weighted avg"]
    assert rows["Different User"]["support"] + rows["Same User"]["support"] == len(scored)
    right = sum(1 for y, _, g in scored if y == g) / len(scored)
    assert abs(rows["accuracy"]["f1"] - right) < 1e-6
    assert abs(rows["weighted avg"]["recall"] - right) < 1e-6


def test_sweep_default_and_custom(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA)
    default = threshold_sweep(df).collect()
    assert [r["threshold"] for r in default] == [round(0.1 + 0.05 * i, 2) for i in range(17)]
    custom = threshold_sweep(df, np.array([0.3, 0.7])).collect()
    for row in custom:
        right = sum(1 for y, p, _ in scored if y == (p >= row["threshold"])) / len(scored)
        assert abs(row["accuracy"] - right) < 1e-4


def test_graph_stats(spark):
    sessions = make_sessions(spark, [{"device_type": d} for d in ("mobile", "desktop", "mobile", "tablet")])
    schema = "session_id_a string, session_id_b string, probability double, predicted_label int"
    rows = [("s0", "s1", 0.9, 1), ("s0", "s2", 0.8, 1), ("s1", "s3", 0.2, 0)]
    got = identity_graph_stats(sessions, spark.createDataFrame(rows, schema)).first()
    assert tuple(got) == (3, 2, 66.67, 3, 1, 0.85)
    none = identity_graph_stats(sessions, spark.createDataFrame(rows[2:], schema)).first()
    assert tuple(none) == (1, 0, 0.0, 0, 0, None)
    empty = identity_graph_stats(sessions, spark.createDataFrame([], schema)).first()
    assert tuple(empty) == (0, 0, 0.0, 0, 0, None)
