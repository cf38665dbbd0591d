import pytest
from pyspark.sql import functions as F

from sessionloom.operators import matching as mt
from sessionloom.schemas import FEATURE_COLS, IDENTITY_PAIRS_SCHEMA

SMALL = {"rf_params": {"n_estimators": 5, "max_depth": 4}, "xgb_params": {"n_estimators": 3, "max_depth": 3}}


@pytest.fixture(scope="module")
def features(workspace):
    return workspace.feature_pairs()


@pytest.mark.parametrize("name", ["random_forest", "xgboost", "logistic_regression"])
def test_training_bundle(sessions, features, name):
    result = mt.train_identity_model(sessions, {"identity": {"model": name, **SMALL}}, features=features)
    row = result.metrics.first()
    assert row["model"] == name and row["threshold"] == 0.5
    assert row["n_train"] + row["n_test"] == features.count()
    for metric in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        assert 0.0 <= row[metric] <= 1.0
    assert row["accuracy"] > 0.6  # same-user pairs share their activity histogram
    assert [f.name for f in result.pairs.schema.fields] == IDENTITY_PAIRS_SCHEMA.fieldNames()
    bad = result.pairs.where(
        ~F.col("probability").between(0, 1) | (F.col("predicted_label") != (F.col("probability") >= 0.5).cast("int"))
    )
    assert bad.count() == 0
    assert result.confusion_matrix.agg(F.sum("n_pairs")).first()[0] == row["n_test"]
    if name == "logistic_regression":
        assert result.feature_importance is None
    else:
        importance = result.feature_importance.collect()
        assert {r["feature"] for r in importance} == set(FEATURE_COLS)
        assert abs(sum(r["importance"] for r in importance) - 1) < 1e-6
        assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
        assert mt.top_features(result.feature_importance, 3).count() == 3


def test_full_training_from_sessions(sessions):
    result = mt.train_identity_model(sessions, {"identity": {"model": "random_forest", "n_pairs_per_user": 2, **SMALL}})
    ids = [r["pair_id"] for r in result.pairs.select("pair_id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_scaler_sees_train_rows_only(features):
    model = mt.fit_on(features, "logistic_regression")
    train = features.where("split = 'train'")
    want = train.agg(*[F.avg(c) for c in FEATURE_COLS]).first()
    assert all(abs(a - b) < 1e-9 for a, b in zip(model.stages[1].mean, want))


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "label int")
    sizes = mt.label_sizes(df)
    assert sizes == {0: 6, 1: 2}
    weights = {r["label"]: r["weight"] for r in mt.with_balanced_weights(df, sizes).distinct().collect()}
    assert weights[1] * 2 == weights[0] * 6 == 4.0


def test_unknown_model_is_refused(sessions, features):
    with pytest.raises(ValueError):
        mt.build_estimator("svm")
    with pytest.raises(ValueError):
        mt.train_identity_model(sessions, {"identity": {"model": "svm"}}, features=features)


def test_estimator_defaults():
    forest = mt.build_estimator("random_forest")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (200, 12, 5, 42)
    boosted = mt.build_estimator("xgboost")
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (200, 6, 0.05)
    assert mt.build_estimator("logistic_regression", n_rows=50).getRegParam() == 0.02


def test_forest_passes_start_from_kept_nodes(spark, features):
    forest = mt.build_estimator("random_forest", {"rf_params": {"n_estimators": 5}})
    assert forest.getCacheNodeIds() and forest.getCheckpointInterval() == -1
    one = features.where("split = 'train'").select("label", *FEATURE_COLS).coalesce(1)
    sizes = mt.label_sizes(one)
    pipeline = mt.matching_pipeline("random_forest", {"rf_params": {"n_estimators": 5}}, sum(sizes.values()))
    grown = []
    for kept in (True, False):
        pipeline.getStages()[-1].setCacheNodeIds(kept)
        forest = pipeline.fit(mt.with_balanced_weights(one, sizes)).stages[-1]
        grown.append([tree.toDebugString.split("\n", 1)[1] for tree in forest.trees])
    assert grown[0] == grown[1]  # the same trees, whether their nodes are kept or found again


def test_save_load_predict(spark, workspace, sessions, features, tmp_path):
    model = mt.fit_on(features, "random_forest", SMALL)
    path = str(tmp_path / "model")
    mt.save_model(model, path)
    mt.save_model(model, path)  # overwriting is allowed
    pairs = workspace.pairs().limit(20)
    ids = ["session_id_a", "session_id_b"]
    before = mt.predict_match(pairs, sessions, model, 0.7).orderBy(*ids).collect()
    after = mt.predict_match(pairs, sessions, mt.load_model(path), 0.7).orderBy(*ids).collect()
    assert before == after and len(before) == 20
    assert all(r["is_same_user"] == (r["probability"] >= 0.7) for r in before)
    strange = pairs.select(*ids).distinct().limit(3).union(spark.createDataFrame([("no", "one")], ids))
    with pytest.raises(KeyError):
        mt.predict_match(strange, sessions, model)
    flagged = mt.predict_match(strange, sessions, model, strict=False).collect()
    assert len(flagged) == 4 and [r["session_id_a"] for r in flagged if r["probability"] is None] == ["no"]
