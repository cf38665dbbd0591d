"""Same-user model: estimators, training, scoring, persistence."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import make_config
from ..functions.numeric import at_least, round_half_up
from ..schemas import FEATURE_COLS
from ..session import ensure_checkpoint_dir, materialised
from .evaluation import classification_metrics, confusion_matrix, roc_auc
from .pairs import build_feature_matrix, checked_pairs, number_pairs, require_known_sessions, sample_pairs, stratified_split


def _random_forest(cfg: dict, n_rows: int) -> Estimator:
    p = cfg.get("rf_params", {})
    return RandomForestClassifier(
        numTrees=p.get("n_estimators", 200),
        maxDepth=p.get("max_depth", 12),
        minInstancesPerNode=p.get("min_samples_leaf", 5),
        seed=p.get("random_state", 42),
        weightCol="weight",
        # more node statistics per pass: fewer passes over the data at depth 12
        maxMemoryInMB=1024,
        # a pass starts from each row's node in each tree, not from all roots again; a pass a level is too short a
        # lineage to write these ids (one number a row and tree) to the shared folder
        cacheNodeIds=True,
        checkpointInterval=-1,
    )


def _boosted_trees(cfg: dict, n_rows: int) -> Estimator:
    p = cfg.get("xgb_params", {})
    return GBTClassifier(
        maxIter=p.get("n_estimators", 200),
        maxDepth=p.get("max_depth", 6),
        stepSize=p.get("learning_rate", 0.05),
        seed=p.get("random_state", 42),
    )


def _logistic_regression(cfg: dict, n_rows: int) -> Estimator:
    # unit inverse penalty on the summed loss equals 1/n on the mean loss
    return LogisticRegression(maxIter=1000, regParam=1.0 / max(n_rows, 1), weightCol="weight", standardization=False)


_ESTIMATORS = {
    "random_forest": _random_forest,
    "xgboost": _boosted_trees,
    "logistic_regression": _logistic_regression,
}


def build_estimator(name: str, cfg: dict | None = None, n_rows: int = 1) -> Estimator:
    """The classifier called ``name``; unknown names are an error."""
    if name not in _ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(_ESTIMATORS)}")
    estimator = _ESTIMATORS[name](cfg or {}, n_rows)
    return estimator.setFeaturesCol("features").setLabelCol("label")


def matching_pipeline(name: str, cfg: dict | None = None, n_rows: int = 1) -> Pipeline:
    """Assembler, scaler and classifier as one estimator, so they persist together."""
    assembler = VectorAssembler(inputCols=FEATURE_COLS, outputCol="raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, build_estimator(name, cfg, n_rows)])


def label_sizes(pairs: DataFrame) -> dict[int, int]:
    """Rows per label: two numbers."""
    row = pairs.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    return {0: row["n0"], 1: row["n1"]}


def with_balanced_weights(train: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Weight n / (2 * n_label), so both labels carry the same total weight."""
    total = sum(sizes.values())
    weight = {label: total / (2.0 * max(n, 1)) for label, n in sizes.items()}
    return train.withColumn("weight", F.when(F.col("label") == 1, weight[1]).otherwise(weight[0]))


def score(features: DataFrame, model: PipelineModel, threshold: float = 0.50) -> DataFrame:
    """Add ``probability`` and ``predicted_label``; the input columns stay."""
    scored = model.transform(features).withColumn("p1", vector_to_array("probability")[1])
    return scored.select(
        *features.columns, F.col("p1").alias("probability"), at_least("p1", threshold).alias("predicted_label")
    )


@dataclass
class IdentityResult:
    model: PipelineModel
    model_name: str
    pairs: DataFrame  # identity pairs: id, ends, label, probability, decision, split
    test_predictions: DataFrame
    metrics: DataFrame  # one row
    confusion_matrix: DataFrame
    feature_importance: DataFrame | None


def feature_importance(model: PipelineModel, spark) -> DataFrame | None:
    """Importance per feature (16 rows), None for models without importances."""
    classifier = model.stages[-1]
    if not hasattr(classifier, "featureImportances"):
        return None
    values = classifier.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(FEATURE_COLS, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def training_pairs(sessions: DataFrame, cfg: dict[str, Any]) -> DataFrame:
    """Sampled, numbered and split pairs with features, materialised once.

    Sampling feeds several passes (ranks, split sizes, joins), so the narrow pair table is
    written before the wide join and the feature table after it.
    """
    identity, seed = cfg["identity"], cfg["data"]["random_seed"]
    pairs = materialised(
        sample_pairs(sessions, identity["n_pairs_per_user"], identity["neg_pos_ratio"], seed), "pairs"
    )
    split = stratified_split(number_pairs(pairs, seed), identity["test_size"], seed)
    return materialised(build_feature_matrix(split, sessions), "features")


def fit_on(features: DataFrame, name: str, cfg: dict | None = None) -> PipelineModel:
    """Fit scaler and classifier on the rows of the train split."""
    ensure_checkpoint_dir(features.sparkSession)
    train = features.where(F.col("split") == "train").select("label", *FEATURE_COLS)
    sizes = label_sizes(train)
    return matching_pipeline(name, cfg, sum(sizes.values())).fit(with_balanced_weights(train, sizes))


def identity_pairs(scored: DataFrame) -> DataFrame:
    """The persisted pair table contract."""
    return scored.select(
        "pair_id", "session_id_a", "session_id_b", "label", "probability", "predicted_label", "split"
    )


def train_identity_model(
    sessions: DataFrame, cfg: dict[str, Any] | None = None, features: DataFrame | None = None
) -> IdentityResult:
    """Sample, featurise, split, fit on train, score everything, evaluate on test."""
    cfg = make_config(cfg)
    identity = cfg["identity"]
    name, threshold = identity["model"], identity["threshold"]
    if name not in _ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(_ESTIMATORS)}")
    features = training_pairs(sessions, cfg) if features is None else features
    model = fit_on(features, name, identity)
    scored = score(features, model, threshold)
    pairs = materialised(identity_pairs(scored), "scored")
    test = pairs.where(F.col("split") == "test")
    n_train = pairs.where(F.col("split") == "train").agg(F.count(F.lit(1))).scalar()
    auc = roc_auc(test).select("roc_auc").scalar()
    metrics = classification_metrics(test, threshold).select(
        F.lit(name).alias("model"), "*", round_half_up(auc, 4).alias("roc_auc"), n_train.alias("n_train")
    )
    return IdentityResult(
        model=model,
        model_name=name,
        pairs=pairs,
        test_predictions=test,
        metrics=metrics,
        confusion_matrix=confusion_matrix(test),
        feature_importance=feature_importance(model, sessions.sparkSession),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict_match(
    pairs: DataFrame, sessions: DataFrame, model: PipelineModel, threshold: float = 0.50, strict: bool = True
) -> DataFrame:
    """Score given id pairs: ``probability`` and boolean ``is_same_user``.

    Ids that are missing or not unique raise KeyError; with ``strict=False`` every pair comes back
    once, flagged, and such pairs have null results.
    """
    ids = pairs.select("session_id_a", "session_id_b")
    if strict:
        require_known_sessions(ids, sessions)
        known = ids
    else:
        ids = ids.distinct()
        checked = checked_pairs(ids, sessions)
        known = checked.where("NOT unknown_session AND NOT ambiguous_session").select(*ids.columns)
    scored = score(build_feature_matrix(known, sessions), model, threshold).select(
        "session_id_a", "session_id_b", "probability", (F.col("predicted_label") == 1).alias("is_same_user")
    )
    return scored if strict else checked.join(scored, ["session_id_a", "session_id_b"], "left")
