"""Default settings of the end-to-end job, overridable per section."""

from __future__ import annotations

import copy

# Sampling, model and segmentation defaults.
DEFAULTS: dict = {
    "data": {"random_seed": 42, "sample_size": 5000},
    "identity": {
        "model": "random_forest",
        "n_pairs_per_user": 3,
        "neg_pos_ratio": 1.5,
        "test_size": 0.20,
        "threshold": 0.50,
        "rf_params": {"n_estimators": 200, "max_depth": 12, "min_samples_leaf": 5, "random_state": 42},
        "xgb_params": {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.05, "random_state": 42},
    },
    "nlp": {"embedding_dim": 384},
    # buckets of the catalog's session tables; None means one per shuffle partition
    "storage": {"session_buckets": None},
    "segmentation": {
        "n_clusters": 10,
        "kmeans_init": "k-means||",
        "kmeans_max_iter": 500,
        "kmeans_random_state": 42,
        "kmeans_restarts": 10,
        "search_restarts": 5,
        "top_keywords_per_segment": 8,
        "k_search_range": [6, 7, 8, 9, 10, 11, 12],
    },
}


def make_config(overrides: dict | None = None) -> dict:
    """Defaults with ``overrides`` merged in, section by section."""
    merged = copy.deepcopy(DEFAULTS)
    for section, values in (overrides or {}).items():
        if isinstance(values, dict):
            base = merged.setdefault(section, {})
            for key, value in values.items():
                if isinstance(value, dict) and isinstance(base.get(key), dict):
                    base[key] = {**base[key], **value}
                else:
                    base[key] = value
        else:
            merged[section] = values
    return merged
