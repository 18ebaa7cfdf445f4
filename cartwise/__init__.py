"""Purchase-recommendation analytics on Spark DataFrames.

Names are imported when they are first asked for: Python workers that unpickle a function of one module need
not hold the machine-learning API and what it imports (some 30 MB a worker).
"""

from importlib import import_module

__version__ = "0.1.0"

_NAMES = {
    "functions.expressions": ["add_baby_age_feature"],
    "operators.candidates": [
        "build_item_cooccurrence",
        "filter_already_purchased",
        "generate_candidates",
        "generate_candidates_from_cooc",
    ],
    "operators.evaluation": [
        "evaluate_ground_truth",
        "evaluate_ranking",
        "evaluate_recommendations",
        "mean_average_precision_at_k",
        "ndcg_at_k",
        "precision_at_k",
        "recall_at_k",
    ],
    "operators.features": ["build_feature_label_table", "customer_features", "training_candidates"],
    "operators.models": ["get_feature_importance", "load_model", "predict_and_rank", "save_model", "train_model"],
    "operators.segments": ["build_customer_segment_from_step1", "build_item_segment_step1"],
    "sources.readers": [
        "explore_dataset",
        "list_parquet_files",
        "load_any_parquet",
        "load_items",
        "load_transactions",
        "load_users",
    ],
    "sources.schemas": ["DataSchema", "validate_items", "validate_transactions", "validate_users"],
}
_HOMES = {name: module for module, names in _NAMES.items() for name in names}

__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    found = getattr(import_module(f"{__name__}.{_HOMES[name]}"), name)
    globals()[name] = found
    return found


def __dir__() -> list[str]:
    return sorted({*globals(), *__all__})
