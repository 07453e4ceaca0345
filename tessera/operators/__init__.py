"""Reusable relational operators built from DataFrame primitives."""

from tessera.operators.keyed import dedupe_by_key, top_k_per_group
from tessera.operators.metrics import best_candidate, join_actual_predicted, rmse
from tessera.operators.positional import cycled_zip, global_row_number
from tessera.operators.skew import skew_join

__all__ = [
    "dedupe_by_key", "top_k_per_group",
    "best_candidate", "join_actual_predicted", "rmse",
    "cycled_zip", "global_row_number",
    "skew_join",
]
