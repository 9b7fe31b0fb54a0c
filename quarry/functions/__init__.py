"""Column expressions shared by the operators (all JVM-side built-ins)."""

from quarry.functions.exprs import (
    csv_line,
    hash_bucket,
    is_nonempty,
    joined,
    py_str,
    rmse_expr,
    seeded_order,
)

__all__ = [
    "csv_line", "hash_bucket", "is_nonempty", "joined", "py_str",
    "rmse_expr", "seeded_order",
]
