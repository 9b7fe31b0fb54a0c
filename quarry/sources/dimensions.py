"""Small literal dimensions (S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The state / province codes that form the entity dimension of
# the plant baskets, in the order the reference lists them. Items of a basket
# outside this list (e.g. "pe") are not entities.
STATE_CODES = [
    "ab", "ak", "ar", "az", "ca", "co", "ct", "de", "dc", "fl",
    "ga", "hi", "id", "il", "in", "ia", "ks", "ky", "la", "me", "md",
    "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj", "nm",
    "ny", "nc", "nd", "oh", "ok", "or", "pa", "pr", "ri", "sc", "sd",
    "tn", "tx", "ut", "vt", "va", "vi", "wa", "wv", "wi", "wy", "al",
    "bc", "mb", "nb", "lb", "nf", "nt", "ns", "nu", "on", "qc", "sk",
    "yt", "dengl", "fraspm",
]


def entity_dimension(spark: SparkSession, values: list[str] | None = None,
                     entity_col: str = "entity") -> DataFrame:
    """(entity, ordinal) from a literal list, ordinal = position in the list."""
    vals = STATE_CODES if values is None else values
    schema = T.StructType([T.StructField(entity_col, T.StringType(), False),
                           T.StructField("ordinal", T.IntegerType(), False)])
    return spark.createDataFrame([(v, i) for i, v in enumerate(vals)], schema)
