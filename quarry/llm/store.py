"""Intermediate tables of the training-data operators.

Every table that several steps read is written as Parquet under the folder that
``spark.checkpoint.dir`` names, through Spark's own writer: a lost executor or a
retried task leaves either a whole committed file or none.
"""

from __future__ import annotations

from quarry.session import forget, saved

__all__ = ["forget", "saved"]
