"""Running Python over Arrow batches inside Spark tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import quarry

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors through Spark's file server, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(quarry.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quarry-ship-"), "quarry_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of the named columns; the last one is the text, null as empty. Few texts at a time are Python strings."""
    for at in range(0, batch.num_rows, 500):
        *others, texts = (batch.column(n).slice(at, 500) for n in names)
        yield from zip(*(c.to_pylist() for c in others), (t or "" for t in texts.to_pylist()))


def columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch from a list of rows."""
    values = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
