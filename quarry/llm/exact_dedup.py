"""Exact deduplication over a persistent digest index (DataFrame operations only).

The index is a table ``(digest, keep_id, n_chars, group_size)`` bucketed and
sorted by the digest. A new batch is reduced to one row per digest (partial
aggregation, so a text that makes up a third of the batch costs one row per
task), anti-joined with the index by sort-merge, and the unknown digests are
appended; what a batch changes about known digests is appended beside them and merged
on reading. The bucketed index is never shuffled.

Defined cases: null texts count as empty; texts are equal when identical after
the removal of every white-space character of ``[\\x20\\x09-\\x0D]``; ties on
length go to the smallest id; a null id loses to any other; rows that repeat one
id with equal text are one document; an empty batch appends nothing; columns
besides the id and the text pass through untouched.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.store import saved
from quarry.session import default_parallelism, scratch_path

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def text_digest(text_col: str = "text"):
    """SHA-256 (32 bytes) of the text without its white space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE_SPACE, ""), 256))


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, n_chars)``, one narrow row per document."""
    return docs.select(
        F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"))


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays, its length, and the group's size."""
    groups = rows.groupBy("digest").agg(
        F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("k"))).alias("best"),
        F.sum("group_size" if "group_size" in rows.columns else F.lit(1)).cast("long").alias("group_size"))
    return groups.select("digest", F.bitwise_not("best.k").alias("keep_id"),
                         F.col("best.n_chars").alias("n_chars"), "group_size")


class DigestIndex:
    """A digest index in the shared folder; the same ``path`` opens it again later.

    Its number of buckets is stored beside it and read on opening; asking for another one raises, as
    the rows of a bucket would be looked for in the wrong file. What a later batch adds to a known digest
    (copies, or a longer text) is appended to a table of changes and merged in on reading.
    """

    SCHEMA = "digest BINARY, keep_id BIGINT, n_chars BIGINT, group_size BIGINT"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.changes, layout = f"{self.path}-changes", f"{self.path}-layout"
        stored = self._read(layout, "buckets INT")
        if stored is not None:
            self.buckets = stored.first()[0]
            if buckets not in (None, self.buckets):
                raise ValueError(f"{self.path} has {self.buckets} buckets, not {buckets}")
        else:
            self.buckets = buckets or default_parallelism(spark)
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(layout)
        self.table = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:32]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.SCHEMA}) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")

    def _read(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def close(self) -> None:
        """Take the table out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _known(self) -> DataFrame:
        return self.spark.table(self.table).select("digest").hint("merge")

    def unknown(self, rows: DataFrame) -> DataFrame:
        """One row per digest of ``rows`` that the index lacks: the row that stays, and the group's size."""
        return _groups(rows).join(self._known(), "digest", "left_anti")

    def add(self, rows: DataFrame) -> DataFrame:
        """Append the unknown digests of a batch, and the changes to known ones; returns the unknown ones."""
        fresh = saved(self.unknown(rows), "digest-batch")
        more = _groups(rows).join(self._known(), "digest", "left_semi")
        more.write.mode("append").parquet(self.changes)
        (fresh.repartition(self.buckets, "digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path)
         .saveAsTable(self.table))
        return fresh

    def groups(self) -> DataFrame:
        """The whole index with its changes, read as plain files: joined with rows, both sides are
        shuffled, so AQE splits a digest that has a large part of all rows."""
        schema = self.spark.table(self.table).schema
        base, changes = self.spark.read.schema(schema).parquet(self.path), self._read(self.changes, self.SCHEMA)
        if changes is None:
            return base
        return _groups(base.union(changes).withColumnRenamed("keep_id", "doc_id"))


def members(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Rows of :func:`digest_rows` that are in the index, with their groups over all batches."""
    return rows.select("doc_id", "digest").join(index.groups(), "digest").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def memberships(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Add ``docs`` to ``index`` and return one row per document with its group."""
    rows = saved(digest_rows(docs), "digest-rows")
    index.add(rows)
    return members(rows, index)


def memberships_in_batches(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """:func:`memberships` with the documents dealt into two batches by a hash of their id."""
    rows = saved(digest_rows(docs), "digest-rows")
    second = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 1, F.lit(False))
    index.add(rows.where(~second))
    index.add(rows.where(second))
    return members(rows, index)


def deduplicated(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents of a batch that stay: unknown to the index, best of their batch.

    All columns are returned as they came. The batch is joined on digest and id
    together, so no group of copies meets in one task.
    """
    fresh = index.add(saved(digest_rows(docs), "digest-rows"))
    keep = fresh.select(F.col("digest").alias("__quarry_kept"), F.col("keep_id").alias("__quarry_id"))
    marked = docs.select("*", text_digest().alias("__quarry_digest"))
    on = (marked["__quarry_digest"] == keep["__quarry_kept"]) & marked["doc_id"].eqNullSafe(keep["__quarry_id"])
    return marked.join(keep, on, "left_semi").select(*[marked[f"`{c}`"] for c in docs.columns])


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
