"""Text sources and sinks.

* header CSV (RFC 4180 quoting, UTF-8): the tree tables of the counting queries;
* ``userId::itemId::rating::timestamp`` records: the ratings of the recommender;
* ragged baskets ``key,item,item,…``: the plant/state baskets of the itemset and
  clustering operators.

All parsing is ``split`` / ``try_cast`` on the JVM; line order, where it matters,
comes from the file metadata columns, never from a driver-side ``zip``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.exprs import csv_line
from quarry.session import saved, scratch_path


def _literal_pattern(sep: str) -> str:
    # ``split`` takes a Java regex; quote the separator so any text works.
    return "\\Q" + sep + "\\E"


def _as_type(t) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Header CSV: the header is not a row; quoted values may hold commas.

    Quoted values that hold a newline need ``multi_line``: a file is then read by
    one task, as no split can tell whether it begins inside quotes.
    """
    reader = (spark.read.option("header", True).option("encoding", encoding)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line))
    if schema is not None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    df = reader.csv(path)
    # a UTF-8 byte-order mark would otherwise stick to the first header name
    renames = {c: c.lstrip("\ufeff") for c in df.columns if c.startswith("\ufeff")}
    for old, new in renames.items():
        df = df.withColumnRenamed(old, new)
    return df


def write_header_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def _with_line_order(df: DataFrame) -> DataFrame:
    """Columns that sort rows into file order: file, split start, position."""
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )


LINE_ORDER = ["_file", "_block", "_pos"]

#: Splits whose line offsets are broadcast (some 50 bytes each); a larger table takes the shuffled way.
BROADCAST_SPLITS = 1_000_000


def with_line_ids(lines: DataFrame, id_col: str = "id", broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """Contiguous 0-based ids in file order for rows with the columns of ``LINE_ORDER``; the rows do not move.

    A file's lines are already in order inside a split, so only the splits are counted
    (one narrow row each) and their counts summed up in file order. A line's id is its split's
    offset plus its place in the split. The offsets are broadcast where their table has
    at most ``broadcast_splits`` rows, else joined. The scan deals splits to partitions in the
    same way both times; if it ever did not, the job fails instead of numbering wrongly.

    ``lines`` must come from a scan without a shuffle; a filter of lines belongs after the ids.
    """
    part = F.shiftright("_pos", 33)
    counts = lines.select(*LINE_ORDER).groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"), F.max(part).alias("_last"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of 128 MB or more: a window over all of them is a small task
    offsets = saved(counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        "_whole", F.shiftright("_first", 33) == F.col("_last")), "line-offsets")
    small = offsets.limit(broadcast_splits + 1).count() <= broadcast_splits
    joined = lines.join(F.broadcast(offsets) if small else offsets, ["_file", "_block"], "left")
    place = F.col("_pos") - F.col("_first")
    sound = F.coalesce(F.col("_whole") & (place >= 0) & (place < F.col("_n")), F.lit(False))
    ident = F.when(sound, F.col("_off") + place).otherwise(
        F.raise_error(F.lit("the splits of the files were dealt out anew between two scans")).cast("long"))
    return joined.withColumn(id_col, ident.cast("long")).drop(*LINE_ORDER, "_n", "_first", "_last", "_off", "_whole")


def read_delimited_records(spark: SparkSession, path: str, fields: list[tuple[str, object]],
                           sep: str = "::", mode: str = "fail") -> DataFrame:
    """Records split on a (multi-character) separator into typed columns.

    ``mode="fail"`` aborts the job on a line with too few fields or a value
    that does not convert (as the reference's ``int()`` does); ``"drop"``
    skips such lines. Extra trailing fields are ignored.
    """
    if mode not in ("fail", "drop"):
        raise ValueError("mode must be 'fail' or 'drop'")
    value = F.col("value")
    parts = F.split(value, _literal_pattern(sep), -1)
    typed: list[Column] = []
    ok = F.size(parts) >= F.lit(len(fields))
    for i, (name, t) in enumerate(fields):
        dt = _as_type(t)
        raw = F.get(parts, F.lit(i))  # NULL, not an error, on a short line
        if isinstance(dt, T.StringType):
            c = raw
        else:
            c = raw.try_cast(dt)
            ok = ok & c.isNotNull()
        typed.append(c.alias(name))
    lines = spark.read.text(path)
    if mode == "fail":
        guard = F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("malformed record: "), value)))
        lines = lines.where(guard)
    else:
        lines = lines.where(ok)
    return lines.select(*typed)


@dataclass
class ParsedRecords:
    """What one pass over record files gave: typed rows, rejected lines, and how many of each.

    ``rejects`` has ``line``, ``reason``, ``field`` (the first field that failed, null for a short line) and ``file``;
    ``counts`` the number of good rows under ``good`` and of rejected lines under their reasons.
    """
    good: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


SHORT, NOT_A_VALUE, OUT_OF_RANGE = "too few fields", "not a value", "out of range"


def parse_delimited_records(spark: SparkSession, path: str, fields: list[tuple[str, object]],
                            sep: str = "::") -> ParsedRecords:
    """Records as :func:`read_delimited_records` reads them, with the lines that do not fit beside them.

    The files are parsed once: good and rejected rows are written to one table that is partitioned by
    the outcome, and the counts are observed in the same job. A line is rejected for having too few
    fields, for the first value that is none of its type, or (whole numbers) for one that its type cannot hold.
    """
    line = F.col("value")
    parts = F.split(line, _literal_pattern(sep), -1)
    typed, reason, field = [], F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, t) in reversed(list(enumerate(fields))):
        dt, raw = _as_type(t), F.get(parts, F.lit(i))
        value = raw if isinstance(dt, T.StringType) else raw.try_cast(dt)
        typed.insert(0, value.alias(name))
        if not isinstance(dt, T.StringType):
            whole = F.trim(raw).rlike("^[+-]?[0-9]+$") if isinstance(dt, T.IntegralType) else F.lit(False)
            reason = F.when(value.isNull(), F.when(whole, OUT_OF_RANGE).otherwise(NOT_A_VALUE)).otherwise(reason)
            field = F.when(value.isNull(), F.lit(name)).otherwise(field)
    short = F.size(parts) < len(fields)
    reason = F.when(short, SHORT).otherwise(reason)
    rows = spark.read.text(path).select(
        F.struct(*typed).alias("record"), reason.alias("reason"), F.when(~short, field).alias("field"),
        F.when(reason.isNotNull(), line).alias("line"),
        F.when(reason.isNotNull(), F.col("_metadata.file_path")).alias("file"),
        reason.isNotNull().alias("rejected"))
    seen = Observation("parsed records")
    names = [SHORT, NOT_A_VALUE, OUT_OF_RANGE]
    rows = rows.observe(seen, F.count_if(~F.col("rejected")).alias("good"),
                        *(F.count_if(F.col("reason") == r).alias(r) for r in names))
    schema, table = rows.schema, scratch_path(spark, "parsed-records")
    rows.write.option("compression", "zstd").partitionBy("rejected").parquet(table)
    parsed = spark.read.schema(schema).parquet(table)
    return ParsedRecords(parsed.where("not rejected").select("record.*"),
                         parsed.where("rejected").select("line", "reason", "field", "file"), dict(seen.get))


def write_delimited_records(df: DataFrame, path: str, sep: str = "::") -> None:
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *cols).alias("value")).write.text(path)


def read_ragged_baskets(spark: SparkSession, path: str, sep: str = ",",
                        key_col: str = "key", items_col: str = "items",
                        keep_line_order: bool = False) -> DataFrame:
    """Ragged lines: field 0 is the key, the remaining fields (in file order)
    the items. A line with one field has no items.

    With ``keep_line_order`` the columns of ``LINE_ORDER`` are kept so that a
    contiguous id in file order can be assigned (``operators.ids``).
    """
    lines = spark.read.text(path)
    if keep_line_order:
        lines = _with_line_order(lines)
    parts = F.split(F.col("value"), _literal_pattern(sep), -1)
    out = [parts.getItem(0).alias(key_col),
           F.slice(parts, 2, F.size(parts) - 1).alias(items_col)]
    if keep_line_order:
        out += LINE_ORDER
    return lines.select(*out)


def write_ragged_baskets(df: DataFrame, key_col: str, items_col: str, path: str,
                         sep: str = ",") -> None:
    # concat_ws flattens an array argument into its elements.
    df.select(F.concat_ws(sep, F.col(key_col).cast("string"),
                          F.col(items_col)).alias("value")).write.text(path)


def write_csv_lines(df: DataFrame, path: str) -> None:
    """Sink of the unquoted CSV-line format (one text file per partition)."""
    df.select(csv_line(df).alias("value")).write.text(path)
