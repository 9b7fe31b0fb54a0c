"""Line deduplication with content-defined chunks.

A text's lines are hashed; a chunk ends after a line where the rolling hash of the
last ROLL line hashes is 0 modulo DIVISOR (or after MOST_LINES lines), once it has
two lines with words, so the same run of lines is soon cut alike wherever it
stands, whatever is inserted before it. A line of LONG_LINE words or more is a
chunk of its own. A chunk counts when it has two lines with words, or is such a
long line. Of every chunk that occurs more than
once in the corpus the first occurrence (smallest doc_id, then place) stays; the
others are removed after their bytes were compared with it. A chunk whose hash
only collides stays.

Both edges of a repeated passage fall into chunks that also hold lines around it, so
chunks alone leave them in. With ``passages``, the shortest runs of whole lines that
start (and that end) at each line with words and reach LONG_LINE words on two lines
with words are counted and compared like chunks. Such a run depends on its own lines
only, and those inside a repeated run of that length cover it from its first to its
last line with words, whatever stands around it. A line is then removed when it lies
in a repeated chunk or run of which an earlier occurrence exists; where an occurrence
overlaps the first one in its own document, the first one's lines stay.

Counting uses narrow rows (id, place, hash); texts move twice, both times joined
by document: once to fetch the repeated chunks for the comparison and once to cut
them out. A chunk that is in a third of all documents is partially aggregated for
its count, and AQE splits its joins, of which both sides are shuffled.

Defined cases: null texts are empty and have no line; texts without a newline have
one line; rows that repeat an id and its text are one document; a null id comes
before all others; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches
from quarry.llm.store import saved

ROLL, DIVISOR, MOST_LINES, LONG_LINE = 2, 2, 32, 50
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _line_hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), np.uint64, len(lines))


def chunks(text: str) -> list[tuple[int, int, bool]]:
    """``(first line, line after the last, counts)`` of each chunk of a text."""
    lines = text.split("\n")
    return _chunks(_line_hashes(lines), [len(x.split()) for x in lines])


def _chunks(h: np.ndarray, words: list[int]) -> list[tuple[int, int, bool]]:
    roll = h * _A
    for k in range(1, ROLL):
        roll[k:] = roll[k:] * _A + h[:-k] * _B
    roll = (roll ^ roll >> np.uint64(29)) * _B >> np.uint64(33)
    ends = (roll % np.uint64(DIVISOR) == 0).tolist()
    out, first, full = [], 0, 0  # full: lines with words in the open chunk
    for k, n in enumerate(words):
        long = n >= LONG_LINE
        if long and first < k:
            out.append((first, k, full > 1))
            first, full = k, 0
        full += n > 0
        if long or ends[k] and full > 1 or k - first + 1 >= MOST_LINES or k + 1 == len(words):
            out.append((first, k + 1, long or full > 1))
            first, full = k + 1, 0
    return out


def _runs(words: list[int]) -> set[tuple[int, int]]:
    """The shortest runs from each line on, and up to each line, of two lines with words and LONG_LINE words."""
    full = [k for k, n in enumerate(words) if n]
    upto = np.concatenate([[0], np.cumsum([words[k] for k in full], dtype=np.int64)])
    at = np.arange(len(full))
    last = np.maximum(np.searchsorted(upto, upto[:-1] + LONG_LINE) - 1, at + 1)
    first = np.minimum(np.searchsorted(upto, upto[1:] - LONG_LINE, side="right") - 1, at - 1)
    return ({(full[a], full[b] + 1) for a, b in enumerate(last.tolist()) if b < len(full)}
            | {(full[a], full[b] + 1) for b, a in enumerate(first.tolist()) if a >= 0})


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _on_document(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["r_doc"]) & (left["text_key"] == right["r_key"])


def chunk_hashes(keyed: DataFrame, passages: bool = False) -> DataFrame:
    """``(doc_id, text_key, first, after, hash)`` of the chunks that count, with ``passages`` also of the
    runs of passage length, written once."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int32()), ("after", pa.int32()),
                        ("hash", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = []
            for d, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                if "\n" not in text and len(text) < 2 * LONG_LINE - 1:
                    continue
                lines = text.split("\n")
                each, words = _line_hashes(lines), [len(x.split()) for x in lines]
                own = {(a, b) for a, b, counts in _chunks(each, words) if counts}
                if passages:
                    own |= _runs(words)
                for a, b in sorted(own):
                    h = xxhash.xxh3_64_intdigest(each[a:b].tobytes())
                    rows.append((d, key, a, b, h - (1 << 64) if h >> 63 else h))
            yield columns(rows, schema)

    return saved(map_batches(keyed, run, "doc_id long, text_key long, first int, after int, hash long"), "line-chunks")


def _with_ranges(keyed: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Documents joined with their list of line ranges."""
    own = ranges.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "after", "hash"))).alias("ranges")).select(
        F.col("doc_id").alias("r_doc"), F.col("text_key").alias("r_key"), "ranges")
    return keyed.join(own, _on_document(keyed, own), how).select("doc_id", "text_key", "text", "ranges")


def repeated(keyed: DataFrame, passages: bool = False) -> DataFrame:
    """``(doc_id, text_key, first, after, hash)`` of the chunks and runs to remove, their bytes compared."""
    found = chunk_hashes(keyed, passages)
    place = F.struct("doc_id", "first", "text_key")
    leaders = saved(found.groupBy("hash").agg(F.min(place).alias("lead"), F.count("*").alias("n"))
                    .where("n > 1").select("hash", "lead"), "line-leaders")
    several = saved(found.join(leaders, "hash").withColumn("leads", place == F.col("lead")).drop("lead"),
                    "line-repeated")
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int32()), ("after", pa.int32()),
                        ("hash", pa.int64()), ("chunk", pa.string())])

    def run(batches):
        for batch in batches:
            rows = []
            for d, key, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "ranges"))):
                lines = text.split("\n")
                rows += [(d, key, r["first"], r["after"], r["hash"], "\n".join(lines[r["first"]:r["after"]])) for r in own]
            yield columns(rows, schema)

    texts = saved(map_batches(_with_ranges(keyed, several, "inner"), run,
                              "doc_id long, text_key long, first int, after int, hash long, chunk string"), "line-texts")
    lead = leaders.select("hash", F.col("lead.doc_id").alias("l_doc"), F.col("lead.first").alias("l_first"),
                          F.col("lead.text_key").alias("l_key"))
    # one text per repeated chunk; repeated rows of the leading document are equal
    lead_text = saved(texts.join(lead, "hash").where(
        F.col("doc_id").eqNullSafe(F.col("l_doc")) & (F.col("first") == F.col("l_first"))
        & (F.col("text_key") == F.col("l_key"))).select("hash", F.col("chunk").alias("lead_chunk"))
        .dropDuplicates(["hash"]), "line-lead-texts")
    same = texts.join(lead_text, "hash").where("chunk = lead_chunk").select(
        "doc_id", "text_key", "first", "after", "hash")
    leading = lead.select("hash", F.col("l_doc").alias("d"), F.col("l_first").alias("f"), F.col("l_key").alias("k"))
    own = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    # runs overlap: the lines of the first occurrence stay
    first = F.when(own, F.greatest("first", F.col("f") + F.col("after") - F.col("first"))).otherwise(F.col("first"))
    return saved(same.join(leading, "hash").where(~(own & (F.col("first") == F.col("f"))))
                 .select("doc_id", "text_key", first.alias("first"), "after", "hash"), "line-removed")


def deduplicated(docs: DataFrame, passages: bool = False) -> DataFrame:
    """``(doc_id, n_lines, removed_lines, removed_chunks, text)`` per row of ``docs``.

    Repeated chunks are removed, with ``passages`` also repeated runs of passage
    length; pieces that overlap count as one in ``removed_chunks``.
    """
    keyed = _keyed(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("removed_lines", pa.int64()),
                        ("removed_chunks", pa.int64()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            rows = []
            for d, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
                lines, own = text.split("\n") if text else [], own or []
                out, at, pieces = [], 0, 0
                for r in own:
                    out += lines[at:r["first"]]
                    pieces += r["first"] >= at
                    at = max(at, r["after"])
                out += lines[at:]
                rows.append((d, len(lines), len(lines) - len(out), pieces, "\n".join(out) if own else text))
            yield columns(rows, schema)

    return map_batches(_with_ranges(keyed, repeated(keyed, passages), "left"), run,
                       "doc_id long, n_lines long, removed_lines long, removed_chunks long, text string")
