"""Token-id files with byte planes: encode, write, read back.

File format. Documents are encoded in ascending id order, cut into ranges of ids
(parts); each part's ids are cut into chunks of CHUNK ids, the last one shorter.
A chunk's payload is ``TPL1``, its number of ids, the four compressed sizes (all
unsigned 32-bit little endian), and four zstandard frames: byte plane p holds
byte p of every id, lowest first. Chunks are rows ``(part, chunk, n_ids, docs,
payload)`` of Parquet files that Spark commits, so that a retried task or a lost
executor leaves no half file in the shared folder; ``docs`` lists the pieces of
documents in the chunk (ordinal within the part, id, number of ids). The chunk
index ``(part, chunk, first_id, n_ids, bytes)`` is a second table: a position
leads to one chunk, and a chunk is decoded alone.

Defined cases: null texts are empty and have the end id only; null ids come
first; rows that repeat an id follow each other by text; an empty table writes
no chunk; texts of any length span chunks; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import pretokens
from quarry.llm.arrow import columns, map_batches, text_rows
from quarry.llm.store import saved
from quarry.session import default_parallelism

#: Ids per chunk.
CHUNK = 1 << 16
MAGIC = b"TPL1"
_CHUNK_ROW = "part int, chunk long, n_ids int, docs array<struct<ord: long, doc_id: long, n: int>>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """One chunk's payload."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    frames = [zstandard.ZstdCompressor(level=3).compress(p.tobytes()) for p in planes]
    return MAGIC + struct.pack("<5I", len(ids), *map(len, frames)) + b"".join(frames)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of one payload, as little-endian unsigned 32-bit integers."""
    if payload[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    n, *sizes = struct.unpack_from("<5I", payload, 4)
    at, planes = 24, np.empty((n, 4), np.uint8)
    for p, size in enumerate(sizes):
        raw = zstandard.ZstdDecompressor().decompress(payload[at:at + size], max_output_size=n)
        planes[:, p] = np.frombuffer(raw, np.uint8)
        at += size
    return planes.reshape(-1).view("<u4")


class LibraryEncoder:
    """The ``tokenizers`` library, asked once for each distinct pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memory = pretokens.Memory(self.resolve, np.int32)

    def resolve(self, _, tokens: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return pretokens.encode(texts, self.memory)


@cache
def library_encoder(path: str) -> LibraryEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return LibraryEncoder(path)


def written(docs: DataFrame, tokenizer_path: str, end_id: int, parts: int | None = None) -> DataFrame:
    """Encode, append ``end_id`` to each document, write the chunks; returns the chunk table."""
    def run(batches):
        encoder, part = library_encoder(tokenizer_path), TaskContext.get().partitionId()
        held, pieces, size, chunk, ordinal = [], [], 0, 0, 0

        def row(ids):
            own, left = [], len(ids)
            while left:
                o, d, n = pieces[0]
                take = min(n, left)
                own.append({"ord": o, "doc_id": d, "n": take})
                left -= take
                if take == n:
                    pieces.pop(0)
                else:
                    pieces[0] = (o, d, n - take)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "chunk": chunk, "n_ids": len(ids), "docs": own, "payload": pack(ids)}], schema=schema)

        schema = pa.schema([
            ("part", pa.int32()), ("chunk", pa.int64()), ("n_ids", pa.int32()),
            ("docs", pa.list_(pa.struct([("ord", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32())]))),
            ("payload", pa.binary())])
        for batch in batches:
            for rows in pretokens.batches(text_rows(batch, "doc_id", "text")):
                ids, counts = encoder.encode([t for _, t in rows])
                held.append(np.insert(ids, np.cumsum(counts), end_id))
                for (d, _), n in zip(rows, counts.tolist()):
                    pieces.append((ordinal, d, n + 1))
                    ordinal += 1
                size += len(held[-1])
                if size >= CHUNK:
                    ids = np.concatenate(held)
                    full = len(ids) // CHUNK * CHUNK
                    for at in range(0, full, CHUNK):
                        yield row(ids[at:at + CHUNK])
                        chunk += 1
                    held, size = [ids[full:]], len(ids) - full
        if size:
            yield row(np.concatenate(held))

    parts = parts or default_parallelism(docs.sparkSession)
    rows = (docs.select(F.col("doc_id").cast("long"), "text")
            .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))
    return saved(map_batches(rows, run, _CHUNK_ROW), "token-chunks")


def chunk_index(chunks: DataFrame) -> DataFrame:
    """``(part, chunk, first_id, n_ids, bytes)``: where each chunk's ids stand in the whole output."""
    sizes = chunks.select("part", "chunk", "n_ids", F.length("payload").alias("bytes"))
    # one row per part: the only rows that are ordered in one task
    before = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    upto = F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk"))
    return saved(sizes.withColumn("upto", upto).join(before, "part").select(
        "part", "chunk", (F.col("before") + F.col("upto") - F.col("n_ids")).alias("first_id"),
        "n_ids", "bytes"), "token-index")


def _times_x(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, bits reflected."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of a concatenation from ``(crc, number of bytes)`` of its parts."""
    total = 0
    for crc, size in parts:
        power, base, n = 1 << 31, 1 << 30, 8 * size  # 1, x, and the exponent
        while n:
            if n & 1:
                power = _times_x(power, base)
            base = _times_x(base, base)
            n >>= 1
        total = _times_x(power, total) ^ crc
    return total


def read_back(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the written files, each chunk decoded alone."""
    schema = pa.schema([("part", pa.int32()), *((c, pa.int64()) for c in ("ord", "doc_id", "chunk", "at", "n", "crc"))])

    def run(batches):
        for batch in batches:
            part, chunk, docs, payload = (batch.column(c).to_pylist() for c in ("part", "chunk", "docs", "payload"))
            out = []
            for p, c, own, raw in zip(part, chunk, docs, payload):
                ids, at = unpack(raw), 0
                for piece in own:
                    n = piece["n"]
                    out.append((p, piece["ord"], piece["doc_id"], c, at, n, zlib.crc32(ids[at:at + n].tobytes())))
                    at += n
            yield columns(out, schema)

    @F.pandas_udf("long")
    def joined(pieces):
        return pieces.map(lambda own: None if own is None else crc32_joined([(x["crc"], 4 * x["n"]) for x in own]))

    pieces = map_batches(
        chunks.select("part", "chunk", "docs", "payload"), run,
        "part int, ord long, doc_id long, chunk long, at long, n long, crc long")
    docs = pieces.groupBy("part", "ord").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("chunk", "at", "n", "crc"))).alias("pieces"))
    docs = docs.withColumn("chunk", F.col("pieces")[0]["chunk"]).withColumn("at", F.col("pieces")[0]["at"])
    # only the few documents that span chunks go to Python
    several = F.when(F.size("pieces") > 1, F.transform("pieces", lambda x: F.struct(x["crc"].alias("crc"), x["n"].alias("n"))))
    crc = F.coalesce(joined(several), F.col("pieces")[0]["crc"])
    return docs.join(index.select("part", "chunk", "first_id"), ["part", "chunk"]).select(
        "doc_id", (F.col("first_id") + F.col("at")).alias("start"), "n_tokens", crc.alias("ids_crc32"))
