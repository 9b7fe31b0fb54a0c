"""Byte-level BPE encoding and decoding by a rank file.

Two tiers: a minimal perfect hash over the vocabulary resolves whole pre-tokens
that are vocabulary entries; every other pre-token is merged by a heap of pair
ranks over a doubly linked list of its bytes. Distinct pre-tokens are looked up
once per batch and remembered by the worker in a bounded table, a cache only.

Defined cases: null texts are empty; an empty text has no ids; very long texts
are encoded in pieces cut where no token can span; repeated rows are encoded
each; extra columns are ignored; an empty table gives an empty result. Control
strings of other vocabularies are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import pretokens
from quarry.llm.arrow import map_batches, text_rows


class MinimalPerfectHash:
    """Hash and displace: n keys in n slots. Keys are 64-bit hashes.

    Buckets of two and more keys look for a displacement that puts all their keys
    into free slots, largest bucket first; single keys then take what is left.
    """

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.n, self.m = n, max(1, n // 3)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.m + 1))
        size = np.diff(edges)
        self.shift = np.zeros(self.m, np.int64)  # displacement, or -1 - slot for a single key
        taken = np.zeros(n, bool)
        tries = np.arange(64, dtype=np.uint64)[:, None]
        for b in np.argsort(-size, kind="stable"):
            own = keys[order[edges[b]:edges[b + 1]]]
            if len(own) < 2:
                break
            d = 0
            while True:
                at = np.sort(self._slot(own[None, :], tries + np.uint64(d)), axis=1)
                good = ~taken[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
                if good.any():
                    self.shift[b] = d + int(good.argmax())
                    taken[at[good.argmax()]] = True
                    break
                d += len(tries)
        single = np.flatnonzero(size == 1)
        self.shift[single] = -1 - np.flatnonzero(~taken)[:len(single)]

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(20)) % np.uint64(self.m)).astype(np.int64)

    def _slot(self, keys: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = (keys ^ (d + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((x ^ x >> np.uint64(33)) % np.uint64(self.n)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that was not given gets some slot."""
        d = self.shift[self._bucket(keys)]
        return np.where(d < 0, -1 - d, self._slot(keys, np.maximum(d, 0).astype(np.uint64)))


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked, then leftmost pair is merged first."""
    if data in ranks:
        return [ranks[data]]
    n = len(data)
    end = list(range(1, n + 1))  # the part that starts at i ends before end[i]
    left = list(range(-1, n - 1))  # the part before it starts there
    heap, get = [], ranks.get
    for i in range(n - 1):
        r = get(data[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        mid = end[i]
        if mid < 0 or mid >= n or end[mid] != stop:
            continue  # one of the two parts has been merged meanwhile
        end[i], end[mid] = stop, -1
        if stop < n:
            left[stop] = i
            r = get(data[i:end[stop]])
            if r is not None:
                push(heap, (r, i, end[stop]))
        j = left[i]
        if j >= 0:
            r = get(data[j:stop])
            if r is not None:
                push(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[data[i:end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """The ranks of a file, the first tier's hash, and the bytes of every id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
        words = {}
        for key, rank in self.ranks.items():
            try:
                words[key.decode()] = rank
            except UnicodeDecodeError:
                continue  # a part of a character is never a whole pre-token
        names = list(words)
        cps = pretokens.code_points("".join(names))
        size = np.array([len(x) for x in names])
        stop = np.cumsum(size)
        h = pretokens.span_hashes(cps, stop - size, stop)
        self.slot_of = MinimalPerfectHash(h)
        slots = self.slot_of(h)
        self.word, self.id = [""] * len(h), np.zeros(len(h), np.int64)
        self.id[slots] = list(words.values())
        for s, name in zip(slots.tolist(), names):
            self.word[s] = name
        by_id = {v: k for k, v in self.ranks.items()}
        parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.size = np.array([len(p) for p in parts])
        self.offset = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.memory = pretokens.Memory(self.resolve, np.int32)

    def resolve(self, hashes: np.ndarray, tokens: list[str]) -> list[list[int]]:
        """Ids of distinct pre-tokens: the vocabulary's slot if it holds the very token, else merges."""
        slots = self.slot_of(hashes)
        word, ranks = self.word, self.ranks
        return [[one] if word[slot] == token else merged(token.encode(), ranks)
                for token, slot, one in zip(tokens, slots.tolist(), self.id[slots].tolist())]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and each text's number of ids."""
        return pretokens.encode(texts, self.memory)

    def decode(self, ids: np.ndarray) -> bytes:
        return pretokens.ragged_take(self.bytes, self.offset[ids], self.size[ids]).tobytes()


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process; built from the file in about a second."""
    return Vocabulary(path)


def encoded(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` per row, in the input's partitions (no shuffle)."""
    def run(batches):
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            for rows in pretokens.batches(text_rows(batch, "doc_id", "text")):
                ids, counts = vocab.encode([t for _, t in rows])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in rows], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids))],
                    names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Encode, decode the ids again, and return both digests per document."""
    def run(batches):
        vocab = vocabulary(vocabulary_path)
        names = np.array([str(i) for i in range(len(vocab.size))], object)
        for batch in batches:
            doc_ids, counts, coded, decoded = [], [], [], []
            for rows in pretokens.batches(text_rows(batch, "doc_id", "text")):
                ids, n = vocab.encode([t for _, t in rows])
                at = 0
                for (d, _), k in zip(rows, n.tolist()):
                    own = ids[at:at + k]
                    at += k
                    doc_ids.append(d)
                    coded.append(hashlib.sha256(",".join(names[own].tolist()).encode()).hexdigest())
                    decoded.append(hashlib.sha256(vocab.decode(own)).hexdigest())
                counts += n.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
