"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is compressed piece by piece (PIECE bytes) with each of them; the
normalised difference of the compressed sizes, ``(bad - good) / (bad + good)``,
together with the compression ratio under both, goes through a logistic function
fitted on other labelled texts (the calibration half), which gives the score.

Fitting reads at most SAMPLE labelled documents of each class, chosen by a hash
of their id: one half gives up to PIECES_PER_TEXT pieces each to a dictionary,
the other half is compressed whole for the calibration; the classes are weighted
by their size among all labels. Every document is scored on its whole text.

Defined cases: null texts are empty; an empty text has difference 0 and ratio 1;
labels other than 0 and 1 and null ids are not learned from; an id with several
labels counts as its smallest; with no text of one class the score is the share
of label 1 (0.5 without labels); an empty table gives an empty result; columns
besides the id and the text never enter a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches, text_rows
from quarry.llm.store import saved

SAMPLE, PIECE, PIECES_PER_TEXT, DICTIONARY_BYTES, LEVEL = 2000, 512, 8, 112_640, 3
_FRAME = 6  # bytes of every frame's head


def held_out(id_col: str = "doc_id"):
    """The rows that no label is learned from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


@dataclass
class Compressors:
    """The two dictionaries, as bytes; compressors are made in each task."""

    good: bytes
    bad: bytes

    def __post_init__(self):
        self._made = None

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "_made": None}

    def measure(self, text: str) -> tuple[float, float]:
        """Normalised size difference, and the log of the compression ratio."""
        if self._made is None:
            self._made = []
            for d in (self.good, self.bad):
                z = zstandard.ZstdCompressionDict(d)
                z.precompute_compress(level=LEVEL)
                self._made.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=z, write_content_size=False, write_checksum=False, write_dict_id=False))
        raw = text.encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0, 0.0
        good, bad = self._made
        g = b = 0
        for at in range(0, len(raw), PIECE):
            piece = raw[at:at + PIECE]
            g += len(good.compress(piece)) - _FRAME
            b += len(bad.compress(piece)) - _FRAME
        return (b - g) / (b + g), float(np.log((b + g) / (2 * len(raw)) + 1e-3))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples' own bytes where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _inputs(difference: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(difference), 10 * difference, ratio, ratio * ratio], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted ridge logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 2 * (w @ w)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step, size = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge * w), 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    compressors: Compressors | None
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.compressors is None:
            return np.full(len(texts), float(self.weights[0]))
        m = np.array([self.compressors.measure(t) for t in texts], float).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(_inputs(m[:, 0], m[:, 1]) @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the labelled documents that are not held out."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    known = saved(known, "quality-labels")
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = None
    for y in (0, 1):
        own = known.where(F.col("quality") == y).orderBy(order, "doc_id").limit(sample)
        chosen = own if chosen is None else chosen.union(own)
    # at most 2 * sample ids and labels: the bound of this broadcast
    text = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    text = text.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    text = saved(text.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))), "quality-sample")

    piece_starts = F.expr(f"transform(sequence(0, {PIECES_PER_TEXT - 1}), i -> cast(i * greatest(1, "
                          f"length(text) / {PIECES_PER_TEXT}) as int))")
    cut = text.where("half = 0 and text <> ''").select("doc_id", "quality", F.transform(
        piece_starts, lambda at: F.col("text").substr(at + 1, F.lit(PIECE))).alias("pieces"))
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    # at most 2 * sample * PIECES_PER_TEXT pieces, in the order of their ids
    for r in sorted(cut.collect(), key=lambda r: r["doc_id"]):
        samples[r["quality"]] += [p.encode() for p in r["pieces"] if p]
    if not samples[0] or not samples[1]:
        share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
        return Model(None, np.array([share]))
    compressors = Compressors(dictionary(samples[1]), dictionary(samples[0]))

    schema = pa.schema([("quality", pa.int32()), ("difference", pa.float64()), ("ratio", pa.float64())])

    def run(batches):
        for batch in batches:
            yield columns([(y, *compressors.measure(t)) for y, t in text_rows(batch, "quality", "text")], schema)

    calibration = text.where("half = 1")
    if calibration.isEmpty():
        calibration = text
    rows = map_batches(calibration.select("quality", "text"), run,
                       "quality int, difference double, ratio double").collect()  # at most 2 * sample rows
    y, difference, ratio = (np.array(c, float) for c in zip(*rows))
    weight = np.ones(len(y))
    for k in (0, 1):
        if (y == k).any():
            weight[y == k] = totals[k] / sum(totals.values()) * len(y) / (y == k).sum()
    return Model(compressors, logistic(_inputs(difference, ratio), y, weight))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row, without a shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            rows = list(text_rows(batch, "doc_id", "text"))
            yield columns(list(zip([d for d, _ in rows], model.scores([t for _, t in rows]).tolist())), schema)

    out = map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with all their columns (no shuffle)."""
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield batch.filter(pa.array(model.scores(texts) >= 0.5, pa.bool_()))

    return map_batches(docs, run, docs.schema)
