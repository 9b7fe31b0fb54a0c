"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set holds its distinct shingles of five words (words: runs of
characters outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased); with fewer words the
whole sequence is the one shingle; without words the set is empty and is linked
with nothing. Shingles are 64-bit hashes.

Sketch: COORDINATES bins are filled in rounds. In round ``i`` each shingle is
hashed to one bin with the value ``i`` plus a fraction, and a bin keeps its
smallest value; after COORDINATES rounds a further round per bin puts every
shingle into that bin, so no coordinate stays empty. As many bins are filled per
shingle as in sampling without replacement, which gives the concentration of
independent MinHash at about ``n + t log t`` hashes per set.

Candidates: bands of five coordinates (51 bands). Two sets of similarity 0.75
share no band with probability (1 - 0.75^5)^51 = 1e-6. Links are confirmed on the
full sets: ``100 * intersection >= 75 * union``.

Groups: equal sets are one class first. Inside a band's bucket no pairs are
listed: every member is compared with one leader, linked members become one
component, and only buckets that still hold several components go on with 16
times as many leaders, against members of other components, until each pair of
different components in a bucket has been compared. A pair is left out where its
link is impossible: documents of the open buckets that share a rare shingle (of at
most RARE of them) are compared anyway, so for all others the rare shingles bound
the intersection from above. A pair is listed in one of the buckets that it shares.
Before the full sets are compared, sketches that agree in less than ESTIMATE of
the coordinates are dropped (5.5 deviations below the threshold, about 2e-8 of
the links). Nothing else is capped or sampled.

Defined cases: null texts have empty sets; a null id is linked with nothing, has
no component and is kept; rows that share an id are one node; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches, text_rows
from quarry.llm.components import connected_components
from quarry.llm.store import forget, saved

WORDS, COORDINATES, BAND = 5, 256, 5
BANDS = COORDINATES // BAND
THRESHOLD = 75  # percent
#: Pairs whose 256 one-byte coordinates agree in a smaller share are no links: 5.5 deviations below 0.75.
ESTIMATE = 0.6
RARE = 8
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WORDS)], np.uint64)
_ROUND = (np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


class WordHashes(dict):
    """64-bit hash of a word, remembered (a cache, emptied at ``limit`` words: some 10 MB)."""

    def __init__(self, limit: int = 60_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def shingles(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the six white-space characters
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - WORDS + 1
    x = h[:n] * _STEP[0]
    for k in range(1, WORDS):
        x += h[k:n + k] * _STEP[k]
    return np.unique(_mix(x))


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """COORDINATES values of a non-empty set."""
    t, n = COORDINATES, len(shingle_set)
    out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    done, fraction = 0, np.uint64((1 << 48) - 1)
    while done < t and out.max() == np.iinfo(np.uint64).max:
        # so many rounds at once that the bins are likely to be full; later rounds have larger values
        rounds = min(t - done, max(1, 6 * t // n))
        x = _mix(shingle_set[None, :] ^ _ROUND[done:done + rounds, None])
        value = (x & fraction) | (np.arange(done, done + rounds, dtype=np.uint64) << np.uint64(48))[:, None]
        # the top byte is the bin (t is 256); sorting by bin and value puts each bin's smallest first
        key = np.sort((x & np.uint64(0xFF << 56) | value & np.uint64((1 << 56) - 1)).ravel())
        bins = (key >> np.uint64(56)).astype(np.int64)
        head = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        out[bins[head]] = np.minimum(out[bins[head]], key[head] & np.uint64((1 << 56) - 1))
        done += rounds
    for b in np.flatnonzero(out == np.iinfo(np.uint64).max):
        x = _mix(shingle_set ^ _ROUND[t + b]) & fraction
        out[b] = x.min() | np.uint64(t + b) << np.uint64(48)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    v = _mix(values[:BANDS * BAND]).reshape(BANDS, BAND)
    x = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP[0]
    for k in range(BAND):
        x = _mix(x * _STEP[1] + v[:, k])
    return x.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, set_key, signature, bands)`` per row, without a shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                        ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in text_rows(batch, "doc_id", "text"):
                s = shingles(text)
                if len(s) and doc_id is not None:
                    v = sketch(s)
                    rows.append((doc_id, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                 _mix(v).astype(np.uint8).tobytes(), band_keys(v)))
                else:
                    rows.append((doc_id, len(s), None, None, None))
                if len(rows) >= 1_000:
                    yield columns(rows, schema)
                    rows = []
            if rows:
                yield columns(rows, schema)

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run,
                       "doc_id long, n_shingles long, set_key binary, signature binary, bands array<long>")


def _likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose signatures agree in at least ESTIMATE of the coordinates."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES)
                        for c in ("sa", "sb"))
                keep = (x == y).sum(axis=1) >= ESTIMATE * COORDINATES
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    sig = signatures.select("doc_id", "signature")
    both = (pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b"))
    return map_batches(both.select("a", "b", "sa", "sb"), run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, linked)``: the full sets compared."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def run(batches):
        last, own = None, None
        for batch in batches:
            rows = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))):
                if last != ta:  # rows arrive sorted by a: a leader's set is built once
                    last, own = ta, shingles(ta or "")
                other = shingles(tb or "")
                both = len(np.intersect1d(own, other, assume_unique=True))
                rows.append((a, b, 100 * both >= THRESHOLD * (len(own) + len(other) - both)))
            yield columns(rows, schema)

    both = (pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a"))
    return map_batches(both.select("a", "b", "ta", "tb"), run, "a long, b long, linked boolean")


def _rare_shingles(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``(hash, ids)``: the shingles that at most RARE of the given documents have, with those documents.

    Tasks count within their batches first, so a group of near copies sends each
    common shingle once per batch.
    """
    schema = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            sets = [shingles(t or "") for t in batch.column("text").to_pylist()]
            if not sets:
                continue
            h, owner = np.concatenate(sets), np.repeat(np.array(keys, np.int64), [len(s) for s in sets])
            u, first, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            common = count > RARE
            few = ~common[back]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([h[few], u[common]]).view(np.int64)),
                pa.array(np.concatenate([owner[few], owner[first[common]]])),
                pa.array(np.concatenate([np.ones(few.sum(), np.int64), count[common]]))], schema=schema)

    chosen = texts.join(ids.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    seen = saved(map_batches(chosen, run, "hash long, id long, n long"), "near-seen")
    rare = seen.groupBy("hash").agg(F.sum("n").alias("df")).where(f"df <= {RARE}").select("hash")
    return seen.join(rare, "hash", "left_semi").groupBy("hash").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def links_to_components(docs: DataFrame, members: DataFrame, sketched: DataFrame) -> DataFrame:
    """``(node, component)`` from the buckets ``members(key, id, leader)``."""
    need = members.select(F.col("id").alias("doc_id")).distinct()
    texts = saved(docs.select(F.col("doc_id").cast("long"), "text").join(need, "doc_id", "left_semi"), "near-texts")
    pairs = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    sizes = alike = None
    live, leaders = members.select("key", "id"), members.select("key", F.col("leader").alias("id")).distinct()
    comps, slots = None, 1
    while True:
        linked = saved(_confirmed(_likely(pairs, sketched), texts).where("linked")
                       .select(F.col("b").alias("u"), F.col("a").alias("v")), "near-linked")
        if comps is None:
            comps = saved(connected_components(linked), "near-components")
        elif not linked.isEmpty():  # the components so far are stars; new links join them
            stars = comps.select(F.col("node").alias("u"), F.col("component").alias("v"))
            comps = saved(connected_components(stars.union(linked)), "near-components")
        # members that have led have met every other component of their bucket
        rest = live.join(leaders, ["key", "id"], "left_anti")
        rest = saved(rest.join(comps.withColumnRenamed("node", "id"), "id", "left").select(
            "key", "id", F.coalesce("component", "id").alias("c")), "near-rest")
        open_keys = saved(rest.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                          .where("lo <> hi").select("key"), "near-open")
        if open_keys.isEmpty():
            return comps
        live = rest.join(open_keys, "key", "left_semi")
        if sizes is None:  # once, for all that are still to be compared
            live = saved(live, "near-live")
            rare = saved(_rare_shingles(texts, live), "near-rare")
            own = rare.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("own"))
            sizes = saved(sketched.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
                          .join(live.select("id").distinct(), "id", "left_semi").join(own, "id", "left").select(
                "id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("m")), "near-sizes")
            alike = rare.where("size(ids) > 1").select(F.explode("ids").alias("a"), "ids").select(
                "a", F.explode("ids").alias("b")).where("a < b").distinct()
            label = comps.select(F.col("node"), F.col("component"))
            alike = (alike.join(label.toDF("a", "ca"), "a", "left").join(label.toDF("b", "cb"), "b", "left")
                     .where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b"))
        # without a common rare shingle, m shingles at most are shared with any other
        live = saved(live.join(sizes.where(f"100 * m >= {THRESHOLD} * n"), "id"), "near-live")
        forget(rest, linked)
        slots *= 16
        slot = F.pmod(F.xxhash64("id"), F.lit(slots))
        lead = saved(live.groupBy("key", slot.alias("slot")).agg(F.min(F.struct("id", "c", "n", "m")).alias("x"))
                     .select("key", "x.id", "x.c", "x.n", "x.m"), "near-leaders")
        leaders = lead.select("key", "id")
        # a pair shares several buckets: it is emitted in the first of those that its leader leads (51 keys at most)
        every = F.collect_set("key").over(Window.partitionBy("id"))
        one = lead.select("key", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"),
                          F.col("m").alias("ma"), every.alias("leads"))
        both = live.select("key", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"),
                           F.col("m").alias("mb"), every.alias("keys"))
        # an upper bound of the intersection must reach the threshold
        near = (f"ca <> cb and 100 * least(ma, mb) >= {THRESHOLD} * (na + nb - least(ma, mb)) "
                "and array_min(array_intersect(leads, keys)) = key")
        pairs = one.join(both, "key").where(near).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if alike is not None:
            pairs, alike = pairs.union(alike).distinct(), None
        live = live.select("key", "id")


def components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``."""
    rows = saved(sketches(docs), "near-sketches")
    classes = saved(rows.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")),
                    "near-classes")
    chosen = rows.where("set_key is not null").join(
        classes, (rows["set_key"] == classes["set_key"]) & (rows["doc_id"] == classes["rep"]), "left_semi")
    chosen = saved(chosen.select("doc_id", "n_shingles", "signature", "bands").dropDuplicates(["doc_id"]), "near-chosen")
    bands = chosen.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    shared = saved(bands.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n"))
                   .where("n > 1").select("key", "leader"), "near-buckets")
    members = saved(bands.join(shared, "key"), "near-members")
    found = links_to_components(docs, members, chosen)
    reps = classes.join(found, classes["rep"] == found["node"], "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    reps = saved(reps, "near-reps")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", "set_key").join(reps, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    gone = saved(components(docs).where("not kept").select(F.col("doc_id").alias("_gone")), "near-gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT u, v FROM shared JOIN n nu ON u = nu.doc_id JOIN n nv ON v = nv.doc_id
  WHERE 100 * c >= 75 * (nu.n + nv.n - c)),
e AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT r.node, e.v FROM reach r JOIN e ON r.other = e.u)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.other) AS component_id,
       doc_id = min(reach.other) AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN reach ON reach.node = documents.doc_id GROUP BY doc_id
"""
