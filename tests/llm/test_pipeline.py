"""The pipeline's stages against plain Python on the smallest tables."""

import base64
import hashlib
import re

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from quarry.llm import quality
from quarry.sources.tables import load_table
from tests.llm.test_dedup import brute_near


def test_pipeline_against_brute_force(spark, sf):
    docs = load_table(spark, sf, "documents")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = quality.fit(docs, load_table(spark, sf, "labels"))
    rows = {d: t for d, t in rows.items() if model.scores([t])[0] >= 0.5}
    groups = {}
    for d, t in rows.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), d))
    rows = {d: rows[d] for _, d in map(min, groups.values())}
    rows = {d: rows[d] for d, _, _, kept in brute_near(rows.items()) if kept}
    grams = lambda t: {tuple(w[k:k + 6]) for w in [t.lower().split()] for k in range(len(w) - 5)}
    items = [x for r in load_table(spark, sf, "benchmark").collect() if (x := grams(r["text"]))]
    rows = {d: t for d, t in rows.items() if not any(len(x & g) >= 0.6 * len(x) for g in [grams(t)] for x in items)}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for d, t in rows.items():
        ids = encoder.encode_ordinary(t)
        want.add((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert {tuple(r) for r in P.run(spark, sf).collect()} == want


def test_stages_keep_columns_and_take_empty_tables(spark, sf):
    docs = load_table(spark, sf, "documents")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs.where("false"), sf)
        assert out.columns == docs.columns and out.count() == 0, name
    assert P.STAGES[-1][1](spark, docs.where("false"), sf).count() == 0


def test_workers_hold_few_words_and_texts():
    """A worker lives through all stages: what each operator remembers in it stays small, and changes no result."""
    import numpy as np
    import pyarrow as pa

    from quarry.llm import decontaminate, near_dedup
    from quarry.llm.arrow import text_rows

    words = [f"w{k}" for k in range(150_000)]
    hashes, numbers = near_dedup.WordHashes(), decontaminate.Words()
    found = [hashes[w.encode()] for w in words]
    for at in range(0, len(words), 10_000):
        numbers.numbers(words[at:at + 10_000])
    assert len(hashes) <= 60_000 and len(numbers) <= 70_000
    few = near_dedup.WordHashes(limit=7)
    assert [few[w.encode()] for w in words[:1000]] == found[:1000] and len(few) <= 7
    small = decontaminate.Words(limit=7)
    for at in range(0, 1000, 5):
        n = small.numbers(words[at:at + 5])
        assert np.array_equal(small.hash[n], [found[k] for k in range(at, at + 5)])
    batch = pa.record_batch({"id": list(range(1203)), "text": [None if k % 400 == 1 else f"t{k}" for k in range(1203)]})
    assert list(text_rows(batch, "id", "text")) == [(k, "" if k % 400 == 1 else f"t{k}") for k in range(1203)]
    assert list(text_rows(batch.slice(0, 0), "id", "text")) == []
