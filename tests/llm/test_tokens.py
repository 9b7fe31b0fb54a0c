"""BPE encoding against tiktoken, token files against the tokenizers library, exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from quarry.llm import bpe, planes, pretokens
from tests.llm.conftest import texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'ll", "'re", "'", " ", "  ", "\n", "\t", "a", "é", "1", "٣", "!", "_", "中", "😀", "<|endoftext|>",
         "don't", "I've", "\x1c", "\x85", " the", "'S", "\r\n", "'v", "՘"]


def invented(n, size=30, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(size))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_decode_like_tiktoken(reference):
    v = bpe.vocabulary(RANKS)
    own = [*invented(3000), "", "a" * 5000, " " * 700, "x'", "ab" * 3000]
    ids, n = v.encode(own)
    for t, part in zip(own, np.split(ids, np.cumsum(n)[:-1])):
        assert part.tolist() == reference.encode_ordinary(t)
        assert v.decode(part) == t.encode()


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    slots = bpe.MinimalPerfectHash(keys)(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert bpe.MinimalPerfectHash(keys[:1])(keys[:1]).tolist() == [0]


def test_long_texts_are_cut_where_no_token_spans(reference, monkeypatch):
    monkeypatch.setattr(pretokens, "PIECE", 50)
    v = bpe.vocabulary(RANKS)
    for t in invented(200, 200, seed=5):
        assert "".join(pretokens.pieces(t)) == t
        assert v.encode([t])[0].tolist() == reference.encode_ordinary(t)


def test_colliding_hashes_take_the_slow_path(reference, monkeypatch):
    v, library = bpe.vocabulary(RANKS), planes.LibraryEncoder(JSON)
    own, whole = invented(200, seed=9), pretokens.span_hashes

    def few(cps, begin, end):  # many tokens share a hash, in a batch and with the memory
        h = whole(cps, begin, end)
        return np.where(end - begin > 2, h & np.uint64(7), h)

    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    want = [e.ids for e in tokenizer.encode_batch(own, add_special_tokens=False)]
    monkeypatch.setattr(pretokens, "span_hashes", few)
    for t, ids in zip(own, want):
        assert library.encode([t])[0].tolist() == ids
        memory = pretokens.Memory(v.resolve, np.int32)
        assert pretokens.encode([t], memory)[0].tolist() == reference.encode_ordinary(t)


def test_memory_grows_in_steps(reference):
    v = bpe.vocabulary(RANKS)
    memory = pretokens.Memory(v.resolve, np.int32, limit=60_000)
    rng = random.Random(8)
    for _ in range(40):
        own = ["".join(f" w{rng.randrange(200_000)}" for _ in range(1000)) for _ in range(2)]
        ids, n = pretokens.encode(own, memory)
        for t, part in zip(own, np.split(ids, np.cumsum(n)[:-1])):
            assert part.tolist() == reference.encode_ordinary(t)


def test_memory_may_be_emptied(reference):
    v = bpe.vocabulary(RANKS)
    small = pretokens.Memory(v.resolve, np.int32, limit=20)
    for t in invented(100, seed=9):
        assert pretokens.encode([t], small)[0].tolist() == reference.encode_ordinary(t)


def test_round_trip_query(spark, reference):
    rows = [(5, "the cat's hat"), (1, None), (2, ""), (2, "twice"), (2, "twice"), (None, "no id"), (9, "word " * 30000)]
    got = bpe.round_trip(texts(spark, rows), RANKS).collect()
    want = []
    for d, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(texts(spark, []), RANKS).collect() == []
    ids = bpe.encoded(texts(spark, rows[:1]), RANKS).collect()[0]["ids"]
    assert list(ids) == reference.encode_ordinary("the cat's hat")


def test_payload_round_trip():
    for ids in (np.arange(0), np.array([0, 1, 50256, 2**32 - 1]), np.random.default_rng(1).integers(0, 50257, 70000)):
        assert planes.unpack(planes.pack(ids.astype(np.uint32))).tolist() == ids.tolist()


def test_crc_of_parts():
    data = bytes(range(256)) * 40
    for cuts in ([0, 3, 3, 1000, len(data)], [0, len(data)]):
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        assert planes.crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(data)


def test_token_files(spark, monkeypatch):
    rows = [(3, "b " * 90000), (1, "it's"), (2, None), (7, ""), (7, ""), (4, "<|endoftext|> ՘"), (None, "x")]
    chunks = planes.written(texts(spark, rows), JSON, 2, parts=3)
    index = planes.chunk_index(chunks)
    got = sorted(map(tuple, planes.read_back(chunks, index).collect()), key=lambda r: r[1])
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert sum(r["n_ids"] for r in index.collect()) == at
    none = planes.written(texts(spark, []), JSON, 2)
    assert planes.read_back(none, planes.chunk_index(none)).collect() == []
