"""Exact, near and line deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, line_chunks, near_dedup
from quarry.llm.components import connected_components
from tests.llm.conftest import texts

WORDS = [f"w{k}" for k in range(400)]


def words(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def test_exact_edge_cases(spark):
    rows = [(3, "a b"), (1, "ab"), (2, " a\tb\n"), (4, None), (5, ""), (6, "\x0b"), (7, "a b"), (None, "ab"), (8, "z")]
    got = {r["doc_id"]: r for r in exact_dedup.memberships(texts(spark, rows), exact_dedup.DigestIndex(spark)).collect()}
    assert {d: (r["keep_id"], r["group_size"], r["kept"]) for d, r in got.items()} == {
        3: (2, 4, False), 1: (2, 4, False), 2: (2, 4, True), None: (2, 4, False),
        4: (6, 3, False), 5: (6, 3, False), 6: (6, 3, True), 7: (7, 1, True), 8: (8, 1, True)}
    assert got[2]["text_sha256"] == hashlib.sha256(b"ab").hexdigest()
    assert exact_dedup.memberships(texts(spark, []), exact_dedup.DigestIndex(spark)).collect() == []


def test_index_persists_and_grows(spark):
    first = exact_dedup.DigestIndex(spark, buckets=3)
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicated(texts(spark, [(1, "a"), (2, "a"), (3, "b")]), first).collect()) == [1, 3]
    again = exact_dedup.DigestIndex(spark, first.path, buckets=3)  # as another session would open it
    kept = exact_dedup.deduplicated(texts(spark, [(4, " a "), (5, "c"), (6, "b"), (7, "c d"), (8, "cd ")]), again)
    assert sorted(r["doc_id"] for r in kept.collect()) == [5, 7] or sorted(r["doc_id"] for r in kept.collect()) == [5, 8]
    assert kept.columns == texts(spark, []).columns
    assert again.groups().count() == 4
    plan = again.unknown(exact_dedup.digest_rows(texts(spark, [(9, "q")])))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan


def test_digest_index_knows_its_buckets(spark):
    first = exact_dedup.DigestIndex(spark, buckets=4)
    known = [(k, f"text {k}") for k in range(40)]
    assert exact_dedup.deduplicated(texts(spark, known), first).count() == 40
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, first.path, buckets=8)
    first.close()
    again = exact_dedup.DigestIndex(spark, first.path)
    assert again.buckets == 4
    assert exact_dedup.deduplicated(texts(spark, [(k + 100, t + " ") for k, t in known]), again).count() == 0


def test_digest_index_merges_batches(spark):
    index = exact_dedup.DigestIndex(spark, buckets=3)
    exact_dedup.memberships(texts(spark, [(5, "ab")]), index).collect()
    got = exact_dedup.memberships(texts(spark, [(1, "a  b"), (2, "a b"), (None, "q"), (3, None)]), index).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {
        (1, 1, 3, True), (2, 1, 3, False), (None, None, 1, True), (3, 3, 1, True)}
    later = exact_dedup.memberships(texts(spark, [(0, "a  b"), (9, "ab")]), index).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in later} == {(0, 0, 5), (9, 0, 5)}
    rows = [(k, "x" * (k % 3) + " ") for k in range(30)] + [(None, "y"), (50, None)]
    whole = exact_dedup.memberships(texts(spark, rows), exact_dedup.DigestIndex(spark)).collect()
    dealt = exact_dedup.memberships_in_batches(texts(spark, rows), exact_dedup.DigestIndex(spark)).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, dealt))


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges += [(5000, 5000 + k) for k in range(200)] + [(None, 1), (7, 7)]
    label = {}
    for _ in range(70):
        for a, b in edges:
            if a is not None and a != b:
                m = min(label.get(a, a), label.get(b, b))
                label[a] = label[b] = m
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    assert {x["node"]: x["component"] for x in got.collect()} == label
    assert connected_components(spark.createDataFrame([], "u string, v string")).collect() == []


def brute_near(rows):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[d] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return {(d, len(sets[d]), label[d], label[d] == d) for d in sets}


def test_near_against_brute_force(spark):
    r = random.Random(4)
    rows, base = [], [words(r, n) for n in (40, 80, 200, 12)]
    for w in base:
        rows.append(w)
        for _ in range(14):  # chains and stars of edited copies
            w2 = list(r.choice(rows[-3:]))
            for _ in range(r.choice((0, 1, 1, 2, 5))):
                w2[r.randrange(len(w2))] = r.choice(WORDS)
            rows.append(w2)
    rows = [" ".join(w) for w in rows] + ["A b c d e", "a B c\nd e", "a b", "A  b", "", None, " \n", "é a b c d", "É a b c d"]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    got = near_dedup.components(texts(spark, rows)).collect()
    assert {tuple(x) for x in got} == brute_near(rows)
    kept = near_dedup.deduplicated(texts(spark, rows))
    assert {x["doc_id"] for x in kept.collect()} == {x["doc_id"] for x in got if x["kept"]}
    assert kept.columns == texts(spark, []).columns


def test_near_outliers_of_a_bucket(spark):
    """A leader that is no link of its bucket must not hide the links of the others."""
    rows = [(0, "l1"), (1, "x1"), (2, "x2"), (3, "x3"), (4, "l2")]
    shared = [f"s{k}" for k in range(60)]
    text = {"l1": shared + [f"a{k}" for k in range(60)], "l2": shared + [f"b{k}" for k in range(60)]}
    for n in (1, 2, 3):
        text[f"x{n}"] = shared + [f"c{k}" for k in range(58)] + [f"d{n}"] * 2
    docs = texts(spark, [(d, " ".join(text[t])) for d, t in rows])
    chosen = near_dedup.sketches(docs)
    members = spark.createDataFrame([(7, d, 0) for d, _ in rows], "key long, id long, leader long")
    found = near_dedup.links_to_components(docs, members, chosen).collect()
    assert {(x["node"], x["component"]) for x in found} == {(1, 1), (2, 1), (3, 1)}


def test_near_edge_cases(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u"), (3, "word " * 40000)]
    got = {(x["doc_id"], x["component_id"], x["kept"]) for x in near_dedup.components(texts(spark, rows)).collect()}
    assert got == {(None, None, True), (1, 1, True), (2, 1, False), (3, 3, True)}
    assert near_dedup.components(texts(spark, [])).collect() == []


def test_sketch_fills_every_coordinate():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 100, 3000):
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        v = near_dedup.sketch(s)
        assert (v != np.iinfo(np.uint64).max).all()
        # one round at a time gives the same sketch as many at once
        out = np.full(256, np.iinfo(np.uint64).max, np.uint64)
        for k in range(256):
            x = near_dedup._mix(s ^ near_dedup._ROUND[k])
            np.minimum.at(out, (x >> np.uint64(56)).astype(int), x & np.uint64((1 << 48) - 1) | np.uint64(k << 48))
        filled = out != np.iinfo(np.uint64).max
        assert (out[filled] == v[filled]).all()


def brute_lines(rows):
    """Chunks by the same boundaries, repeated ones found by their text."""
    seen, out = set(), {}
    order = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    firsts = {}
    for known, d, t in order:
        lines = t.split("\n")
        for a, b, counts in line_chunks.chunks(t):
            if counts and (len(lines) > 1 or len(t) >= 99):
                firsts.setdefault("\n".join(lines[a:b]), (known, d, a))
    for known, d, t in order:
        lines, kept = t.split("\n"), []
        for a, b, counts in line_chunks.chunks(t):
            c = "\n".join(lines[a:b])
            if not (c in firsts and counts and firsts[c] != (known, d, a)):
                kept += lines[a:b]
        out[(d if known else None, t)] = "\n".join(kept)
    return out


def test_lines_against_brute_force(spark):
    r = random.Random(8)
    passage = [" ".join(words(r, 9)) for _ in range(14)]
    long = " ".join(words(r, 60))
    rows = []
    for d in range(30):
        own = [" ".join(words(r, r.randrange(1, 8))) for _ in range(r.randrange(0, 9))]
        at = r.randrange(len(own) + 1)
        own[at:at] = r.choice(([], passage, passage, [long], passage[3:12]))
        rows.append((d, "\n".join(own)))
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, rows[3][1]), (43, rows[3][1]), (None, "\n".join(passage)), (44, "x\n" * 5000)]
    got = line_chunks.deduplicated(texts(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_lines(rows)
    by_id = {d: t for d, t in rows}
    for x in got:
        assert x["text"] == want[(x["doc_id"], by_id[x["doc_id"]] or "")], x["doc_id"]
        assert x["removed_lines"] <= x["n_lines"]
    # the passage stays once, in the document that comes first
    inner = "\n".join(passage[4:11])
    assert sum(inner in x["text"] for x in got) <= 1
    assert sum(long in x["text"] for x in got) == 1
    assert line_chunks.deduplicated(texts(spark, [])).collect() == []
    assert F is not None


def test_chunk_boundaries_resist_shifts():
    r = random.Random(3)
    body = [" ".join(words(r, 6)) for _ in range(60)]
    a = {tuple(body[i:j]) for i, j, _ in line_chunks.chunks("\n".join(body))}
    moved = ["new first line", "and another"] + body
    b = {tuple(moved[i:j]) for i, j, _ in line_chunks.chunks("\n".join(moved))}
    assert len(a - b) <= 2


def brute_passages(rows):
    """Repeated chunks, and every repeated run of two lines with words and 50 words, line by line."""
    order = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    full = lambda own: len(own) > 1 and own[0].split() and own[-1].split() and sum(len(x.split()) for x in own) >= 50
    places = {}
    for n, (_, _, t) in enumerate(order):
        lines = t.split("\n")
        own = {(a, b) for a in range(len(lines)) for b in range(a + 2, len(lines) + 1) if full(lines[a:b])}
        own |= {(a, b) for a, b, counts in line_chunks.chunks(t) if counts}
        for a, b in sorted(own):
            places.setdefault("\n".join(lines[a:b]), []).append((n, a, b))
    gone = set()
    for (n, a, b), *others in places.values():
        gone |= {(m, k) for m, c, e in others for k in range(c, e) if not (m == n and k < b)}
    return {(d if known else None, t): "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone)
            for n, (known, d, t) in enumerate(order)}


def test_passages_of_several_lines(spark):
    """Repeated passages of over 50 words go from their first to their last line, whatever stands around them."""
    r = random.Random(12)
    shapes = [(2, 30), (3, 20), (4, 15), (6, 10), (10, 10)] * 4
    unique = iter(range(10**6))
    around = lambda: [f"u{next(unique)} u{next(unique)} alone" for _ in range(r.randrange(1, 5))]
    passages = [[" ".join(f"p{next(unique)}" for _ in range(w)) for _ in range(n)] for n, w in shapes]
    rows = [(d, "\n".join(around() + p + around())) for k, p in enumerate(passages) for d in (k, 100 + k)]
    edges = ["\n".join(p[:1] + [""] + p[1:]) for p in passages[:4]]  # other runs of the same lines
    rows += [(200 + k, e + "\n" + "\n".join(around())) for k, e in enumerate(edges)]
    rows += [(300 + k, "top\n" + e) for k, e in enumerate(edges)]
    rows += [(400, "x y\n" * 120), (401, "\n".join(passages[0] + passages[1] + passages[0])), (None, "\n".join(passages[7])),
             (402, None), (403, "a b\nc d\nshort run"), (404, "e f\ng h\nshort run"), (102, rows[5][1])]
    got = {x["doc_id"]: x for x in line_chunks.deduplicated(texts(spark, rows), passages=True).collect()}
    for k, p in enumerate(passages):
        copy = got[100 + k]
        assert not set(p) & set(copy["text"].split("\n")) and copy["removed_lines"] == len(p), shapes[k]
        assert k == 7 or "\n".join(p) in got[k]["text"]
    want = brute_passages(rows)
    by_id = dict(rows)
    assert {d: x["text"] for d, x in got.items()} == {d: want[(d, t or "")] for d, t in by_id.items()}
    assert got[400]["removed_lines"] >= 60 and got[403]["removed_lines"] == 0
    assert line_chunks.deduplicated(texts(spark, []), passages=True).collect() == []
