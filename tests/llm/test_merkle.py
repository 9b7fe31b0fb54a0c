"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from quarry.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, grp string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars):
    return H(*(field(v) for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def steps(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])))
        at //= fanout
    return out


def brute(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = tree([leaf(*r) for r in groups[g]], fanout)
    top = tree([trees[g][-1][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        for rank, row in enumerate(groups[g]):
            path = steps(trees[g], rank, fanout) + steps(top, k, fanout)
            doc_id, text, lang, source, n_chars = row
            touched = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            node = leaf(doc_id, text, lang, source, n_chars + touched if n_chars is not None else None)
            for left, right in path:
                node = H(left, node, right)
            root = top[-1][0]
            out.append((doc_id, leaf(*row), trees[g][-1][0], root, H(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def table(n, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([None, "", "tëxt", "x" * 100_000, f"t{k}"]), rng.choice([None, "de", "en", "en", "en", "é"]),
             rng.choice([None, "s"]), rng.choice([None, k, 2 ** 63 - 1])) for k in range(n)]
    return rows + rows[:3] + [(None, None, None, None, None), (5, "other", "en", None, 1), (6, "alone", "zz", "s", 6)]


@pytest.mark.parametrize("n, fanout, digits", [(0, 2, 10), (45, 2, 10), (45, 2, 2), (70, 3, 2), (30, 2, 1)])
def test_manifest_against_a_plain_tree(spark, n, fanout, digits):
    rows = table(n, n + digits)
    df = spark.createDataFrame([(*r, "l", 3, "g") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in merkle.manifest(df, fanout, digits).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)
    assert got == brute(rows, fanout)
    assert not n or {r[-1] for r in got} == {True, False}


def test_equal_subtrees_are_stored_once(spark):
    nodes = spark.createDataFrame([("a", k, "d") for k in range(16)], "grp string, rank long, digest string")
    forest = merkle.Forest(nodes, fanout=2, digits=2)
    assert [r.count() for r in forest.records] == [1, 1]
    assert forest.roots.collect()[0]["root"] == tree(["d"] * 16, 2)[-1][0]


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
