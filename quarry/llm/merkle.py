"""Merkle manifest of a dataset as a content-addressed graph.

Every row is a leaf, the SHA-256 (H) of its fields. Leaves are ranked within their
group; runs of ``fanout`` neighbours become the H of their digests, level by level,
until one node is left. Ranks are split into blocks of ``fanout ** digits`` leaves: a
block's whole subtree is built in one task from a list of bounded length, and the
blocks' roots are the leaves of the next round, so a group of any size takes
``log(n) / (digits * log(fanout))`` rounds and a group with a large part of all rows
is spread over tasks.

What is stored per round are records addressed by a digest: the digest of a
block's root, and under it the children level by level (equal subtrees are
stored once). A request for leaves descends from the root: each step looks up the
records of the wanted digests, follows the digits of the wanted ranks and collects
the children beside them; requests that share a prefix share its steps. At
the leaf the segments of the path are reversed, which is the proof.

Defined cases: null fields are ``-``; a null group is a group and comes first; equal
ids in a group are ordered by their leaf, and rows that repeat one id and all
fields are leaves of their own with equal digests (a repeated digest is stored once); a group of one leaf is its own
root; empty texts are hashed as length 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches
from quarry.llm.conversation_repair import crc32_sql
from quarry.llm.store import saved
from quarry.operators.ids import contiguous_id

FANOUT, DIGITS = 2, 10


def H(*parts: str) -> str:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """H of the fields, each as byte count, ``:`` and value, or ``-`` where null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts)), 256)


def subtree(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of a block level by level, the root first; ``levels`` None: up to a single node."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([H(*below[i:i + fanout]) for i in range(0, len(below), fanout)])
    return out[::-1]


def beside(levels: list[list[str]], rank: int, fanout: int) -> list[tuple[str, str]]:
    """Descends to a node of a block by the digits of its rank: per step, the children left and right of the chosen one."""
    place, steps = [rank], []
    for _ in levels[1:]:
        place.append(place[-1] // fanout)
    for nodes, at in zip(levels[1:], place[-2::-1]):
        first = at - at % fanout
        steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])))
    return steps


class Forest:
    """The stored rounds of all groups' trees; ``roots`` is ``(grp, root)``."""

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT, digits: int = DIGITS):
        """``nodes(grp, rank, digest)`` with ranks 0, 1, ... in every group."""
        self.fanout, self.span = fanout, fanout ** digits
        self.records: list[DataFrame] = []
        sizes = saved(nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
        most = sizes.agg(F.max("n")).first()[0] or 0  # one number: how many rounds there are
        current, span = nodes.select("grp", "rank", "digest"), self.span
        while most:
            blocks = current.groupBy("grp", F.expr(f"rank div {span}").alias("block")).agg(
                F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
            b, s = blocks.alias("b"), sizes.alias("s")
            blocks = b.join(s, F.col("b.grp").eqNullSafe(F.col("s.grp"))).select(
                "b.grp", "block", F.col("nodes.digest").alias("nodes"), (F.col("n") <= span).alias("alone"))
            built = saved(map_batches(blocks, self._built(digits), self._sql(nodes)), "merkle-records")
            self.records.append(built.select("digest", "levels").dropDuplicates(["digest"]))
            current = built.select("grp", F.col("block").alias("rank"), "digest")
            sizes = sizes.select("grp", F.ceil(F.col("n") / span).alias("n"))
            if most <= span:
                break
            most = -(-most // span)
        self.roots = current.select("grp", F.col("digest").alias("root"))

    @staticmethod
    def _sql(nodes: DataFrame) -> str:
        return f"grp {nodes.schema['grp'].dataType.simpleString()}, block long, digest string, levels array<array<string>>"

    def _built(self, digits: int):
        fanout = self.fanout

        def run(batches):
            for batch in batches:
                grp, block, nodes, alone = (batch.column(n) for n in ("grp", "block", "nodes", "alone"))
                levels = [subtree(x, fanout, None if a else digits)
                          for x, a in zip(nodes.to_pylist(), alone.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [grp, block, pa.array([x[0][0] for x in levels], pa.string()),
                     pa.array(levels, pa.list_(pa.list_(pa.string())))], names=["grp", "block", "digest", "levels"])
        return run

    def descend(self, start: DataFrame, wanted: DataFrame) -> DataFrame:
        """From ``start(grp, digest, left, right)`` to the leaf blocks that hold a ``wanted(grp, rank)``.

        Returns ``(grp, block, levels, left, right)``: the record of each leaf block and the
        children beside the path to it, root first. ``start`` has one row per group.
        """
        at = start.withColumn("block", F.lit(0).cast("long"))
        for k in range(len(self.records) - 1, -1, -1):
            at = at.join(self.records[k], "digest")
            if k == 0:
                return at.select("grp", "block", "levels", "left", "right")
            steps = map_batches(at.select("grp", "block", "levels", "left", "right"), self._stepped(at.schema["grp"]),
                                f"grp {at.schema['grp'].dataType.simpleString()}, block long, digest string, "
                                "left array<string>, right array<string>")
            # only prefixes that some wanted rank has go on
            prefix = wanted.select("grp", F.expr(f"rank div {self.span ** k}").alias("block")).distinct()
            s, p = steps.alias("s"), prefix.alias("p")
            at = saved(s.join(p, F.col("s.grp").eqNullSafe(F.col("p.grp")) & (F.col("s.block") == F.col("p.block")),
                              "left_semi"), "merkle-steps")
        return at.select("grp", "block", F.lit(None).cast("array<array<string>>").alias("levels"), "left", "right")

    def _stepped(self, grp):
        fanout, span = self.fanout, self.span
        schema = pa.schema([("grp", pa.int64() if grp.dataType.simpleString() == "bigint" else pa.string()),
                            ("block", pa.int64()), ("digest", pa.string()),
                            ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])

        def run(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for grp, block, levels, left, right in zip(*(batch.column(n).to_pylist() for n in (
                        "grp", "block", "levels", "left", "right"))):
                    rows = []
                    for i, digest in enumerate(levels[-1]):
                        steps = beside(levels, i, fanout)
                        rows.append((grp, block * span + i, digest, left + [s[0] for s in steps],
                                     right + [s[1] for s in steps]))
                    yield columns(rows, schema)
        return run


def fold(node: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and its siblings (root first) give."""
    for before, after in zip(left[::-1], right[::-1]):
        node = H(before, node, after)
    return node


PROOF = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                   ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def _proofs(fanout: int, span: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, levels, left, right, subroot, asked in zip(*(batch.column(n).to_pylist() for n in (
                    "block", "levels", "left", "right", "subroot", "asked"))):
                rows = []
                for a in asked:
                    steps = beside(levels, a["rank"] - block * span, fanout)
                    before, after = left + [s[0] for s in steps], right + [s[1] for s in steps]
                    proof = H(*(x + y for x, y in zip(before[::-1], after[::-1])))
                    held = a["held"] if a["held"] is not None else a["leaf"]
                    rows.append((a["doc_id"], a["leaf"], subroot, proof, fold(held, before, after)))
                yield columns(rows, PROOF)
    return run


def leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, leaf, held)``: the digest of each row, and of the row as its holder has it if tampered with."""
    def of(n_chars):
        return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    # one decimal digit more than a long, so that the largest count can be tampered with too
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    touched = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       of(F.col("n_chars")).alias("leaf"), F.when(touched, of(more)).alias("held"))


def manifest(docs: DataFrame, fanout: int = FANOUT, digits: int = DIGITS) -> DataFrame:
    """One row per document: its leaf, the roots, the digest of its proof, and the root that its holder's row folds to."""
    rows = saved(contiguous_id(saved(leaves(docs), "merkle-leaves"), ["doc_id", "leaf"], "rank", ["lang"]),
                 "merkle-ranked")
    trees = Forest(rows.select(F.col("lang").alias("grp"), "rank", F.col("leaf").alias("digest")), fanout, digits)
    # the groups' roots are the leaves of one more tree
    langs = saved(contiguous_id(trees.roots, ["grp"], "place"), "merkle-roots")
    top = Forest(langs.select(F.lit(0).cast("long").alias("grp"), F.col("place").alias("rank"),
                              F.col("root").alias("digest")), fanout, digits)
    none = F.array().cast("array<string>")
    start = top.roots.select("grp", F.col("root").alias("digest"), none.alias("left"), none.alias("right"))
    if top.records:
        found = top.descend(start, langs.select(F.lit(0).cast("long").alias("grp"), F.col("place").alias("rank")))
        steps = map_batches(found, top._stepped(found.schema["grp"]), "grp long, block long, digest string, "
                            "left array<string>, right array<string>")
        starts = steps.join(langs.select("place", F.col("grp").alias("lang")), F.col("block") == F.col("place")).select(
            F.col("lang").alias("grp"), "digest", "left", "right")
        starts = saved(starts, "merkle-starts")
    else:  # no leaves
        starts = trees.roots.select("grp", F.col("root").alias("digest"), none.alias("left"), none.alias("right"))
    found = trees.descend(starts, rows.select(F.col("lang").alias("grp"), "rank"))
    asked = rows.groupBy("lang", F.expr(f"rank div {trees.span}").alias("block")).agg(
        F.collect_list(F.struct("rank", "doc_id", "leaf", "held")).alias("asked"))
    f, a, r = found.alias("f"), asked.alias("a"), trees.roots.alias("r")
    whole = (f.join(a, F.col("f.grp").eqNullSafe(F.col("a.lang")) & (F.col("f.block") == F.col("a.block")))
             .join(r, F.col("f.grp").eqNullSafe(F.col("r.grp")))
             .select("f.block", "levels", "left", "right", F.col("root").alias("subroot"), "asked"))
    proofs = map_batches(whole, _proofs(fanout, trees.span), "doc_id long, leaf string, subroot string, "
                                                             "proof_sha256 string, folded_root string")
    root = top.roots.agg(F.max("root")).scalar()
    return proofs.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == root).alias("verified"))


def _field_sql(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


SQL = f"""
WITH RECURSIVE
l AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN n_chars IS NOT NULL
    AND {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} END AS held
  FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
  count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT lang, 0 AS lvl, rank, leaf AS digest, n FROM o
  UNION ALL SELECT lang, lvl + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (n + 1) // 2
  FROM t WHERE n > 1 GROUP BY lang, lvl, rank // 2, n),
s AS (SELECT lang, lvl AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
  count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, place AS rank, subroot AS digest, n FROM s
  UNION ALL SELECT lvl + 1, rank // 2, sha256(string_agg(digest, '' ORDER BY rank)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY lvl, rank // 2, n),
-- every step of every leaf: level, digit and sibling
p AS (SELECT o.lang, o.rank, t.lvl, o.rank // (1 << t.lvl) % 2 AS digit, b.digest AS sibling
    FROM o JOIN t ON t.lang IS NOT DISTINCT FROM o.lang AND t.rank = o.rank // (1 << t.lvl) AND t.n > 1
    LEFT JOIN t b ON b.lang IS NOT DISTINCT FROM t.lang AND b.lvl = t.lvl AND b.rank = xor(t.rank, 1)
  UNION ALL
  SELECT o.lang, o.rank, s.height + u.lvl, s.place // (1 << u.lvl) % 2, b.digest
    FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN u ON u.rank = s.place // (1 << u.lvl) AND u.n > 1
    LEFT JOIN u b ON b.lvl = u.lvl AND b.rank = xor(u.rank, 1)),
q AS (SELECT lang, rank, count(*) AS steps, string_agg(coalesce(sibling, ''), '' ORDER BY lvl) AS proof FROM p GROUP BY lang, rank),
f AS (SELECT lang, rank, 0 AS lvl, coalesce(held, leaf) AS node FROM o
  UNION ALL SELECT f.lang, f.rank, f.lvl + 1, sha256(CASE digit WHEN 1 THEN coalesce(sibling, '') || node
    ELSE node || coalesce(sibling, '') END)
  FROM f JOIN p ON p.lang IS NOT DISTINCT FROM f.lang AND p.rank = f.rank AND p.lvl = f.lvl)
SELECT o.doc_id, o.leaf, s.subroot, u.digest AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
  f.node AS folded_root, f.node = u.digest AS verified
FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN u ON u.n = 1
  LEFT JOIN q ON q.lang IS NOT DISTINCT FROM o.lang AND q.rank = o.rank
  JOIN f ON f.lang IS NOT DISTINCT FROM o.lang AND f.rank = o.rank AND f.lvl = coalesce(q.steps, 0)
"""
