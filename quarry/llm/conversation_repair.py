"""Conversation repair by weighted interval parsing.

A conversation is legal when its role initials spell ``(s?(ua)+)?``. The repair
grammar is in Chomsky normal form: a nonterminal ``X_pq`` derives the edited rows
that take the role automaton from state p to state q, with the rules

    X_pq -> X_pr X_rq                 two neighbouring spans
    X_pq -> row                       keep, rerole or delete one row
    X_pp -> (nothing), X_pq -> insert the insertion closure, around every span

and a cell of a span keeps, per nonterminal, the least ``(cost, audit)``. Blocks of
``BLOCK`` rows are filled by the textbook scheme (all spans, shortest first, every
split point) and remembered by their symbols. Longer spans are combined from
neighbouring ones, shortest first: the rules make ``combine`` associative, so every
split point of a span gives the same cell and one is enough. Two audits of one span
and one nonterminal that cost the same are never prefixes of each other (they
have one letter per row, and inserts cost), so least audits stay least inside longer ones.

On the cluster rows are ranged over tasks by conversation and turn. A task parses the
run of each conversation that it holds into one piece; the pieces of a conversation
are combined in order, and a second pass streams the rows with their edits
to write and hash the repaired text. A conversation with a large part of all rows is so
parsed by all tasks; its audit is one value and its hash one sequence, read as
a stream by one task.

Defined cases: null roles and texts are one space, in the damage's key null ids and
turns too; rows with a null conversation id form one conversation; a null turn
comes first; rows of one turn are ordered by role, then by the SHA-256 of the text;
equal rows of one turn are adjacent; an empty role fits no place; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches
from quarry.llm.store import saved
from quarry.session import default_parallelism

WHITE_SPACE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK = 8

# ---------------------------------------------------------------- grammar ---

#: States of (s?(ua)+)?: nothing yet, after s, after u, after a; 0 and 3 may end a conversation.
STATES, ENDS = 4, (0, 3)
_STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_WRITTEN = ("u", "a")  # the roles that an edit may write

#: A cell table: per pair of states the least (cost, audit), None where no edit leads there.
Cells = list


def _at(p: int, q: int) -> int:
    return p * STATES + q


def _put(cells: Cells, p: int, q: int, value: tuple) -> None:
    k = _at(p, q)
    if cells[k] is None or value < cells[k]:
        cells[k] = value


def _joined(x: Cells, y: Cells, rules) -> Cells:
    out: Cells = [None] * (STATES * STATES)
    for pq, pr, rq in rules:
        a, b = x[pr], y[rq]
        if a is not None and b is not None:
            value = (a[0] + b[0], a[1] + b[1])
            if out[pq] is None or value < out[pq]:
                out[pq] = value
    return out


_ALL_RULES = [(_at(p, q), _at(p, r), _at(r, q)) for p in range(STATES) for q in range(STATES) for r in range(STATES)]


def _insertions() -> Cells:
    """The insertion closure: least inserts between two states."""
    once: Cells = [None] * (STATES * STATES)
    for p in range(STATES):
        _put(once, p, p, (0, ""))
        for role in _WRITTEN:
            if p in _STEP[role]:
                _put(once, p, _STEP[role][p], (INSERT, "I"))
    closed = once
    for _ in range(STATES):
        closed = _joined(closed, once, _ALL_RULES)
    return closed


CLOSURE = _insertions()
#: Rules whose three nonterminals can derive something; only a kept row leads into state 1.
RULES = [r for r in _ALL_RULES if all(CLOSURE[k] is not None or k == _at(0, 1) for k in r)]


def combine(x: Cells, y: Cells) -> Cells:
    """The cells of a span from those of its two parts."""
    return _joined(x, y, RULES)


def symbol(initial: str, fault: str) -> str:
    """One letter a row: its initial (x: none of s, u, a), upper case if truncated; ``-`` must be deleted."""
    if fault in ("blank", "duplicate"):
        return "-"
    letter = initial if initial in _STEP else "x"
    return letter.upper() if fault == "truncated" else letter


@lru_cache(maxsize=64)
def _row(sign: str) -> Cells:
    out: Cells = [None] * (STATES * STATES)
    extra = TRUNCATED if sign.isupper() else 0
    for p in range(STATES):
        _put(out, p, p, (DELETE, "D"))
        if sign == "-":
            continue
        if p in _STEP.get(sign.lower(), ()):
            _put(out, p, _STEP[sign.lower()][p], (KEEP + extra, "K"))
        for role in _WRITTEN:
            if p in _STEP[role]:
                _put(out, p, _STEP[role][p], (REROLE + extra, "R"))
    return combine(combine(CLOSURE, out), CLOSURE)


@lru_cache(maxsize=65536)
def _block(signs: str) -> Cells:
    """CYK over a short run: all spans, shortest first, every split point."""
    n = len(signs)
    table = {(i, i + 1): _row(s) for i, s in enumerate(signs)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            splits = [combine(table[i, k], table[k, i + length]) for k in range(i + 1, i + length)]
            table[i, i + length] = [min((c for c in cell if c is not None), default=None) for cell in zip(*splits)]
    return table[0, n]


def parse(signs: str) -> Cells:
    """The cells of a run of rows, given as :func:`symbol` letters."""
    if not signs:
        return CLOSURE
    spans = [_block(signs[i:i + BLOCK]) for i in range(0, len(signs), BLOCK)]
    while len(spans) > 1:  # neighbouring spans, shortest first
        spans = [combine(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def cheapest(pieces: list[Cells]) -> tuple[int, list[str]]:
    """Least cost of a whole conversation and the audit of each of its pieces."""
    best = {0: (0, "", None)}  # state -> cost, audit, (pieces before, this piece's audit)
    for cells in pieces:
        after: dict = {}
        for p, (cost, audit, trail) in best.items():
            for q in range(STATES):
                c = cells[_at(p, q)]
                if c is not None:
                    value = (cost + c[0], audit + c[1])
                    if q not in after or value < after[q][:2]:
                        after[q] = (*value, (trail, c[1]))
        best = after
    cost, _, trail = min((best[q] for q in ENDS if q in best), key=lambda b: b[:2])
    audits = []
    while trail:
        trail, audit = trail
        audits.append(audit)
    return cost, audits[::-1]


class Rewriter:
    """Streams the rows of one conversation and the audits of its pieces into the repaired text's hash."""

    def __init__(self):
        self.state, self.hash, self.any, self.audit, self.at = 0, hashlib.sha256(), False, "", 0

    def _emit(self, role: str, text: str, initial: str) -> None:
        self.hash.update((("\n" if self.any else "") + f"{role}:{text}").encode())
        self.any, self.state = True, _STEP[initial][self.state]

    def _written(self, text: str) -> None:
        if self.state == 2:
            self._emit("assistant", text, "a")
        else:
            self._emit("user", text, "u")

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._written("")
            self.at += 1

    def piece(self, audit: str) -> None:
        self.finish()
        self.audit, self.at = audit, 0

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._emit(role, text, role[:1])
        elif edit == "R":
            self._written(text)

    def finish(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


# ------------------------------------------------------------------- Spark ---

def _spaced(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: the rows after a fixed damage that depends on id and turn only.

    Equal rows of a turn are one row with a count, added up before the shuffle.
    """
    code = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))) % 20
    role, text = _spaced("role"), _spaced("text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, SENTENCE_ENDS, "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("n"))
    return rows.where("n > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """Adds ``digest`` and ``fault`` (null, blank, duplicate or truncated) of each row's first copy."""
    rows = saved(rows.withColumn("digest", F.sha2("text", 256)), "repair-rows")
    said = (rows.groupBy("conv_id", "role", "digest")
            .agg(F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("untimed"),
                 F.count(F.lit(1)).alias("places")).where("places > 1").drop("places"))
    r, s = rows.alias("r"), said.alias("s")
    both = r.join(s, F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.role") == F.col("s.role"))
                  & (F.col("r.digest") == F.col("s.digest")), "left")
    body = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    again = F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("first_turn")))
    fault = (F.when(body == "", "blank").when(again, "duplicate")
             .when(~F.right(body, F.lit(1)).isin(*SENTENCE_ENDS), "truncated"))
    return both.select("r.*", "first_turn", "untimed").select(*rows.columns, fault.alias("fault"))


PIECE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("costs", pa.list_(pa.int64())),
                   ("audits", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
                   ("turns", pa.list_(pa.int64())), ("ends", pa.string())])
PIECE_SQL = ("conv_id long, place long, costs array<long>, audits array<string>, counts array<long>, "
             "turns array<long>, ends string")
_FITS = ("su", "ua", "au")


def _initial(role: str) -> str:
    return role[:1] or " "


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """One row per run of a conversation's neighbouring rows in a task.

    counts: rows, blank, duplicate, truncated, illegal pairs, distinct turns; turns: first and last one
    that is not null; ends: initials of the first and the last row.
    """
    run = None  # conv_id, place, last place, symbols, counts, turns, ends

    def closed():
        conv, place, _, signs, counts, turns, ends = run
        cells = parse("".join(signs))
        return (conv, place, [c and c[0] for c in cells], [c and c[1] for c in cells], counts, turns, ends)

    for batch in batches:
        out = []
        for conv, place, turn, initial, fault, copies in zip(*(batch.column(n).to_pylist() for n in (
                "conv_id", "place", "turn", "initial", "fault", "copies"))):
            initial = _initial(initial)
            if run is None or run[0] != conv or run[2] + 1 != place:
                if run is not None:
                    out.append(closed())
                run = [conv, place, place, [], [0] * 6, [None, None], ""]
            signs, counts, turns, ends = run[3:]
            counts[0] += copies
            if fault:
                counts[("blank", "duplicate", "truncated").index(fault) + 1] += 1
            counts[1 if fault == "blank" else 2] += copies - 1
            counts[4] += copies - 1  # equal initials never fit
            if ends and ends[1] + initial not in _FITS:
                counts[4] += 1
            if turn is not None and turn != turns[1]:
                counts[5] += 1
                run[5] = [turn if turns[0] is None else turns[0], turn]
            signs.append(symbol(initial, fault or "") + "-" * (copies - 1))
            run[2], run[6] = place, (ends[:1] or initial) + initial
        if out:
            yield columns(out, PIECE)
    if run is not None:
        yield columns([closed()], PIECE)


EDITS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edits", pa.string()),
                   ("counts", pa.list_(pa.int64()))])


def _choices(batches) -> Iterator[pa.RecordBatch]:
    """Per conversation (its pieces in order): the edits of each piece, and with the first the conversation's counts."""
    for batch in batches:
        for conv, pieces in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "pieces"))):
            cells = [[None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"])] for p in pieces]
            cost, audits = cheapest(cells)
            total, before, turns = [0] * 6, None, [None, None]
            for p in pieces:
                total = [x + y for x, y in zip(total, p["counts"])]
                if before is not None and before + p["ends"][0] not in _FITS:
                    total[4] += 1
                before = p["ends"][1]
                low, high = p["turns"]
                if low is not None:
                    total[5] -= low == turns[1]
                    turns = [low if turns[0] is None else turns[0], high]
            gaps = 0 if turns[0] is None else turns[1] - turns[0] + 1 - total[5]
            counts = [gaps, *total[1:5], cost]
            yield columns([(conv, p["place"], a, None if k else counts)
                           for k, (p, a) in enumerate(zip(pieces, audits))], EDITS)


RESULT = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()),
    ("repaired_sha256", pa.string())])


def _rewritten(batches) -> Iterator[pa.RecordBatch]:
    """Streams a conversation's id, then each piece's edits before the piece's rows."""
    now, text, counts, audit = None, None, None, []

    def result():
        return (now, *(counts or [0] * 6), "".join(audit), text.finish())

    for batch in batches:
        out = []
        for conv, kind, role, said, copies, edits, given in zip(*(batch.column(n).to_pylist() for n in (
                "conv_id", "kind", "role", "text", "copies", "edits", "counts"))):
            if kind == 0:
                if text is not None:
                    out.append(result())
                now, text, counts, audit = conv, Rewriter(), None, []
            elif kind == 1:
                text.piece(edits)
                counts = given or counts
                audit.append(edits)
            else:
                for _ in range(copies):
                    text.row(role, said)
        if out:
            yield columns(out, RESULT)
    if text is not None:
        yield columns([result()], RESULT)


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation id of the damaged table: counts, least cost, its audit and the repaired text's hash."""
    spark = conversations.sparkSession
    keys = ["conv_id", "turn", "role", "digest"]
    marked = faults(damaged(conversations))
    rows = saved(marked.repartitionByRange(default_parallelism(spark), *keys).sortWithinPartitions(*keys)
                 .withColumn("place", F.monotonically_increasing_id()).drop("digest"), "repair-ordered")
    narrow = rows.select("conv_id", "place", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    pieces = saved(map_batches(narrow, _pieces, PIECE_SQL), "repair-pieces")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", "costs", "audits", "counts", "turns", "ends"))).alias("pieces"))
    edits = map_batches(whole, _choices, "conv_id long, place long, edits string, counts array<long>")

    def part(df, kind: int):
        missing = {"place": "long", "role": "string", "text": "string", "copies": "long", "edits": "string",
                   "counts": "array<long>"}
        return df.select("conv_id", F.lit(kind).alias("kind"), *(
            F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in missing.items()))

    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    stream = part(ids, 0).union(part(edits, 1)).union(part(rows, 2))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")
    return map_batches(stream, _rewritten, "conv_id long, gaps long, blank long, duplicate long, truncated long, "
                                           "illegal long, cost long, audit string, repaired_sha256 string")


def crc32_sql(text: str) -> str:
    """DuckDB form of crc32 over an ASCII string: the bitwise rule as one fold over the bits."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ord(substr({text}, i, 1)), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: {step}), 4294967295)"


SQL = rf"""
WITH RECURSIVE
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
c AS (SELECT *, {crc32_sql("name")} % 20 AS code FROM k),
d AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
  CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE code <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
f AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
g AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN again THEN 'duplicate'
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM f),
-- row edits from state p to state q, and inserts after them
e(initial, letter, p, q, price) AS (VALUES
  ('s', 'K', 0, 1, 0), ('u', 'K', 0, 2, 0), ('u', 'K', 1, 2, 0), ('u', 'K', 3, 2, 0), ('a', 'K', 2, 3, 0),
  (NULL, 'R', 0, 2, 3), (NULL, 'R', 1, 2, 3), (NULL, 'R', 3, 2, 3), (NULL, 'R', 2, 3, 3),
  (NULL, 'D', 0, 0, 4), (NULL, 'D', 1, 1, 4), (NULL, 'D', 2, 2, 4), (NULL, 'D', 3, 3, 4)),
n(p, q, inserts) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1),
  (3, 3, 0), (3, 2, 1)),
moves AS (SELECT g.conv_id, g.i, e.p, n.q, e.letter || repeat('I', n.inserts) AS edits,
  e.price + 3 * n.inserts + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS price
  FROM g JOIN e ON (e.initial IS NULL OR e.initial = left(g.role, 1))
    AND (letter = 'D' OR coalesce(fault, '') NOT IN ('blank', 'duplicate')) JOIN n ON n.p = e.q),
r AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, q, CAST(3 * inserts AS BIGINT) AS cost, repeat('I', inserts) AS audit
  FROM (SELECT DISTINCT conv_id FROM o), n WHERE p = 0
  UNION ALL
  SELECT conv_id, i, q, best.cost, best.audit FROM (
    SELECT r.conv_id, m.i, m.q, min(struct_pack(cost := r.cost + m.price, audit := r.audit || m.edits)) AS best
    FROM r JOIN moves m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND m.i = r.i + 1 AND m.p = r.q
    GROUP BY r.conv_id, m.i, m.q)),
s AS (SELECT conv_id, max(i) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
w AS (SELECT s.conv_id, min(struct_pack(cost := r.cost, audit := r.audit)) AS best FROM s JOIN r
  ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.rows WHERE r.q IN (0, 3) GROUP BY s.conv_id),
l AS (SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS pos FROM w),
x AS (SELECT conv_id, pos, audit[pos] AS letter, length(replace(audit[1:pos], 'I', '')) AS i,
  length(replace(audit[1:pos], 'D', '')) - length(replace(audit, 'D', '')) % 2 AS place FROM l),
t AS (SELECT x.conv_id, string_agg(
    CASE WHEN letter = 'K' THEN g.role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE g.text END, chr(10) ORDER BY pos) AS said
  FROM x LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM x.conv_id AND g.i = x.i WHERE letter <> 'D' GROUP BY x.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
  LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""
