"""Benchmark decontamination by template windows.

Texts become templates: words without outer punctuation, lower-cased, with
numbers, names (a capital inside a sentence) and units (a unit word after a
number) replaced by typed placeholders. Windows of WINDOW template tokens of the
documents are hash-joined with those of the benchmark, confirmed on the template
text, and aligned by their shift. The slots of an alignment must map the item's
values to the document's consistently, in both directions, in at least
CONSISTENT of the places: a question that was re-parameterised is found, a
template that only looks alike is not. A document is contaminated by an item
when consistent windows cover half of the item's tokens, or LONG_RUN of them.

Which words are names depends on capitals and on the word before, so every text is
read in further ways, and a window matches if any two readings do: with each
capitalised word but the COMMON ones as a name, wherever it stands, and with no names
at all, every word lower-cased. Copies that differ in case or stand elsewhere are
found by these, and the covered tokens of all readings are united.

Names and numbers of several words ("Ana Maria", "twenty five") are one token in a second family
of windows, with places of its own, so that slots of different length keep their alignment;
a document is contaminated if either family says so.

A window with fewer literals than half its tokens (or none, if it is a whole item)
says little as a template; it is joined on its raw lower-cased words instead, so
verbatim copies of number-rich items are found and bare placeholders match nothing.

The benchmark's window hashes are sent to the tasks when there are at most
BROADCAST_WINDOWS of them (16 MB); beyond, all windows of the documents are
joined by a shuffle, with the same result.

Defined cases: null and empty texts have no windows; an item shorter than a
window is one window of its own length; an item without any word has none; an
empty benchmark or document table gives an empty result; rows that repeat an id
are one document or item; extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches, text_rows
from quarry.llm.store import saved

WINDOW, LONG_RUN, COVERAGE, CONSISTENT = 8, 20, 0.5, 0.8
BROADCAST_WINDOWS = 2_000_000
LITERAL, NUMBER, NAME, UNIT, NOTHING, BREAK = range(6)
PLACEHOLDER = {NUMBER: "<num>", NAME: "<name>", UNIT: "<unit>"}
#: Words that are units after a number, and numbers in words.
UNITS = frozenset("""% percent mm cm m km inch inches in ft foot feet yd yard yards mile miles mg g kg gram grams
lb lbs pound pounds oz ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds sec s minute
minutes min hour hours h day days week weeks month months year years mph kph dollar dollars usd cent cents euro euros
eur € $ £ degrees degree celsius fahrenheit watts watt kw volts volt joules joule hz khz mhz gb mb kb bytes""".split())
NUMBER_WORDS = frozenset("""two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
#: Words that are no names, though a capital starts them.
COMMON = frozenset("""a about after all also although an and any are as at because been before both but by can could did do
does during each either every few find first for from give given had has have he her here his how i if in into is it its
let may might more most must my no not now of on one only or other our she should show since so solve some such than that
the their then there these they this those though through to under until was we were what when where whether which while
who whom whose why will with would you your le la les un une des el los las una que de""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_STEP = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WINDOW)], np.uint64)
_TOP = np.uint64(42)
_KIND_HASH = np.array([0, 0x51ED270B, 0x2545F491, 0x4F6CDD1D], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def core(word: str) -> str:
    """A word without outer punctuation."""
    a, b = 0, len(word)
    while a < b and not (word[a].isalnum() or word[a] in "$€£%+-" and a + 1 < b):
        a += 1
    while b > a and not (word[b - 1].isalnum() or word[b - 1] in "%$€£"):
        b -= 1
    return word[a:b]


class Words(dict):
    """Numbers of raw words, and their properties by number; emptied between texts at ``limit`` words."""

    def __init__(self, limit: int = 60_000):
        super().__init__()
        self.limit = limit
        self.hash, self.kind, self.flags = np.zeros(1024, np.uint64), np.zeros(1024, np.uint8), np.zeros(1024, np.uint8)

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        if n == len(self.hash):
            for name in ("hash", "kind", "flags"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        c = core(word)
        low = c.lower()
        self.hash[n] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass"))
        self.kind[n] = (BREAK if word == _NEWLINE else NOTHING if not c
                        else NUMBER if _NUMBER.match(c) or low in NUMBER_WORDS else LITERAL)
        ends = word.rstrip("\"')]}»”’")[-1:] in tuple(".!?:")
        self.flags[n] = (ends + 2 * c[:1].isupper() + 4 * (low in UNITS) + 8 * (low in COMMON)
                         + 16 * (not word.endswith(c)) + 32 * (low in NUMBER_WORDS))
        return n

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_NEWLINE = "\x00"
_TOGETHER = 1 << 18  # characters of texts that are worked off together
_words = Words()


class Templates:
    """The templates of some texts, token after token in one array each.

    ``raw`` hashes and ``kinds`` of the tokens, ``capital``: by their look names, ``text``: which text each is of, ``place``: its
    word among ``words``; ``first``: the first tokens of the joint ones (names and numbers of several words as one).
    """

    def __init__(self, texts: list[str]):
        # every text ends with a line break, which no window and no sentence crosses
        self.words, sizes = [], []
        for text in texts:
            own = text.replace("\n", f" {_NEWLINE} ").split()
            own.append(_NEWLINE)
            self.words += own
            sizes.append(len(own))
        n = _words.numbers(self.words)
        kind, flags = _words.kind[n], _words.flags[n]
        start = np.ones(len(n), bool)
        start[1:] = (flags[:-1] & 1 > 0) | (kind[:-1] == BREAK)
        kind[(kind == LITERAL) & (flags & 2 > 0) & ~start] = NAME
        self.place = kept = np.flatnonzero(kind < NOTHING)
        self.text = np.repeat(np.arange(len(texts)), sizes)[kept]
        kind, n, flags = kind[kept], n[kept], flags[kept]
        after = np.zeros(len(kind), bool)
        after[1:] = (kind[:-1] == NUMBER) & (self.text[1:] == self.text[:-1])
        kind[after & (flags & 4 > 0)] = UNIT
        self.raw, self.kinds, self.capital = _words.hash[n], kind, flags & 10 == 2
        self.read = readings(self.raw, kind, self.capital)
        named = self.read[1][1]
        # a name goes on with a name, a number with a number word, if neither punctuation nor anything else is between
        goes_on = np.zeros(len(kind), bool)
        goes_on[1:] = ((named[1:] == named[:-1]) & ((named[1:] == NAME) | (named[1:] == NUMBER) & (flags[1:] & 32 > 0))
                       & (flags[:-1] & 16 == 0) & (np.diff(kept) == 1))
        self.first = np.flatnonzero(~goes_on)
        self.joint = (self.read[1][0][self.first], named[self.first])

    def shown(self, family: int, p: int, size: int, kinds: np.ndarray) -> tuple[str, list[str]]:
        """A window's template text and its slots' values, typed."""
        at = np.arange(p, p + size + 1) if not family else np.append(self.first, len(self.place))[p:p + size + 1]
        place = np.append(self.place, len(self.words))
        out, slots = [], []
        for a, b, kind in zip(at[:-1].tolist(), at[1:].tolist(), kinds[p:p + size].tolist()):
            value = " ".join(core(self.words[k]).lower() for k in place[a:b].tolist())
            out.append(PLACEHOLDER.get(kind, value))
            if kind != LITERAL:
                slots.append(f"{PLACEHOLDER[kind]}{value}")
        return " ".join(out), slots


def window_hashes(tokens: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all windows, or of those that begin ``at`` the given tokens."""
    n = len(tokens) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    t = _mix(tokens)
    x = np.full(n if at is None else len(at), size, np.uint64) * _STEP[-1]
    for k in range(size):
        x += (t[k:n + k] if at is None else t[at + k]) * _STEP[k]
    return _mix(x)


def _spread(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[at] = values
    return out


def _touched(marked: np.ndarray, size: int) -> np.ndarray:
    """Which windows hold a marked token."""
    upto = np.concatenate([[0], np.cumsum(marked)])
    return upto[size:] > upto[:-size]


def readings(raw: np.ndarray, kinds: np.ndarray, capital: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and kinds of a text's tokens: as a template, with every capitalised word as a name, without names,
    and as raw lower-cased words."""
    word = (kinds == LITERAL) | (kinds == NAME)
    named = np.where(word, np.where(capital, NAME, LITERAL), kinds)
    return [(np.where(k == LITERAL, raw, _KIND_HASH[k]), k)
            for k in (kinds, named, np.where(word, LITERAL, kinds), np.zeros_like(kinds))]


def telling(read: list[tuple[np.ndarray, np.ndarray]], size: int) -> list[np.ndarray]:
    """Which windows of an item count in each reading: templates with enough literals, the others as raw words."""
    enough, some, whole = [], [], len(read[0][0]) == size
    for _, kinds in read:
        literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
        n = literal[size:] - literal[:-size]
        enough.append(2 * n >= size)
        some.append(enough[-1] | whole & (n > 0))
    return [some[0], enough[1], some[2], ~some[2]]


_WINDOW_ROW = ("id long, family int, pos int, size int, hash long, n_tokens int, template string, slots array<string>")
_SCHEMA = pa.schema([("id", pa.int64()), ("family", pa.int32()), ("pos", pa.int32()), ("size", pa.int32()),
                     ("hash", pa.int64()), ("n_tokens", pa.int32()), ("template", pa.string()),
                     ("slots", pa.list_(pa.string()))])


def windows(table: DataFrame, id_col: str, sizes: list[int] | None, wanted=None) -> DataFrame:
    """Template windows of a table's texts.

    ``sizes`` None: windows of each item's own size (WINDOW or, if shorter, its
    length), in the readings that :func:`readings` gives and :func:`telling` keeps.
    Other tables have every reading of every window, equal ones once. Family 0 counts single words, family 1
    names and numbers of several words as one token. ``wanted``: a
    broadcast sorted array; other hashes are left out.
    """
    def run(batches):
        w = bits = None
        if wanted is not None:  # the hashes' top bits rule out most windows
            w, bits = wanted.value, np.zeros(1 << 64 - int(_TOP), bool)
            bits[w >> _TOP] = True

        def looked_up(h):
            """The places of wanted hashes."""
            if bits is None:
                return np.arange(len(h))
            at = np.flatnonzero(bits[h >> _TOP])
            return at[w[np.minimum(np.searchsorted(w, h[at]), len(w) - 1)] == h[at]]

        def of_items(t, size):
            """Windows of one item in every reading that counts, equal ones once: (family, place, hash, kinds)."""
            before = []
            for (hashes, kinds), counts in zip(t.read, telling(t.read, size)):
                h, take = window_hashes(hashes, size), counts.copy()
                for other, taken in before:
                    take &= ~((h == other) & taken)
                before.append((h, take))
                yield 0, np.flatnonzero(take), h, kinds
            size = min(WINDOW, len(t.first))
            h = window_hashes(t.joint[0], size)
            yield 1, np.flatnonzero(telling([t.joint] * 4, size)[0]), h, t.joint[1]

        def of_texts(t, size):
            """Wanted windows of many texts in every reading, equal ones once."""
            inside = t.text[:len(t.text) - size + 1] == t.text[size - 1:]
            all_h = {}
            # a reading differs from the one before it in few tokens: only windows that hold one of these are hashed
            for r, like in ((0, None), (1, 0), (2, 0), (3, 2)):
                hashes, kinds = t.read[r]
                new = inside if like is None else inside & _touched(kinds != t.read[like][1], size)
                if r == 2:  # names of both kinds are gone: equal to reading 1 where that has no name
                    new = new & _touched(kinds != t.read[1][1], size)
                if r == 3:  # and to the others where they have neither name nor number
                    new = new & _touched(kinds != t.read[0][1], size) & _touched(kinds != t.read[1][1], size)
                at = np.flatnonzero(new)
                h = window_hashes(hashes, size, None if like is None else at)
                found = looked_up(h if like is not None else h[at])
                yield 0, at[found], h if like is None else _spread(h, at, len(inside)), kinds
            if len(t.first) >= size:
                whose = t.text[t.first]
                h = window_hashes(t.joint[0], size)
                at = np.flatnonzero(whose[:len(h)] == whose[size - 1:])
                yield 1, at[looked_up(h[at])], h, t.joint[1]

        def rows_of(keys, texts):
            t = Templates(texts)
            n_tokens = (np.bincount(t.text, minlength=len(texts)), np.bincount(t.text[t.first], minlength=len(texts)))
            first = [np.cumsum(n) - n for n in n_tokens]
            whose = (t.text, t.text[t.first])
            for size in sizes or [min(WINDOW, len(t.text))]:
                if not 0 < size <= len(t.text):
                    continue
                for family, at, h, kinds in (of_items if sizes is None else of_texts)(t, size):
                    for p in at.tolist():
                        k = int(whose[family][p])
                        own = min(WINDOW, len(t.first)) if sizes is None and family else size
                        yield (keys[k], family, p - int(first[family][k]), own, int(h[p].view(np.int64)),
                               int(n_tokens[family][k]), *t.shown(family, p, own, kinds))

        for batch in batches:
            rows, keys, texts, held = [], [], [], 0
            for key, text in chain(text_rows(batch, "id", "text"), [(None, None)]):
                if texts and (text is None or sizes is None or held + len(text) > _TOGETHER):
                    rows += rows_of(keys, texts)
                    keys, texts, held = [], [], 0
                if text:
                    keys.append(key)
                    texts.append(text)
                    held += len(text)
                if len(rows) >= 4_000:
                    yield columns(rows, _SCHEMA)
                    rows = []
            if rows:
                yield columns(rows, _SCHEMA)

    return map_batches(table.select(F.col(id_col).cast("long").alias("id"), "text"), run, _WINDOW_ROW)


def _consistency(aligned: DataFrame) -> DataFrame:
    """Per alignment: its slots, the changed ones, and the share that maps consistently."""
    by = ["doc_id", "item_id", "family", "shift"]
    slot = (aligned.select(*by, "item_pos", F.explode(F.arrays_zip("item_slots", "slots")).alias("s"), )
            .select(*by, F.col("s.item_slots").alias("x"), F.col("s.slots").alias("y")))
    # a slot stands in up to WINDOW windows of its alignment: shares, not counts, are compared
    pairs = slot.groupBy(*by, "x", "y").agg(F.count("*").alias("n"))
    most = lambda key: pairs.groupBy(*by, key).agg(F.max("n").alias("n")).groupBy(*by).agg(F.sum("n").alias(f"of_{key}"))
    total = pairs.groupBy(*by).agg(F.sum("n").alias("places"),
                                   F.sum(F.when(F.col("x") != F.col("y"), F.col("n")).otherwise(0)).alias("changed"))
    return total.join(most("x"), by).join(most("y"), by).select(
        *by, "places", "changed", (F.least("of_x", "of_y") / F.col("places")).alias("consistency"))


def matches(docs: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``(doc_id, item_id, item_tokens, covered_tokens, coverage, changed_share)`` of contaminated documents."""
    spark = docs.sparkSession
    items = saved(windows(benchmark, "item_id", None), "bench-windows")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most WINDOW numbers
    hashes = items.select("hash").distinct()
    if hashes.count() <= broadcast_windows:
        found = np.sort(np.array([r[0] for r in hashes.collect()], np.int64).view(np.uint64))
        hits = windows(docs, "doc_id", sizes or [WINDOW], spark.sparkContext.broadcast(found))
    else:
        hits = windows(docs, "doc_id", sizes).join(hashes, "hash", "left_semi")
    hits = saved(hits.select(F.col("id").alias("doc_id"), "family", "pos", "hash", "template", "slots"), "bench-hits")
    own = items.select(F.col("id").alias("item_id"), "family", F.col("pos").alias("item_pos"), "size", "hash", "template",
                       F.col("n_tokens").alias("item_tokens"), F.col("slots").alias("item_slots"))
    aligned = saved(hits.join(own, ["family", "hash", "template"]).withColumn("shift", F.col("pos") - F.col("item_pos")),
                    "bench-aligned")
    by = ["doc_id", "item_id", "family", "shift"]
    checked = saved(_consistency(aligned), "bench-slots")
    on = F.lit(True)
    c = checked.toDF("d", "i", "f", "s", *checked.columns[4:])
    for a, b in zip(by, "difs"):
        on = on & aligned[a].eqNullSafe(c[b])
    good = aligned.join(c, on, "left").where(
        f"consistency is null or consistency >= {CONSISTENT} or slots = item_slots")
    good = good.groupBy("doc_id", "item_id", "family", "item_pos").agg(
        F.first("size").alias("size"), F.first("item_tokens").alias("item_tokens"),
        F.min(F.coalesce(F.col("changed") / F.col("places"), F.lit(0.0))).alias("changed"))
    after = F.lead("item_pos").over(Window.partitionBy("doc_id", "item_id", "family").orderBy("item_pos"))
    covered = F.least("size", F.coalesce(after - F.col("item_pos"), F.col("size")))
    out = good.withColumn("c", covered).groupBy("doc_id", "item_id", "family").agg(
        F.max("item_tokens").alias("item_tokens"), F.sum("c").cast("int").alias("covered_tokens"),
        F.min("changed").alias("changed_share"))
    out = out.withColumn("coverage", F.col("covered_tokens") / F.col("item_tokens")).where(
        f"coverage >= {COVERAGE} or covered_tokens >= {LONG_RUN}")
    # of the two families the one that covers more
    best = F.max(F.struct("coverage", (-F.col("family")).alias("_f"), "item_tokens", "covered_tokens", "changed_share"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", "b.item_tokens", "b.covered_tokens", "b.coverage", "b.changed_share")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    bad = saved(matches(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct(), "bench-bad")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti").select(
        *[docs[f"`{c}`"] for c in docs.columns])
