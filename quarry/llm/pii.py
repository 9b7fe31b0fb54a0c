"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns. Wider patterns propose
further candidates: phone numbers without a plus sign, bracketed e-mail addresses
(``name [at] host [dot] tld``), IPv6 addresses and card-like numbers. A run of digits
that may hold several numbers is also split: grouped forms first, then the rest at its
separators; of candidates that overlap, the most probable is added. Six labelers
(strict pattern, checksum or range, gazetteer, context for, context against,
surroundings) vote for, against or abstain on every candidate, base spans
included. The votes are counted by pattern in Spark (a table bounded by the number
of patterns, whatever the corpus' size); expectation-maximisation over the counts
estimates each labeler's reliability and each pattern's posterior; a logistic span
classifier is trained on the posteriors and decides which candidates are added.
Base spans always stay, and an added span overlaps no other span.

Defined cases: null texts are empty; a text without candidates has no spans;
repeated rows are treated alike; an empty table gives an empty result; scanning is
linear in the text, however long its runs of digits or letters are; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches, text_rows
from quarry.llm.quality import logistic
from quarry.llm.store import saved

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LABELERS = ("strict", "valid", "gazetteer", "context_for", "context_against", "surroundings")
ADD_FROM = 0.9  # a candidate is added from this probability on

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HAS_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}"
                 r"(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]{1,63}){1,8}", re.I)
_SPELLED_AT, _SPELLED_DOT = (re.compile(rf" ?[\[(] ?{w} ?[\])] ?", re.I) for w in ("at", "dot"))
_BRACKETED_AT = re.compile(r"[\[(] ?at ?[\])]", re.I)
_BARE_PHONE = re.compile(r"[0-9(](?:[ ().-]{0,3}[0-9])+")
_FORM = re.compile(r"(?P<phone>(?:(?<![0-9])1[ .-]{1,2})?(?:\([0-9]{3}\)[ .-]{0,2}|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
                   r"|(?<![0-9])[0-9]{2}(?:[ .-][0-9]{2}){4})(?![0-9])"
                   r"|(?<![0-9])[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}(?![0-9])")
_WIDE, _PART = re.compile(r"[0-9](?:[.-]?[0-9])*"), re.compile(r"[0-9]+")
_SIX = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Fa-f:])")
_NANP = re.compile(r"\+?1?[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$")
_GROUPS = re.compile(r"[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}$|[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}$")
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,18}$")
_WORD = re.compile(r"[^\W\d_]+")

#: Top-level domains and mail words, card prefixes, calling codes, and context words by kind.
DOMAINS = frozenset("com net org edu gov mil int info biz io co uk de fr es it nl eu us ca au jp cn ru br in ch at be "
                    "example test mail email gmail yahoo outlook hotmail proton icloud".split())
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "22", "23", "24", "25", "26", "27")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                 "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81",
                 "82", "84", "86", "90", "91", "92", "98", "351", "352", "353", "358", "380", "420", "971", "972")
FOR = {EMAIL: frozenset("email mail contact write reach correo courriel".split()),
       IP: frozenset("ip address host server client login from".split()),
       CARD: frozenset("card credit visa mastercard amex debit payment tarjeta carte karte".split()),
       PHONE: frozenset("phone tel telephone call mobile cell fax whatsapp sms contact telefon teléfono téléphone".split())}
AGAINST = frozenset("version release build chapter section page isbn order invoice ticket serial token key hash commit id "
                    "price total year date lat lon".split())


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost non-overlapping e-mail matches, in linear time: each @ is tried once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def _addresses(text: str):
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) // 4 * 4, 4):
            four = parts[k:k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, by start and kind."""
    out = [(a, EMAIL, b) for a, b in _emails(text)]
    if _HAS_DIGIT.search(text):
        out += [(a, IP, b) for a, b in _addresses(text)]
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _only_digits(m.group())
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), CARD, m.end()))
        if "+" in text:
            out += [(m.start(), PHONE, m.end()) for m in _PHONE.finditer(text)
                    if 10 <= len(_only_digits(m.group())) <= 15]
    return sorted(out)


def _kinds(digits: int) -> list[int]:
    """What a run of so many digits may be."""
    return [PHONE] * (7 <= digits <= 15) + [CARD] * (13 <= digits <= 19)


def _numbers(text: str, start: int, end: int):
    """Candidates in a run of digits and separators: the whole run if one number can have so many digits,
    and the pieces of a run that can hold more than one."""
    n = len(_only_digits(text[start:end]))
    if end - start <= 60:
        yield from ((start, kind, end) for kind in _kinds(n))
    if n < 13:
        return
    rest, at = [], start
    for m in _FORM.finditer(text, start, end):
        rest.append((at, m.start()))
        at = m.end()
        if m.span() != (start, end) or m["phone"]:
            yield m.start(), PHONE if m["phone"] else CARD, m.end()
    for a, b in [*rest, (at, end)]:
        for m in _WIDE.finditer(text, a, b):  # at blanks and brackets, then at every separator
            own = [m]
            if len(_only_digits(m.group())) > 19:
                own = _PART.finditer(text, m.start(), m.end())
            for x in own:
                if x.span() != (start, end):
                    yield from ((x.start(), kind, x.end()) for kind in _kinds(len(_only_digits(x.group()))))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further spans worth a vote, apart from the base spans; only those of one run of digits overlap."""
    found = []  # with the run of digits that a span is from
    if _BRACKETED_AT.search(text):
        found += [(m.start(), EMAIL, m.end(), -1) for m in _AT.finditer(text)]
    if _HAS_DIGIT.search(text):
        for m in _BARE_PHONE.finditer(text):
            if m.end() - m.start() >= 7:
                found += [(*x, m.start()) for x in _numbers(text, *m.span())]
    if text.count(":") > 1:
        for m in _SIX.finditer(text):
            try:
                ipaddress.IPv6Address(m.group())
            except ValueError:
                continue
            found.append((m.start(), IP, m.end(), -1))
    taken = sorted((a, b) for a, _, b in base)
    out, k, free, last = [], 0, 0, -1
    for a, kind, b, run in sorted(found, key=lambda x: (x[0], -x[2], x[1])):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if (a >= free or run == last >= 0) and not (k < len(taken) and taken[k][0] < b):
            out.append((a, kind, b))
            free, last = max(free, b), run
    return out


def votes(text: str, start: int, kind: int, end: int) -> list[int]:
    """The labelers' votes on a span: 1 for, -1 against, 0 abstains."""
    s, before = text[start:end], text[max(0, start - 40):start]
    digits = _only_digits(s)
    six = kind == IP and ":" in s
    if kind == EMAIL:
        address = _SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", s))
        strict, valid = bool(_MAILBOX.match(address)), ".." not in address
        gazetteer = any(p.lower() in DOMAINS for p in address.partition("@")[2].split("."))
    elif kind == IP:
        parts = s.split(".")
        strict = six or all(p == str(int(p)) for p in parts if len(p) < 5)
        valid = six or parts[0].strip("0") != ""
        gazetteer = six or parts[0] in ("10", "127", "172", "192", "203", "198")
    elif kind == CARD:
        strict, valid = bool(_GROUPS.match(s)), _luhn(digits)
        gazetteer = digits.startswith(CARD_PREFIXES)
    else:
        strict, valid = bool(_NANP.match(s)) or s.startswith("+"), 10 <= len(digits) <= 15
        gazetteer = s.startswith("+") and digits.startswith(CALLING_CODES) or "555" in s
    near = {w.lower() for w in _WORD.findall(before)}
    left, right = text[start - 1:start], text[end:end + 1]
    glued = left.isalnum() or right.isalnum() or left in tuple("=/#_\"'") and left != ""
    return [1 if strict else -1, 1 if valid else -1, 1 if gazetteer else 0, 1 if near & FOR[kind] else 0,
            -1 if near & AGAINST else 0, -1 if glued else 1]


def _shape(text: str, start: int, kind: int, end: int) -> list[int]:
    """Small numbers that describe a span: digits, separators, brackets."""
    s = text[start:end]
    return [min(len(_only_digits(s)) // 3, 6), min(sum(c in " .-" for c in s), 3), int("(" in s or "[" in s)]


def scanned(docs: DataFrame) -> DataFrame:
    """Per document: its id, base spans and candidates with their patterns, written once."""
    span = "array<struct<start: long, kind: int, end: long, pattern: array<int>>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                               ("pattern", pa.list_(pa.int32()))]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", kind), ("more", kind)])

    def run(batches):
        def described(text, spans):
            return [{"start": a, "kind": k, "end": b, "pattern": [k, *votes(text, a, k, b), *_shape(text, a, k, b)]}
                    for a, k, b in spans]

        for batch in batches:
            rows = []
            for doc_id, text in text_rows(batch, "doc_id", "text"):
                base = base_spans(text)
                rows.append((doc_id, described(text, base), described(text, candidates(text, base))))
            yield columns(rows, schema)

    rows = map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, f"doc_id long, base {span}, more {span}")
    return saved(rows, "pii-spans")


def posteriors(kinds: np.ndarray, vote: np.ndarray, count: np.ndarray, rounds: int = 200):
    """EM over counted vote patterns: posterior of each, and ``P(vote | truth)`` of each labeler and kind."""
    n = vote.shape[1]
    agree = (vote > 0).sum(axis=1) - (vote < 0).sum(axis=1)
    p = 1 / (1 + np.exp(-agree.astype(float)))  # the start: a majority vote
    table = np.zeros((2, len(KINDS), n, 3))
    for _ in range(rounds):
        prior = np.ones((2, len(KINDS)))
        table[:] = 1.0  # Laplace smoothing
        for truth, share in ((0, 1 - p), (1, p)):
            np.add.at(prior[truth], kinds, share * count)
            for j in range(n):
                np.add.at(table[truth, :, j], (kinds, vote[:, j] + 1), share * count)
        table /= table.sum(axis=3, keepdims=True)
        prior /= prior.sum(axis=0)
        log = np.log(prior[:, kinds])
        for truth in (0, 1):
            for j in range(n):
                log[truth] += np.log(table[truth, kinds, j, vote[:, j] + 1])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done = np.abs(new - p).max(initial=0) < 1e-9
        p = new
        if done:
            break
    return p, table


def _features(patterns: np.ndarray) -> np.ndarray:
    kind, vote, shape = patterns[:, 0], patterns[:, 1:1 + len(LABELERS)], patterns[:, 1 + len(LABELERS):]
    one = [np.ones(len(kind))] + [kind == k for k in range(len(KINDS))]
    for j in range(vote.shape[1]):
        one += [vote[:, j] > 0, vote[:, j] < 0]
    one += [shape[:, 0] == d for d in range(7)] + [shape[:, 1] == d for d in range(4)] + [shape[:, 2]]
    return np.stack(one, axis=1).astype(float)


@dataclass
class SpanClassifier:
    weights: np.ndarray
    reliabilities: np.ndarray

    def probabilities(self, patterns: list[list[int]]) -> np.ndarray:
        x = _features(np.array(patterns, np.int64).reshape(-1, 4 + len(LABELERS)))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(spans: DataFrame) -> SpanClassifier:
    """Train on the pattern counts of all documents; only distinct patterns reach the driver."""
    counted = spans.select(F.explode(F.concat("base", "more")).alias("s")).groupBy("s.pattern").count().collect()
    if not counted:
        return SpanClassifier(np.zeros(_features(np.zeros((1, 4 + len(LABELERS)), int)).shape[1]), np.zeros(0))
    counted = sorted((list(r["pattern"]), r["count"]) for r in counted)
    patterns = np.array([p for p, _ in counted], np.int64)
    count = np.array([c for _, c in counted], float)
    p, table = posteriors(patterns[:, 0], patterns[:, 1:1 + len(LABELERS)], count)
    return SpanClassifier(logistic(_features(patterns), p, count, ridge=1.0), table)


def _apart(spans: list[tuple[int, int, int]], p: np.ndarray) -> list[tuple[int, int, int]]:
    """Of spans that overlap, the most probable; then the longest, then the first."""
    free, ends, out = [], [], []  # sorted starts and ends of the spans taken
    for _, _, (a, kind, b) in sorted((-x, s[0] - s[2], s) for x, s in zip(p.tolist(), spans) if x >= ADD_FROM):
        k = bisect_left(ends, a + 1)
        if k == len(free) or free[k] >= b:
            free.insert(k, a)
            ends.insert(k, b)
            out.append((a, kind, b))
    return out


def spans_found(spans: DataFrame, model: SpanClassifier) -> DataFrame:
    """One row per document with its counts and span strings."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string())])

    def listed(own):
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(own))

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, base, more in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "base", "more"))):
                own = [(s["start"], s["kind"], s["end"]) for s in base]
                if more:
                    more = _apart([(s["start"], s["kind"], s["end"]) for s in more],
                                  model.probabilities([s["pattern"] for s in more]))
                text = listed(own)
                counts = [sum(k == x for _, x, _ in own) for k in range(len(KINDS))]
                rows.append((doc_id, *counts, hashlib.sha256(text.encode()).hexdigest(),
                             listed(own + more) if more else text))
            yield columns(rows, schema)

    return map_batches(spans, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                   "base_sha256 string, spans string")
