"""Quality, decontamination, personal data, chat and urls on small fixtures."""

import random
import re
import time

import public_tokenizers
import pytest

from quarry.llm import chat, decontaminate, pii, quality, url_filter
from quarry.sources.tables import load_table
from tests.llm.conftest import texts

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    import os
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    docs, labels = load_table(spark, sf, "documents"), load_table(spark, sf, "labels")
    out = quality.scored(docs, quality.fit(docs, labels))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_edge_cases(spark):
    good = [(k, f"a plain sentence number {k} about the weather of the day in town {k % 7}") for k in range(60)]
    bad = [(100 + k, f"BUY!!! NOW$$$ {k} ###CLICK### HERE!!!") for k in range(60)]
    rows = [*good, *bad, (500, None), (501, ""), (None, "x"), (502, "long " * 50000)]
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, _ in bad] + [(None, 1, 0), (7, None, 0), (8, 5, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = texts(spark, rows)
    model = quality.fit(docs, labels)
    got = {r["doc_id"]: r for r in quality.scored(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[5]["predicted"] == 1 and got[105]["predicted"] == 0
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["predicted"]}
    nothing = labels.where("false")
    assert {r["score"] for r in quality.scored(docs, quality.fit(docs, nothing)).collect()} == {0.5}
    assert quality.scored(texts(spark, []), model).collect() == []


ITEM = "If Ann has 5 km to go and Bob has 9 km left then how many km do Ann and Bob still have to go in total today?"


def test_template_matches(spark):
    changed = ITEM.replace("Ann", "Kim").replace("Bob", "Lee").replace("5", "12").replace("9", "31")
    muddled = "If Kim has 5 km to go and Joe has 5 km left then how many km do Mia and Lou still have to go in total today?"
    rows = [(1, ITEM), (2, changed), (3, "Some words before it.\n" + changed.replace("km", "miles") + "\nSome after."),
            (4, None), (5, ""), (6, "How many apples has Ann if she has 5 and Bob has 9?"), (2, changed), (None, ITEM),
            (7, "Long text without any match. " * 5000)]
    bench = spark.createDataFrame([(7, ITEM, "x"), (8, "Short words", "x"), (9, None, "x"), (10, "", "x")],
                                  "item_id long, text string, template string")
    want = {(1, 7), (2, 7), (3, 7), (None, 7)}
    for bound in (decontaminate.BROADCAST_WINDOWS, 0):  # sent to the tasks, or joined by a shuffle
        got = decontaminate.matches(texts(spark, rows), bench, bound).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        assert len(got) == len(want)
    kept = decontaminate.decontaminated(texts(spark, rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7]
    assert decontaminate.matches(texts(spark, []), bench).collect() == []
    assert decontaminate.matches(texts(spark, rows), bench.where("false")).collect() == []
    assert "km" in muddled


def test_inconsistent_slots_are_no_match(spark):
    item = "Ann and 3 met Ann and 3 met Ann and 3 met Ann and 3 met Ann and 3 met Ann"
    other = "Ann and 1 met Bob and 2 met Cid and 3 met Dan and 4 met Eve and 5 met Flo"
    bench = spark.createDataFrame([(1, "so " + item)], "item_id long, text string")
    got = decontaminate.matches(texts(spark, [(1, "so " + other), (2, "so " + item.replace("3", "8"))]), bench).collect()
    assert [r["doc_id"] for r in got] == [2]


def found(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    both = [{(r["doc_id"], r["item_id"]) for r in decontaminate.matches(texts(spark, rows), bench, bound).collect()}
            for bound in (decontaminate.BROADCAST_WINDOWS, 0)]
    assert both[0] == both[1]
    return both[0]


def test_items_poor_in_literals(spark):
    """Verbatim copies of items made of numbers or names are found; placeholders alone match nothing."""
    items = [(1, "Compute 12 + 34 - 56 * 78 / 9 + 10 + 11 + 13 + 14 + 15"), (2, "91 92"),
             (3, "The Great Wall Of China Was Built Under Many Kings And Queens Of Old")]
    rows = [(k, f"Some page says so. {t} Then it goes on.") for k, t in items]
    rows += [(10, "Compute 13 + 35 - 57 * 79 / 8 + 11 + 12 + 14 + 15 + 16"), (11, "in 1999 2004 and 77 78"),
             (12, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17"), (13, "An Old Man Met Many Great Men In That Big Town Of Ours")]
    assert found(spark, rows, items) == {(1, 1), (2, 2), (3, 3)}


def test_copies_in_other_case_or_place(spark):
    capital, apples = "What is the capital of France?", "Alice has 3 apples and buys 4 more"
    long = ("Maria and John from Paris took 12 books to London and gave Peter 7 of them before Anna came "
            "home to Berlin with 3 more for Paul. How many are left?")
    items = [(1, capital), (2, apples), (3, long)]
    rows = [(1, "They asked What is the capital of France? And so on."), (2, "we know that Alice has 3 apples and buys 4 more"),
            (3, long.upper()), (4, long.title()), (5, long.lower()), (6, long), (7, capital.upper()),
            (8, "Bob has 5 apples and buys 9 more"), (9, "then Bob has 5 apples and buys 9 more"),
            (10, "Paris is the capital of France."), (11, "He says Alice has 3 pears and eats 4 more")]
    assert found(spark, rows, items) == {(1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (6, 3), (7, 1), (8, 2), (9, 2)}


def test_items_of_the_tables_in_other_case(spark, sf):
    own = [(r["item_id"], r["text"]) for r in load_table(spark, sf, "benchmark").collect()]
    rows = [(n * 1000 + i, change(t)) for i, t in own for n, change in enumerate((str, str.upper, str.lower, str.title))]
    assert {(d, d % 1000) for d, _ in rows} <= found(spark, rows, own)


QUESTIONS = [
    "{a}, {b} and {c} share {x} dollars equally among themselves before they go to the old market, how much does each of them get?",
    "How many apples does {a} have left when {b} takes {x} of the {y} apples that were lying on the kitchen table?",
    "The train of {a} leaves the northern station at {x} and arrives after {y} minutes, so when does {b} have to be there?",
    "If {a} paints {x} walls in {y} hours, then how long do {b} and {a} together need for all the remaining walls?",
]
NAMES = ["Ana", "Boris", "Chloe", "Dmitri", "Elif", "Farah", "Goran", "Hana"]


def filled(question, rng, names, numbers):
    (a, b, c), (x, y) = rng.sample(names, 3), rng.sample(numbers, 2)  # different slots have different values
    return question.format(a=a, b=b, c=c, x=x, y=y)


def test_slots_of_several_words(spark):
    rng = random.Random(6)
    double = [f"{n} {s}" for n, s in zip(NAMES, ["Maria", "Ivanov", "Le Roy", "Petrov", "Kaya", "Haddad", "Horvat", "Novak"])]
    numbers, worded = ["3", "17", "40", "1,250"], ["twenty five", "three hundred", "9 million", "sixty"]
    bench = spark.createDataFrame([(k, filled(q, rng, NAMES, numbers)) for k, q in enumerate(QUESTIONS)], "item_id long, text string")
    kinds = [(NAMES, numbers), (double, numbers), (NAMES, worded), (double, worded)]
    rows, want = [], set()
    for k, question in enumerate(QUESTIONS):
        for kind, (names, values) in enumerate(kinds):
            for copy in range(5):
                doc = len(rows)
                rows.append((doc, f"So here is another one. {filled(question, rng, names, values)} That was it."))
                want.add((doc, k))
    # looks alike, but no slot maps consistently
    rows.append((len(rows), "The old market of Ana Maria has twenty five apples and so many minutes were lying on the table."))
    for bound in (decontaminate.BROADCAST_WINDOWS, 0):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(texts(spark, rows), bench, bound).collect()}
        assert got == want


def test_decontamination_against_brute_force(spark, sf):
    docs, bench = load_table(spark, sf, "documents"), load_table(spark, sf, "benchmark")
    grams = lambda t: {tuple(w[k:k + 6]) for w in [t.lower().split()] for k in range(len(w) - 5)}
    items = [(r["item_id"], grams(r["text"])) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for g in [grams(r["text"] or "")] for i, x in items
            if x and len(x & g) >= 0.6 * len(x)}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()} == want


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(t):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(PATTERNS[p], t):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
            if (p == "email" or p == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or p == "card" and 14 <= len(d) <= 19 and luhn or p == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_against_patterns():
    r = random.Random(3)
    parts = list("0123456789") * 3 + list("..@@ab -+()%_\n") + ["192.168.1.1", "4111 1111 1111 1111", "x@y.z", " +1 (555) 123-4567"]
    for _ in range(8000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_scanning_is_linear():
    began = time.process_time()
    for t in ("a" * 300000 + "@", "1" * 300000, "1." * 100000, "+1((" * 50000, "@" * 200000, "(at)" * 50000, "ab12:" * 50000):
        pii.candidates(t, pii.base_spans(t))
    assert time.process_time() - began < 20


def test_spans_added(spark):
    rows = [(k, f"Please call the phone {200 + k}-555-{1000 + k} or mail user{k} [at] host{k} [dot] com today") for k in range(60)]
    rows += [(100 + k, f"write to a{k}@b.example.com or phone +1 (555) 010-{1000 + k}; order number {10000000 + k} version {k}.2") for k in range(60)]
    rows += [(300, None), (301, ""), (302, "nothing here"), (302, "nothing here")]
    spans = pii.scanned(texts(spark, rows))
    got = {r["doc_id"]: r for r in pii.spans_found(spans, pii.fit(spans)).collect()}
    assert got[3]["n_phone"] == 0 and "phone:" in got[3]["spans"] and "email:" in got[3]["spans"]
    assert got[103]["n_email"] == 1 and got[103]["n_phone"] == 1
    assert got[103]["spans"].count(":") == 4  # the order number is not personal
    assert got[300]["spans"] == got[301]["spans"] == got[302]["spans"] == ""
    empty = pii.scanned(texts(spark, []))
    assert pii.spans_found(empty, pii.fit(empty)).collect() == []


def test_neighbouring_numbers(spark):
    lists = ["555-123-4567 555-765-4321", "(212) 555-0100 (212) 555-0101", "555-123-4567 - 555-765-4321 - 555-222-3333",
             "2023 555-123-4567", "555-1234 555-9876 555-4321", "4111 1111 1111 1111 5500 0000 0000 0004",
             "555.123.4567.555.765.4321", "01 23 45 67 89 01 98 76 54 32"]
    want = [lists[0].split(), ["(212) 555-0100", "(212) 555-0101"], lists[2].split(" - "), ["555-123-4567"], lists[4].split(),
            [lists[5][:19], lists[5][20:]], ["555.123.4567", "555.765.4321"], [lists[7][:14], lists[7][15:]]]
    for t, numbers in zip(lists, want):
        got = [(t[a:b], pii.KINDS[k]) for a, k, b in pii.candidates(t, pii.base_spans(t))]
        assert {(n, "card" if "1111" in t else "phone") for n in numbers} <= set(got), t
        assert len(got) == len(set(got)), t
    assert {k for _, k, _ in pii.candidates("12345678901234", [])} == {pii.CARD, pii.PHONE}
    rows = [(k, f"Please call the phone {200 + k}-555-{1000 + k} today or {k + 1}0 people come") for k in range(60)]
    rows += [(100 + k, f"order number {10000000 + k} version {k}.2 of the page") for k in range(60)]
    rows += [(200 + k, f"phone {t} end") for k, t in enumerate(lists[:4])]
    spans = pii.scanned(texts(spark, rows))
    got = {r["doc_id"]: r["spans"] for r in pii.spans_found(spans, pii.fit(spans)).collect()}
    for k, numbers in enumerate(want[:4]):
        t = dict(rows)[200 + k]
        assert got[200 + k] == ",".join(f"phone:{t.index(n)}:{t.index(n) + len(n)}" for n in numbers), t


def test_em_finds_reliable_labelers():
    import numpy as np
    r = np.random.default_rng(0)
    truth = r.random(4000) < 0.4
    accuracy = [0.95, 0.9, 0.85, 0.6, 0.8, 0.7]
    vote = np.stack([np.where(r.random(4000) < a, truth, ~truth) * 2 - 1 for a in accuracy], axis=1)
    p, table = pii.posteriors(np.zeros(4000, int), vote, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.95
    assert [round(float(table[1, 0, j, 2]), 1) for j in (0, 3)] in ([1.0, 0.6], [0.9, 0.6], [1.0, 0.5], [0.9, 0.5])


def test_escaping_is_reversible():
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice(["<", "|", "\\", "im_end", ">", "a", "\n", "n"]) for _ in range(r.randrange(12)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat.unescape_role(chat.escape_role(t)) == t and "\n" not in chat.escape_role(t)


def test_chat_round_trip(spark):
    import hashlib
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "<|im_end|> <\\|x"), (1, 1, "assistant", "a"), (1, None, None, None),
            (None, 0, "assistant", "é" * 3), (2, 0, "us\ner", "x" * 100000), (3, 0, "assistant", "<|im_start|>"), (3, 0, "assistant", "<|im_start|>")]
    table = spark.createDataFrame([(*x, "clash", 1) for x in rows], "conv_id long, turn long, role string, text string, ids string, seq int")
    turns = chat.formatted(table, JSON)
    got = {r["conv_id"]: r for r in chat.read_back(turns, JSON).collect()}
    for c in (1, 2, 3, None):
        own = sorted([x[1:] for x in rows if x[0] == c], key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in own)
        loss = "".join(t for _, r, t in own if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    c = chat.codec(JSON)
    for r in turns.collect():
        assert list(r["ids"]).count(c.start) == 1 and list(r["ids"]).count(c.end) == 1
    assert chat.read_back(chat.formatted(table.where("false"), JSON), JSON).collect() == []


def test_aliases_and_precedence(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(1, "https://spam.test/a", link.format("http://bad.test/x/1")),
            (2, "http://bad.test/x/1?utm_source=f#t", None),
            (3, "https://good.test/ok/1", link.format("http://bad.test/x/1")),
            (4, "http://Mirror.test/b/", "<META HTTP-EQUIV='refresh' content='0; url=https://spam.test/a'>"),
            (5, "https://lone.test/b", "<p>"), (6, None, None), (7, "no scheme", link.format("/x")),
            (8, "http://bad.test", ""), (9, "https://two.test/q", link.format("//two.test/x/y")), (10, "https://two.test/x/y", None),
            (10, "https://two.test/x/y", None)]
    pages = spark.createDataFrame([(*x, "clash", "clash") for x in rows], "page_id long, url string, html string, node string, own string")
    rules = [url_filter.Rule("block", "bad.test", "/x/"), url_filter.Rule("allow", "good.test", "/ok"), url_filter.Rule("block", "test", "/x/y")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judged(pages, rules).collect()}
    assert got == {
        1: ("spam.test", "/a", None, "allow"),  # an explicitly allowed alias takes precedence in its class
        2: ("bad.test", "/x/1", "bad.test/x/", "block"), 3: ("good.test", "/ok/1", "good.test/ok", "allow"),
        4: ("mirror.test", "/b/", None, "allow"), 5: ("lone.test", "/b", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("bad.test", "", None, "allow"), 9: ("two.test", "/q", None, "block"),
        10: ("two.test", "/x/y", "test/x/y", "block")}
    blocked = {r["page_id"]: r["verdict"] for r in url_filter.judged(pages.where("page_id <> 3"), rules).collect()}
    assert blocked[1] == blocked[4] == "block" and blocked[5] == "allow"
    assert url_filter.judged(pages.where("false"), rules).collect() == []
