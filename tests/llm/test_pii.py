from __future__ import annotations

import hashlib
import random
import re
import time

from orderloom.llm import pii
from orderloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text: str | None) -> dict[str, list[str]]:
    return {
        kind: [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(form, text or "") if passes(kind, m[0])]
        for kind, form in FORMS.items()
    }


def check(rows: dict, found) -> None:
    for r in found:
        want = brute(rows[r.doc_id])
        every = ",".join(s for k in FORMS for s in want[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in FORMS), r
        assert r.base_sha256 == hashlib.sha256(every.encode()).hexdigest(), r
        assert set(filter(None, every.split(","))) <= set(r.spans.split(",")), r


def query(spark, texts: dict, tmp_path):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs.selectExpr("doc_id", "text", "'x' as row", "1 as card").write.parquet(f"{tmp_path}/documents.parquet")
    return QUERIES["op10_pii"](spark, str(tmp_path)).collect()


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = QUERIES["op10_pii"](spark, SF).collect()
    assert len(found) == len(docs)
    check({d.doc_id: d.text for d in docs}, found)


def test_odd_and_random_texts(spark, tmp_path):
    texts = {
        1: None, 2: "", 3: "é😀 a@b.c_x@d.e a@b..c @x.y a@b.", 4: "1.2.3.4.5.6.7.8 1.2.3.256 001.02.3.4 99999.1.1.1",
        5: "4111 1111 1111 1111, 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112 5 4111111111111111",
        6: "+1 (555) 123-4567 +12 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49 30 1234567.",
        7: "x" * 8_000 + "@", 8: "1" * 8_000, 9: "a@" + "b." * 50_000 + "c", 10: "+1" + " " * 100_000 + "2",
        11: "1-" * 60_000, 12: "a.b@c.d " * 2_000,
    }
    rng = random.Random(7)
    for i in range(100, 400):
        texts[i] = "".join(rng.choice("0123456789+@.- ()ab_%é\n") for _ in range(rng.randrange(200)))
    check(texts, query(spark, texts, tmp_path))


def test_long_texts_take_linear_time(spark, tmp_path):
    """The plain patterns would take squared time on these; none holds an entity."""
    n = 100_000
    texts = {1: "x" * n + "@", 2: "1" * n, 3: "1-" * n, 4: "a@" * n, 5: "+1" + " " * n, 6: "." * n + "1.1" * n, 7: "é" * n}
    began = time.time()
    found = query(spark, texts, tmp_path)
    assert time.time() - began < 60
    assert all(r.spans == "" for r in found if r.doc_id != 6)


def test_discovers_unseen_numbers_in_trusted_contexts(spark, tmp_path):
    texts = {i: f"please call our office at +1 555 200 {1000 + i} for help" for i in range(12)}
    texts |= {50: "please call our office at 555 200 7777 for help", 51: "version 2.0 costs 555-200-1234 units",
              52: "please call our office at noon for help"}
    texts[53] = "please call our office at 555-200-8888 for help"
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found[53] == "phone:26:38"
    assert found[51] == found[52] == ""


def test_discovers_numbers_written_with_blanks(spark, tmp_path):
    texts = {i: f"please call our office at +1 555 200 {1000 + i} for help" for i in range(12)}
    texts |= {50: "please call our office at 555 200 7777 for help", 51: "call our office at (555) 123-4567 for help",
              52: "call our office at 555 200 77x for help", 53: "call our office at 555  200 7778 for help",
              54: "call our office at 555.200 7777 for 555 200 7777 help", 55: "call our office at 5 4th for help"}
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found[50] == "phone:26:38" and found[51] == "phone:19:33"
    assert found[52] == found[53] == found[55] == ""
    assert found[54] == "phone:19:31,phone:36:48"


def test_span_inside_another_is_left_out(spark, tmp_path):
    texts = {i: f"please call our office at +1 555 200 {1000 + i} for help" for i in range(12)}
    texts |= {50: "call our office at 5552007777 for help", 51: "call our office at 5552007777 1 for help"}
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found[50] == "phone:19:29" and found[51] == "phone:19:31"


def test_seeds_and_candidates_have_the_same_contexts(spark, tmp_path):
    texts = {i: f"Order 12 phone: +1 555 200 {1000 + i}. Thanks" for i in range(12)}
    texts |= {50: "Order 12 phone: 555-200-8888. Thanks"}
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found[50] == "phone:16:28"


def test_contexts_against_the_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("012+@.- ()ab,%é😀\n") for _ in range(rng.randrange(1500))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = 0
    for r in pii.seeds(docs).collect():
        t = texts[r.doc_id]
        for s in [s for k in (*pii.KINDS, "others") for s in r[k]]:
            stop = s.at + len(s.core)
            assert t[s.at : stop] == s.core and s.start <= s.at and stop <= s.end
            assert (s.left, s.right) == (t[max(s.at - pii.CONTEXT, 0) : s.at], t[stop : stop + pii.CONTEXT])
            n += 1
    assert n > 500


def test_open_occurrences_of_seeds_are_added(spark, tmp_path):
    texts = {1: "5 4111111111111111", 2: "my card is 4111111111111111"}
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found == {1: "card:2:18", 2: "card:11:27"}


def test_rounds_go_on_until_nothing_new(spark, tmp_path):
    texts = {}
    for k in range(5):
        # The numbers of a step are the known ones of the next step's context.
        for i in range(4):
            number = f"555-20{k}-100{i}"
            texts[len(texts)] = f"word{k} said {'+1 ' if k == 0 else ''}{number} then{k}"
            if k == 0:
                texts[len(texts)] = f"word1 said +1 {number} then1"
            else:
                texts[len(texts)] = f"word{k + 1} said {number} then{k + 1}"
    texts[100] = "word5 said 555-300-1000 then5"
    found = {r.doc_id: r.spans for r in query(spark, texts, tmp_path)}
    assert found[100] == "phone:11:23" and all(found.values())


def test_runs_of_numbers_take_linear_time(spark, tmp_path):
    n = 50_000
    texts = {1: "1 " * n + "x", 2: "1 1x " * n, 3: "(1)" * n, 4: "(1 " * n, 5: "1 " * n + "1@", 6: "555 200 7777, " * n}
    began = time.time()
    found = query(spark, texts, tmp_path)
    assert time.time() - began < 60 and all(r.spans == "" for r in found)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(docs).count() == 0


def test_equal_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c")], "doc_id long, text string")
    found = pii.find_pii(docs).select("doc_id", pii.counted("base", "email").alias("n")).collect()
    assert sorted((tuple(r) for r in found), key=repr) == [(1, 1), (1, 1), (None, 1)]


def test_rows_with_many_seeds_give_the_same_words(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("0123456789+@.- ()ab%") for _ in range(400)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.seeds(docs).cache()

    def words():
        return sorted((r.row, r.s.start, r.s.end) for r in pii._free_words(found).collect())

    plain = words()
    monkeypatch.setattr(pii, "PAIRS", 0)
    assert words() == plain and plain
    found.unpersist()


def planted(rng):
    """Texts with identifiers of which a form finds some, and what the unseen ones are."""
    openings = ["please", "you can", "to order", "for help", "any time", "our staff", "customers", "do not"]
    asks = {
        "phone": ["call {} at", "phone {} on", "ring {} under", "telephone of {}:", "reach {} via mobile"],
        "email": ["write to {} at", "mail {} under", "contact {} by e-mail:", "send {} a note to"],
        "ip": ["host {} answers at", "server {} listens on", "log in to {} from"],
        "card": ["{} paid with card", "charged the card of {}:"],
    }
    ends = ["today", "soon", "thanks", "or later", "again", "if needed"]
    names = ["anna", "mr. brown", "the office", "our shop", "dr. lee", "us", "sales", "the desk"]

    def luhn(digits):
        for last in "0123456789":
            if passes("card", digits + last):
                return digits + last

    def number(kind):
        n = "".join(rng.choice("0123456789") for _ in range(15))
        if kind == "phone":
            return f"+1 555 {n[:3]} {n[3:7]}", rng.choice([f"555-{n[7:10]}-{n[10:14]}", f"(555) {n[7:10]}-{n[10:14]}", f"555 {n[7:10]} {n[10:14]}"])
        if kind == "email":
            return f"u{n[:6]}@mail{n[6]}.example.com", f"u{n[7:12]}{rng.choice(['(at)', '[at]'])}mail.example.com"
        if kind == "ip":
            parts = [str(rng.randrange(1, 255)) for _ in range(4)]
            return ".".join(parts), "-".join(str(rng.randrange(1, 255)) for _ in range(4))
        other = luhn("4" + n[::-1][:14])
        return luhn("4" + n[:14]), ".".join(other[k : k + 4] for k in range(0, 16, 4))

    texts, unseen = {}, {}
    for kind, wordings in asks.items():
        for i in range(240):
            ask = rng.choice(wordings).format(rng.choice(names))
            seed, other = number(kind)
            hidden = i % 4 == 0
            value = other if hidden else seed
            head = f"{rng.choice(openings)} {ask} "
            texts[len(texts)] = f"{head}{value} {rng.choice(ends)}."
            if hidden:
                unseen[len(texts) - 1] = f"{kind}:{len(head)}:{len(head) + len(value)}"
    for i in range(300):
        n = "".join(rng.choice("0123456789") for _ in range(10))
        clean = rng.choice(["version {} is out", "part no. {} fits", "see page {} of it", "costs {} in all", "order {} was sent"])
        texts[len(texts)] = f"{rng.choice(openings)} {clean.format(f'{n[:3]}-{n[3:6]}-{n[6:]}')}"
    return texts, unseen


def test_recall_and_precision_on_planted_identifiers(spark, tmp_path):
    texts, unseen = planted(random.Random(11))
    found = {r.doc_id: set(filter(None, r.spans.split(","))) for r in query(spark, texts, tmp_path)}
    base = {i: {s for spans in brute(t).values() for s in spans} for i, t in texts.items()}
    added = {i: found[i] - base[i] for i in texts}
    caught = sum(s in added[i] for i, s in unseen.items())
    wrong = sum(len(a - {unseen.get(i)}) for i, a in added.items())
    assert caught / len(unseen) >= 0.9, caught / len(unseen)
    assert caught / (caught + wrong) >= 0.95, wrong
