"""Base spans against plain regular expressions, telling terms against counts over all pairs."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quotemill.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m.group())]


def with_luhn(body):
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


CARD = with_luhn("411111111111111")


def test_equals_plain_patterns():
    rng = random.Random(7)
    parts = [
        "a", "bob", "@", ".", "-", "_", "+", "%", "x.org", "mail", " ", "  ", "\n", "1", "22", "255", "256", "0001", "4111", CARD, CARD[:8],
        "10.0.0.1", "+44 20", "(0)", ")", "é", "٣", "..", "@@", "--", "5500-0000", "+1", "000255"]
    for _ in range(12_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
        assert pii.base_spans(text) == plain(text), repr(text)
    digits = "0123456789 -"
    for _ in range(4000):
        text = "".join(rng.choice(digits) for _ in range(rng.randint(10, 60)))
        assert pii.base_spans(text) == plain(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 300_000, "@" * 300_000, "a@" * 150_000, "1 " * 200_000])
def test_time_is_linear(text):
    pii.base_spans(text)


def brute(texts, threshold, support):
    """The added spans of every text, from all pairs of terms and entities."""
    n = len(texts)
    entities, terms = [], []
    for t in texts:
        spans = plain(t)
        entities.append({pii.entity(k, t[a:b]) for k, a, b in spans})
        rest = list(t or "")
        for _, a, b in spans:
            rest[a:b] = " " * (b - a)
        found = [(m.group().lower(), *m.span()) for m in re.finditer(r"\w{3,}", "".join(rest))]
        terms.append(found)
    with_shapes = [{t for t, _, _ in f} | {pii.shape(t) for t, _, _ in f} for f in terms]

    def tells(term, e):
        has_e = sum(e in x for x in entities)
        has_t = sum(term in x for x in with_shapes)
        both = sum(term in x and e in y for x, y in zip(with_shapes, entities))
        if has_e < support or both < support or has_e == n:
            return False
        return math.log2(both * n / (has_t * has_e)) >= threshold * -math.log2(has_e / n) - 1e-9

    out = []
    for f, of_doc, es in zip(terms, with_shapes, entities):
        told = {t for t in of_doc if any(tells(t, e) for e in es)}
        out.append(sorted((a, b, "removed" if pii.shape(t) in told else "general") for t, a, b in f if t in told))
    return out


def corpus():
    rng = random.Random(11)
    words = ["river", "stone", "Cloud", "window", "number", "7788", "x12", "über", "at", "paper", "street", "green"]
    people = [(f"p{i}@mail.example.com", f"Name{i}", f"{i}{i}{i}{i}") for i in range(6)]
    texts = []
    for i in range(160):
        text = [rng.choice(words) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            mail, name, badge = people[i % 5]
            text += [name, badge, name.upper(), mail if i % 4 else mail.upper()]
        if i % 10 == 1:
            text += ["common", "10.20.30.40", "host17_b"]
        if i % 41 == 0:
            text += ["+44 20 7946 0958", CARD]
        rng.shuffle(text)
        texts.append(" ".join(text))
    return [*texts, *["once 10.20.30.40 ßeta host17_b"] * 4, None, "", "Name1 without"]


@pytest.mark.parametrize("threshold, support", [(0.95, 3), (0.5, 2), (0.8, 1)])
def test_telling_terms_equal_brute_force(documents, threshold, support):
    texts = corpus()
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    got = {
        r["doc"]["doc_id"]: [(a["start"], a["end"], a["kind"]) for a in r["added"]]
        for r in pii.personal_data(docs, threshold=threshold, support=support).collect()}
    want = brute(texts, threshold, support)
    assert got == dict(enumerate(want))
    assert any(want) and (support > 1 or any(k == "removed" for w in want for _, _, k in w))


def test_rows_and_edges(documents, rows):
    text = f"é bob@x.org 10.0.0.1, {CARD}, +44 20 7946 0958"
    long = "word " * 60_000 + text
    data = [(1, text, None, None), (2, None, None, None), (3, "", None, None), (None, text, None, None), (1, text, None, None), (4, long, None, None)]
    docs = documents(data).withColumn("base", F.lit(1)).withColumn("row", F.lit("x"))
    found = pii.personal_data(docs, support=99)
    got = {repr(r[0]): r for r in rows(found.select(
        "doc.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.listed_spans(found).alias("spans")))}
    want = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
    assert got["1"] == (1, 1, 1, 1, 1, hashlib.sha256(want.encode()).hexdigest(), want) and len(plain(text)) == 4
    assert got["2"][1:] == got["3"][1:] == (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert got["4"][6] == ",".join(f"{k}:{a + 300_000}:{b + 300_000}" for k, a, b in plain(text))
    assert found.count() == 6 and rows(pii.personal_data(documents([]))) == []


def test_an_entity_of_all_documents_is_revealed_by_none(documents):
    docs = documents([(i, "call +44 20 7946 0958 now", None, None) for i in range(5)])
    assert all(not r["added"] for r in pii.personal_data(docs, support=1).collect())


def test_sanitized(documents, rows):
    texts = ["Anna works at anna@x.org 7781", "anna: ANNA@x.org 7781", "Anna anna@x.org 7781", *["plain words here 4455"] * 9, None]
    docs = documents([(i, t, "en", "s") for i, t in enumerate(texts)]).withColumn("text_", F.lit(5))
    got = pii.sanitized(docs)
    assert got.columns == docs.columns
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert kept[0] == ("[word] works at [email] [number]", 32) and kept[1] == ("[word]: [email] [number]", 24)
    assert kept[3] == ("plain words here 4455", 21) and kept[12] == (None, None)
    assert pii.cleaned("ab cd", [("removed", 0, 2), ("phone", 1, 4)]) == "d"


def test_filter_holds_all_its_terms(spark):
    terms = ["river", "Straße", "日本語", "x" * 300, *[f"t{i}" for i in range(3000)]]
    bits = pii.term_filter(spark.createDataFrame([(t,) for t in terms], "term string"))
    assert pii.passed(terms, bits).all()
    assert pii.passed([f"other{i}" for i in range(5000)], bits).mean() < 0.01
    assert not pii.passed(["a", "b"], pii.term_filter(spark.createDataFrame([], "term string"))).any()
