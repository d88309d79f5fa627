"""Language and toxicity: brute force, held-out rows and defined cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import language, toxicity
from quotemill.llm.ngrams import hashed_codes


def grams(text):
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    out = Counter()
    for word in low.split():
        padded = f" {word} "
        out.update(c for c in word)
        for n in (2, 3):
            out.update(padded[i:i + n] for i in range(len(padded) - n + 1))
    return out


def top(counts, size=300):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:size]]


def brute(data):
    def out(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 4 == 2

    totals = {}
    for d, t, lang, _ in data:
        if lang is not None and t is not None and not out(d):
            totals.setdefault(lang, Counter()).update(grams(t))
    ranks = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in totals.items() if c}
    result = []
    for d, t, *_ in data:
        own = top(grams(t or ""))
        if not own or not ranks:
            result.append((d, out(d), "und", 0.0))
            continue
        off = {lang: sum(abs(i - r[g]) if g in r else 300 for i, g in enumerate(own)) for lang, r in ranks.items()}
        best = min(sorted(off), key=off.get)
        result.append((d, out(d), best, pytest.approx(1 - off[best] / (300 * len(own)))))
    return result


DATA = [
    (0, "The cat is on the mat, and that is all.", "en", "a"), (1, "Le chat est sur le tapis, et c'est tout.", "fr", "a"),
    (3, "Die Katze ist auf der Matte; das ist alles!", "de", "b"), (4, "the thing", None, None), (5, None, "en", None), (6, "", "fr", None),
    (7, "12 34 !!", "de", None), (8, "日本語", None, None), (9, "der die das", None, None), (10, "x " * 40_000 + "der", "de", None), (None, "la le les", None, None),
    (3, "Die Katze ist auf der Matte; das ist alles!", "de", "b")]


def key(r):
    return repr((r[0], r[2]))


def test_language_equals_brute_force(documents):
    docs = documents(DATA).withColumns({c: F.lit(1) for c in ("lang_pred", "score", "code", "rank")})
    got = [tuple(r) for r in language.identify(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(DATA), key=key)


def test_language_of_nothing_learned(documents, rows):
    data = [(d, t, None, s) for d, t, _, s in DATA[:4]]
    assert {r[2] for r in rows(language.identify(documents(data)))} == {"und"}
    kept = language.identified(documents([*data, (90, "12", None, None), (91, None, None, None), (92, "é", None, None)]))
    assert {r.doc_id for r in kept.collect()} == {0, 1, 3, 4, 92}
    assert rows(language.identify(documents([]))) == []


def test_language_filter_keeps_rows_whole(documents):
    docs = documents(DATA).withColumns({"lang_pred": F.lit(1), "score": F.lit("s")})
    got = language.identified(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {0, 1, 3, 4, 9, 10, None}


def test_language_held_out_accuracy(spark, given):
    docs = spark.read.parquet(f"{given}/documents.parquet")
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_toxicity_learns_and_leaves_clean_documents_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs.join(labels, "doc_id", "left_semi"), toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out")
    got = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    toxic, clean = got.get((1, 1), 0) + got.get((1, 0), 0), got.get((0, 0), 0) + got.get((0, 1), 0)
    assert got[(1, 1)] >= 0.9 * toxic and got.get((0, 1), 0) <= 0.02 * clean


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_of_odd_rows(spark, documents):
    data = [(i, ("you idiot moron " if i % 3 == 0 else "a kind sunny word ") * (1 + i % 4), None, None) for i in range(120)]
    data += [(500, None, None, None), (501, "", None, None), (None, "idiot", None, None), (502, "z " * 90_000, None, None), (0, "you idiot", None, None)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(120)] + [(0, 1, 1), (None, 1, 1), (5, None, None), (999, 1, 1)]
    docs = documents(data).withColumns({"score": F.lit(1), "toxic": F.lit(0), "buckets": F.lit(2)})
    got = toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got if r.doc_id is not None and 0 < r.doc_id < 120)


def test_toxicity_without_both_labels(spark, documents, rows):
    docs = documents([(1, "a b", None, None), (2, None, None, None)])
    empty = spark.createDataFrame([], LABELS)
    assert {r[2] for r in rows(toxicity.score(docs, toxicity.fit(docs, empty)))} == {0.0}
    assert rows(toxicity.score(documents([]), toxicity.fit(documents([]), empty))) == []


def test_held_out_rows_are_not_learned(spark, documents):
    data = [(i, "calm text" if i % 2 else "rude text", None, None) for i in range(40)]
    labels = [(i, 0, 1 - i % 2) for i in range(40)]
    changed = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    first, second = (toxicity.fit(documents(data), spark.createDataFrame(x, LABELS)) for x in (labels, changed))
    assert first["intercept"] == pytest.approx(second["intercept"]) and list(first["buckets"]) == list(second["buckets"])


def brute_toxicity(data, labels):
    """Scores of all texts: ratios by plain counting, the regression by Newton's method to convergence."""
    label = {}
    for i, _, t in labels:
        if t is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            label[i] = max(t, label.get(i, 0))
    texts = {}
    for i, t, *_ in data:
        if i in label:
            texts[i] = min(x for x in (texts.get(i), t) if x is not None) if t is not None or texts.get(i) is not None else None
    own = {i: set(hashed_codes(t, toxicity.SIZES, toxicity.BITS).tolist()) for i, t in texts.items()}
    n, n_toxic = len(own), sum(label[i] for i in own)
    counts = [Counter(b for i in own if label[i] == k for b in own[i]) for k in (0, 1)]
    every = sorted(set(counts[0]) | set(counts[1]))
    totals = [sum(c.values()) + len(every) for c in counts]
    share, ratio = n_toxic / n, {}
    for b in every:
        other, toxic = counts[0][b], counts[1][b]
        seen = other + toxic
        if (toxic - seen * share) ** 2 / (seen * share * (1 - share) + 1) >= toxicity.LEAST:
            ratio[b] = math.log(((toxic + 1) / totals[1]) / ((other + 1) / totals[0]))
    place = {b: j for j, b in enumerate(ratio)}

    def row(buckets):
        x = np.zeros(len(place) + 1)
        x[-1] = 1
        for b in buckets & place.keys():
            x[place[b]] = ratio[b]
        return x

    x = np.array([row(own[i]) for i in own])
    y = np.array([label[i] for i in own], float)
    penalty = np.append(np.full(len(place), toxicity.PENALTY), 0.0)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / n + penalty * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / n + np.diag(penalty + 1e-12), slope)
    return [1 / (1 + math.exp(-row(set(hashed_codes(t, toxicity.SIZES, toxicity.BITS).tolist())) @ w)) for _, t, *_ in data]


def test_toxicity_equals_brute_force(spark, documents):
    rng = random.Random(6)
    words = ["sun", "tree", "kind", "walk", "idiot", "moron", "road", "lamp"]
    data = []
    for i in range(200):
        toxic = rng.random() < 0.4
        text = [rng.choice(words[:4] + words[6:]) for _ in range(rng.randint(1, 8))] + ([rng.choice(words[4:6])] if toxic != (rng.random() < 0.1) else [])
        data.append((i, " ".join(text), None, str(int(toxic))))
    data += [(7, "another text", None, "0"), (7, None, None, "0"), (500, None, None, "0")]
    labels = [(i, 1, int(s)) for i, _, _, s in data]
    got = toxicity.score(documents(data), toxicity.fit(documents(data), spark.createDataFrame(labels, LABELS)))
    found = Counter((r.doc_id, round(r.score, 2)) for r in got.collect())
    want = [(d[0], s) for d, s in zip(data, brute_toxicity(data, labels))]
    for i, s in want:
        near = [k for k in found if k[0] == i and abs(k[1] - s) <= 0.03 and found[k]]
        assert near, (i, s, [k for k in found if k[0] == i])
        found[near[0]] -= 1


def test_rare_toxic_words_are_caught(spark):
    """Four hundred toxic words, one a document."""
    rng = random.Random(1)

    def made(n, low, high):
        return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high))) for _ in range(n)]

    common, bad, docs, labels = made(3000, 4, 9), made(400, 6, 8), [], []
    for i in range(16_000):
        text, toxic = [rng.choice(common) for _ in range(rng.randint(30, 80))], int(rng.random() < 0.3)
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(8)
    labels = spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(docs, labels)
    assert len(model["buckets"]) > 2048
    scored = toxicity.score(docs, model).join(labels, "doc_id").where("held_out")
    got = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert got[(1, 1)] >= 0.85 * (got[(1, 1)] + got.get((1, 0), 0)) and got.get((0, 1), 0) <= 0.1 * (got[(0, 0)] + got.get((0, 1), 0))
