"""Components against brute force over full shingle sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import near_dedup, superminhash
from quotemill.llm.components import components


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(data, percent=85):
    sets = [(d, shingle_set(t)) for d, t in data]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is None or b is None or not s or not t:
                continue
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((d, len(s), find(d) if d is not None else None, d is None or find(d) == d) for d, s in sets), key=repr)


def corpus(seed=1, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    data, at = [], 0
    passage = " ".join(rng.choices(vocabulary, k=80))
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 30, 120, 400]))
        for copy in range(rng.choice([1, 2, 9])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            data.append((at, rng.choice([" ", "\n"]).join(text).upper() if copy % 3 == 1 else " ".join(text)))
            at += 1
    # A chain: each text shares most with the next only.
    chain = rng.choices(vocabulary, k=300)
    for step in range(8):
        data.append((at, " ".join(chain[step * 12:step * 12 + 200])))
        at += 1
    for _ in range(25):  # many texts with one passage in common
        data.append((at, passage + " " + " ".join(rng.choices(vocabulary, k=40))))
        at += 1
    rng.shuffle(data)
    return data


def run(documents, data):
    return near_dedup.near_duplicates(documents([(d, t, None, None) for d, t in data]))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents, rows, seed):
    data = corpus(seed)
    assert rows(run(documents, data)) == brute(data)


def test_large_buckets_in_small_blocks(documents, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    data = []
    for i in range(60):  # variants around the threshold: some linked by way of others only
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(120)] = f"x{rng.randrange(9)}"
        data.append((i, " ".join(text)))
    assert rows(run(documents, data)) == brute(data)


def test_an_id_of_two_texts_in_open_buckets(documents, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(9)
    data = [(0, " ".join(f"{name}{i}" for i in range(120))) for name in "uv"]  # the smallest id of both sets
    for i in range(1, 61):
        text = [f"{'uv'[i % 2]}{j}" for j in range(120)]
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(120)] = f"x{rng.randrange(9)}"
        data.append((i, " ".join(text)))
    assert rows(run(documents, data)) == brute(data)


def test_odd_rows(documents, rows):
    data = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (None, "a b"), (None, None), (7, "one"), (7, "one"), (9, "a b")]
    got = rows(run(documents, data))
    assert got == brute(data)
    assert rows(run(documents, [])) == []


def test_rows_that_repeat_an_id_are_one_document(documents, rows):
    data = [(5, "a b c"), (5, "d e f"), (3, "d e f"), (8, "a b c")]
    assert {r[2] for r in rows(run(documents, data))} == {3}


def test_deduplicated_keeps_one_of_each(documents, rows):
    data = [(3, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (2, None), (None, "a b c d e f"), (4, "other words")]
    docs = documents([(d, t, "en", None) for d, t in data]).withColumns({"class": F.lit(1), "root": F.lit(2), "kept": F.lit(3)})
    got = near_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == [1, 2, 4]
    assert got.where("doc_id is null").count() == 1


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for size, share in ((40, 0.9), (300, 0.85), (4000, 0.5)):
        both = rng.integers(0, 1 << 62, size, np.uint64)
        cut = int(size * share)
        a = np.unique(both[:cut])
        b = np.unique(both[size - cut:])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = superminhash.signatures([a, b], 2000)
        assert abs((s[0] == s[1]).mean() - true) < 5 * np.sqrt(true * (1 - true) / 2000) + 0.002
    one = superminhash.signatures([a[:1]])
    assert sorted(int(v) >> 32 for v in one[0]) == list(range(superminhash.POSITIONS))


def test_long_sets_in_parts(monkeypatch):
    own = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000, np.uint64))
    whole = superminhash.signatures([own])
    monkeypatch.setattr(superminhash, "CHUNK", 700)
    assert (superminhash.signatures([own]) == whole).all()


def test_components_of_chains_and_stars(spark, rows):
    links = [(i + 1, i) for i in range(200, 260)] + [(300, i) for i in range(301, 360)] + [(i, i) for i in range(5)]
    got = rows(components(spark.createDataFrame(links, "a long, b long").repartition(7)))
    assert got == sorted([(i, 200) for i in range(201, 261)] + [(i, 300) for i in range(301, 360)], key=repr)
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
