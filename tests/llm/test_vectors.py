"""Both searches against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import cross_polytope, exact_topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in data], SCHEMA)


def integers(v):
    return [math.floor(Fraction(float(np.float32(x))) * 256) for x in v]


def brute_products(data, k, every):
    clean = [(i, integers(v)) for i, v in {(i, tuple(v)) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}]
    out = []
    for q, a in clean:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(a) == len(b))
        scored = [(s, i) for s, i in scored if -(1 << 63) <= -s < 1 << 63]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_products_equal_brute_force(spark, rows, spread):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 12))
    data = [(i, base[i % 40] + 0.05 * rng.normal(size=12)) for i in range(700)]
    data = [(i, v * np.exp(spread * rng.normal())) for i, v in data]
    data += [(1000 + i, base[0]) for i in range(120)]  # ties of equal vectors
    got = rows(exact_topk.exact_top_k(table(spark, data), F.col("vec_id") % 50 == 0, 5))
    assert got == brute_products(data, 5, 50)


def test_products_of_odd_rows(spark, rows):
    data = [
        (0, [0.0, 0.0]), (1, [1.0, -2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 0.0]),
        (None, [1.0, 1.0]), (50, [-1.0, -1.0]), (50, [-1.0, -1.0]), (6, [1.0, 2.0, 3.0]), (100, []), (7, []), (8, [1e30, 1.0]), (9, [3.0, 3.0])]
    got = rows(exact_topk.exact_top_k(table(spark, data), F.col("vec_id") % 50 == 0, 5))
    assert got == brute_products(data, 5, 50)


def test_products_of_rows_of_any_length(spark, rows):
    """Scores that fit a long count, however long the vectors; the others are no result."""
    rng = np.random.default_rng(8)
    data = [(50, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [4e6, 0.0]), (100, [1e30, 1.0]), (3, [0.0, 3.0]), (4, [3e38, -3e38]), (150, [3e38, 3e38]), (5, [1e-30, 5.0]), (6, [-4e6, 7.0])]
    assert (50, 1, 2, 256 * 256 * 4_000_000) in rows(exact_topk.exact_top_k(table(spark, data), F.col("vec_id") % 50 == 0, 5))
    assert rows(exact_topk.exact_top_k(table(spark, data), F.col("vec_id") % 50 == 0, 5)) == brute_products(data, 5, 50)
    many = [(i, rng.normal(size=3) * 10.0 ** rng.integers(-2, 9)) for i in range(300)] + [(350, [1e20, 0.0, 0.0]), (307, [0.0, 1e20, 1.0])]
    assert rows(exact_topk.exact_top_k(table(spark, many), F.col("vec_id") % 50 == 0, 5)) == brute_products(many, 5, 50)


def test_nearest_of_vectors_of_any_length(spark, rows):
    schema = "vec_id long, embedding array<double>, label int"
    data = [(0, [1e-200, 0.0]), (1, [2e-200, 0.0]), (2, [1e200, 0.0]), (3, [0.0, 1e200]), (100, [1.0, 0.0]), (4, [1.0, 1e-3])]
    got = rows(cross_polytope.nearest(spark.createDataFrame([(i, v, 0) for i, v in data], schema), F.col("vec_id") % 100 == 0, 10))
    for q in (0, 100):
        mine = [r for r in got if r[0] == q]
        asked = dict(data)[q]
        want = sorted((math.hypot(*(a - b for a, b in zip(v, asked))), i) for i, v in data if i != q)
        assert [r[2] for r in sorted(mine, key=lambda r: r[1])] == [i for _, i in want]
        assert all(r[3] == pytest.approx(dict((i, d) for d, i in want)[r[2]], rel=1e-12) for r in mine)


def test_small_blocks_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 16)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=6)) for i in range(300)]
    assert rows(exact_topk.exact_top_k(table(spark, data), F.col("vec_id") % 50 == 0, 5)) == brute_products(data, 5, 50)


def test_empty_tables(spark, rows):
    assert rows(exact_topk.exact_top_k(table(spark, []), F.col("vec_id") % 50 == 0, 5)) == []
    assert rows(cross_polytope.nearest(table(spark, []), F.col("vec_id") % 100 == 0, 10)) == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    y = cross_polytope.fast_hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(cross_polytope.fast_hadamard(y), x)


def test_recall_and_scores(spark, given):
    df = spark.read.parquet(f"{given}/embeddings.parquet")
    data = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    ids = np.array(sorted(data))
    x = np.array([data[i] for i in ids])
    found = {}
    for r in cross_polytope.nearest(df, F.col("vec_id") % 10 == 0, 10).collect():
        found.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q in ids[ids % 10 == 0]:
        d = np.sqrt(((x - data[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        got = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11)) and [r.score for r in got] == sorted(r.score for r in got)
        assert all(r.score == pytest.approx(np.sqrt(((data[r.vec_id] - data[q]) ** 2).sum()), rel=1e-12) for r in got)
        hits += len({r.vec_id for r in got} & set(ids[order]))
        total += 10
    assert hits / total >= 0.9


def test_nearest_of_odd_rows(spark, rows):
    data = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (100, [-1.0, 0.0]),
        (100, [-1.0, 0.0]), (6, [1.0, 2.0, 3.0]), (7, []), (None, [1.0, 0.0]), (8, [1.0, 0.0])]
    got = rows(cross_polytope.nearest(table(spark, data), F.col("vec_id") % 100 == 0, 10))
    assert got == sorted([(0, 1, 1, 0.0), (0, 2, 8, 0.0), (0, 3, 100, 2.0), (100, 1, 0, 2.0), (100, 2, 1, 2.0), (100, 3, 8, 2.0)], key=repr)


def test_extra_columns(spark):
    df = table(spark, [(i, [1.0, i + 1.0]) for i in range(60)]).withColumns({c: F.lit(1) for c in ("vector", "x", "rank", "block", "query_id", "dim")})
    assert exact_topk.exact_top_k(df, F.col("vec_id") % 50 == 0, 5).count() == 10
    assert cross_polytope.nearest(df, F.col("vec_id") % 100 == 0, 10).count() == 10
