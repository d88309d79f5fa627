"""Whitening against exact rational arithmetic and the definition of the covariance."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm import queries, whitening

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(vectors):
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, k = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(k)]
    off = [[n * r[i] - sums[i] for i in range(k)] for r in x]
    cov = [[Fraction(sum(o[i] * o[j] for o in off), n ** 3) for j in range(k)] for i in range(k)]
    return [sum(o * o for o in r) for r in off], np.array([[float(c) for c in r] for r in cov]), np.array([[float(Fraction(o, n)) for o in r] for r in off])


def table(spark, vectors, ids=None):
    return spark.createDataFrame(
        [(ids[i] if ids else i, [float(c) for c in v] if v is not None else None, 0) for i, v in enumerate(vectors)], VECTORS)


@pytest.mark.parametrize("scale", [1.0, 3e9])
def test_equals_the_definition(spark, scale):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) * scale).tolist()
    vectors += vectors[:20]
    deviation, cov, off = brute(vectors)
    got = whitening.whitened(table(spark, vectors)).collect()
    assert len(got) == len(vectors) * 5
    values = np.linalg.eigvalsh(cov)[::-1]
    white = np.zeros((len(vectors), 5))
    for r in got:
        assert r["n"] == len(vectors) and int(r["deviation"]) == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
        assert abs(r["identity_error"]) < 1e-9
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(white.T @ white / len(vectors) - np.eye(5)).max() < 1e-9
    # Every column is the centred rows on an eigenvector of length one.
    onto = np.linalg.lstsq(off, white, rcond=None)[0] * np.sqrt(values)
    assert np.abs(np.linalg.norm(onto, axis=0) - 1).max() < 1e-6
    assert np.abs(cov @ onto - onto * values).max() < 1e-6 * values[0]


def test_polarisation_is_exact():
    rng = np.random.default_rng(1)
    for wide in (10, 1 << 35, 1 << 61):
        d = rng.integers(-wide, wide, size=(37, 4))
        exact = [[int(v) for v in r] for r in d]
        want = [sum(r[i] ** 2 for r in exact) for i in range(4)]
        want += [sum((r[i] + r[j]) ** 2 for r in exact) for i in range(4) for j in range(i + 1, 4)]
        assert whitening.squares(d) == want
    for value in (0, 1, -1, 1 << 39, -(1 << 100), (1 << 150) + 12345):
        parts = whitening._limbs(value)
        assert whitening._whole({f"l{i}": p for i, p in enumerate(parts)}) == value


def test_many_components_of_the_given_table(spark, given):
    df = spark.read.parquet(f"{given}/embeddings.parquet")
    vectors = [r["embedding"] for r in df.orderBy("vec_id").collect()]
    deviation, cov, _ = brute(vectors)
    got = queries.QUERIES["op12_whitening"](spark, given).collect()
    assert len(got) == 8 * len(vectors)
    values = np.linalg.eigvalsh(cov)[::-1]
    for r in got:
        assert r["deviation"] == deviation[r["vec_id"]] and r["component"] in range(1, 9)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [0.5, 0.25]]
    odd = [None, [1.0, float("nan")], [float("inf"), 0.0], [1.0], [], [1.0, 2.0, 3.0]]
    df = table(spark, [*good, *odd], [None, 1, 1, 2, 3, 4, 5, 6, 7, 8])
    with_null = df.union(spark.sql("SELECT 9L, array(1.0D, null), 0"))
    got = whitening.whitened(with_null.withColumn("deviation", F.lit("x"))).collect()
    assert sorted(repr(r["vec_id"]) for r in got) == sorted(repr(i) for i in (None, 1, 1, 2) for _ in range(2))
    assert {r["n"] for r in got} == {4}


def test_without_rows_or_variance(spark, rows):
    empty = whitening.whitened(table(spark, []))
    assert rows(empty) == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert rows(whitening.whitened(table(spark, [None, []]))) == []
    one = whitening.whitened(table(spark, [[1.0, 2.0, 3.0]])).collect()
    assert [(int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, None, None)] * 3
    flat = whitening.whitened(table(spark, [[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]])).collect()
    assert {r["component"]: r["whitened"] is None for r in flat} == {1: False, 2: True}
    assert max(r["identity_error"] for r in flat) < 1e-9


def test_huge_entries(spark):
    got = whitening.whitened(table(spark, [[1e300], [-1e300], [0.0]])).collect()
    assert len(got) == 3 and all(abs(r["identity_error"]) < 1e-9 for r in got)
