"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by three rounds of random signs and a fast Hadamard transform and is
assigned to the nearest signed axis, one of twice the dimension. Each of TABLES rotations is a
table of such buckets. A query probes, in each table, the PROBES signed axes nearest to it;
all members of these buckets are ranked by their exact distance. Every row is in every table:
no bucket is capped, large ones are dealt into blocks (``vectors.search_blocks``).

With 16 tables and 8 probes recall at 10 against brute force was 0.98 to 1.00 on the given
vectors (500 to 51,282 rows, 64 dimensions, the tenth neighbour hardly nearer than the
fiftieth). Vectors of very different length need more probes: hashing sees directions only.

Defined cases. Null, zero or empty vectors, vectors with null or non-finite components, and rows with a null id take no part.
Vectors of any other length do: they are scaled before they are squared. Rows that repeat id and vector count once.
Different dimensions do not meet. Where one id has several vectors each is a candidate; as a
query the smallest asks. Queries with fewer than k candidates in reach are completed by a
search of all rows, so that they get k results or all there are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import kept
from .vectors import finite, matrix, results, search_blocks

TABLES = 16
PROBES = 8
SLICE = 64
PLAIN = (1e-140, 1e140)


def fast_hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix, in n log n steps; the width is a power of 2."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotated(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """One pseudo-rotation of unit rows, padded with zeros to a power of 2."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([seed, table, width]).choice([-1.0, 1.0], (3, width))
    for s in signs:
        x = fast_hadamard(x * s)
    return x


def signed_axes(x: np.ndarray, probes: int) -> np.ndarray:
    """The nearest signed axes of each row, nearest first; axis a is 2a, its opposite 2a + 1."""
    both = np.empty((len(x), 2 * x.shape[1]))
    both[:, 0::2], both[:, 1::2] = x, -x
    if probes == 1:
        return both.argmax(1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _hashed(rows: DataFrame, tables: int, probes: int, seed: int, id_name: str) -> DataFrame:
    """dim, table_no, axis, id, vector: a row for each table and probe."""

    def place(batches):
        for batch in batches:
            for dim, part in batch.groupby(batch["vector"].map(len)):
                for begin in range(0, len(part), 512):
                    rows_ = part.iloc[begin:begin + 512]
                    x = matrix(rows_["vector"], np.float64)
                    x = x / np.abs(x).max(1, keepdims=True)  # whatever their length
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    for table in range(tables):
                        axes = signed_axes(rotated(unit, table, seed), probes)
                        for p in range(axes.shape[1]):
                            yield pd.DataFrame({
                                "dim": dim, "table_no": table, "axis": axes[:, p],
                                id_name: rows_[id_name].to_numpy(), "vector": rows_["vector"].to_numpy()})

    return rows.select(id_name, "vector").mapInPandas(
        place, f"dim int, table_no int, axis int, {id_name} long, vector array<double>")


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, also where squares are beyond or below what a double holds."""
    off = rows - query
    found = np.sqrt((off ** 2).sum(1))
    odd = np.flatnonzero(~((found > PLAIN[0]) & (found < PLAIN[1])))
    for at in odd.tolist():
        largest = np.abs(off[at]).max()
        if largest and np.isfinite(largest):
            found[at] = largest * np.sqrt(((off[at] / largest) ** 2).sum())
    return found


def _scorer(k: int):
    def score(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if members.empty or queries.empty:
            return results([], np.float64)
        members = members.sort_values("vec_id", kind="stable")
        ids = members["vec_id"].to_numpy()
        rows = matrix(members["vector"], np.float64)
        asked = matrix(queries["vector"], np.float64)
        own = queries["query_id"].to_numpy()
        # Rough distances by products only where squares are within what a double holds.
        plain = bool((np.abs(rows).max(1) > PLAIN[0]).all() and max(np.abs(rows).max(), np.abs(asked).max()) < PLAIN[1])
        square = (rows ** 2).sum(1)
        parts = []
        for begin in range(0, len(asked), SLICE):
            part = asked[begin:begin + SLICE]
            size = (part ** 2).sum(1)
            rough = size[:, None] + square[None] - 2 * (part @ rows.T)
            slack = 1e-12 * (size[:, None] + square.max()) * (4 + rows.shape[1])
            for at in range(len(part)):
                open_ = np.flatnonzero(ids != own[begin + at])
                if len(open_) > k and plain:
                    near = rough[at, open_]
                    open_ = open_[near <= np.partition(near, k - 1)[k - 1] + 2 * slack[at, 0]]
                exact = distances(rows[open_], part[at])
                order = np.argsort(exact, kind="stable")[:k]
                parts.append((own[begin + at], ids[open_[order]], exact[order]))
        return results(parts, np.float64)

    return score


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, *, tables: int = TABLES, probes: int = PROBES, seed: int = 11,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found per query, by Euclidean distance."""
    valid = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"),
        F.transform(vectors[embedding], lambda x: x.cast("double")).alias("vector"), is_query.alias("asks")
    ).where(F.col("vec_id").isNotNull() & finite(F.col("vector")))
    rows = kept(
        valid.where(F.exists("vector", lambda x: x != 0)).dropDuplicates(["vec_id", "vector"]), "ann-vectors")
    queries = kept(
        rows.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector")),
        "ann-queries")
    bucket = ["dim", "table_no", "axis"]
    members = kept(_hashed(rows, tables, 1, seed, "vec_id"), "ann-index")
    asking = kept(_hashed(queries, tables, probes, seed, "query_id"), "ann-probes")
    found = kept(search_blocks(members, asking, bucket, _scorer(k), k, "double", False), "ann-found")
    # Sparse tables may leave a query with fewer than k: it searches its whole dimension.
    short = queries.join(
        found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k), "query_id", "left_anti"
    ).select(F.size("vector").alias("dim"), "query_id", "vector")
    short = kept(short, "ann-short")
    if short.isEmpty():
        return found
    everything = rows.select(F.size("vector").alias("dim"), "vec_id", "vector")
    rest = search_blocks(everything, short, ["dim"], _scorer(k), k, "double", False)
    return found.join(short.select("query_id"), "query_id", "left_anti").unionByName(rest)
