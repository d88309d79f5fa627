"""The mix against a brute-force version, and its defined cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quotemill.llm import mixing


def brute(rows, seed=1):
    """(doc_id, size, source_size, target, taken) by whole lists in memory."""
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, s in rows]
    size = {}
    for _, s, n in sized:
        size[s] = size.get(s, 0) + n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full = set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        free = [s for s in order if s not in full]
        level = rest / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * level > 3 * size[s]}
        if not more:
            break
        full |= more
    target = {s: float(3 * size[s]) if s in full else weight[s] * level for s in order}
    out = []
    for s in order:
        own = sorted((int(hashlib.md5(f"{seed}/{'' if d is None else d}/{n}".encode()).hexdigest()[:15], 16), d, n) for d, t, n in sized if t == s)
        if not size[s]:
            out += [(d, n, 0, target[s], 0) for _, d, n in own]
            continue
        epochs, rest = divmod(int(target[s]), size[s])
        for key, d, n in own:
            before = sum(m for k, _, m in own if k < key)
            tied = sum(m for k, _, m in own if k == key)
            part = n * max(0, min(tied, rest - before)) // tied if tied else 0
            out.append((d, n, size[s], target[s], epochs * n + part))
    return sorted(out, key=repr)


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "a", "a", "b", "c", "Z", None, "é", "tiny"] if i % 50 else ["tiny"])
        rows.append((i, rng.choice([None, "", " \t\n", "w " * rng.randint(1, 60), "one\x0btwo\x1cthree"]), None, source))
    return rows


def test_equals_brute_force(documents, rows):
    data = corpus()
    got = rows(mixing.taken(documents(data)), "doc_id", "size", "source_size", "target", "taken")
    want = brute([(d, t, s) for d, t, _, s in data])
    assert [(*g[:3], pytest.approx(g[3], rel=1e-12), g[4]) for g in got] == want


def test_exact_budgets_and_caps(documents):
    found = mixing.taken(documents(corpus())).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"),
        F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert all(r.taken == int(r.target) and r.over <= 0 for r in found)


def test_repeated_rows_share_the_cut(documents, rows):
    data = [(1, "a b c d", None, "s")] * 30 + [(2, "x y", None, "t")] * 90 + [(None, "q r", None, "t")] * 40
    got = rows(mixing.taken(documents(data)), "doc_id", "taken")
    assert len(got) == 160 and len({g for g in got if g[0] == 2}) == 1
    assert got == rows(mixing.taken(documents(data)), "doc_id", "taken")


def test_empty_and_extra_columns(documents, rows):
    assert rows(mixing.taken(documents([]))) == [] and rows(mixing.mixed(documents([]))) == []
    clashing = documents(corpus(60)).withColumns({c: F.lit(7) for c in ("size", "key", "target", "_row", "epochs", "cut_key", "weight")})
    assert mixing.taken(clashing).count() == 60
    assert mixing.mixed(clashing).columns == clashing.columns


def test_mixed_repeats_whole_rows(documents, rows):
    docs = documents(corpus(120))
    times = {r[0]: r for r in rows(mixing.taken(docs), "doc_id", "size", "taken")}
    got = {}
    for r in mixing.mixed(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    want = {d: int(taken / size + 0.5) for d, (_, size, taken) in times.items() if size}
    assert got == {d: n for d, n in want.items() if n}


def test_ties_reach_the_target(documents):
    # Rows of one source without id and of equal size share their key.
    data = [(None, f"t{i} x", None, "a") for i in range(60)] + [(None, "same words here", None, "b")] * 40
    data += [(None, f"u{i} y z", "en" if i % 2 else None, "c") for i in range(30)] + [(1, "four words of one", None, "d")]
    docs = documents(data)
    target = {r.source: r.target for r in mixing.taken(docs).collect()}
    got = {}
    for r in mixing.mixed(docs).collect():
        got.setdefault(r.source, []).append(r.text)
    for source, size in (("a", 2), ("b", 3), ("c", 3)):
        assert abs(len(got[source]) * size - int(target[source])) <= size / 2
        every = [t for _, t, _, s in data if s == source]
        assert source == "b" or {got[source].count(t) for t in every} <= {len(got[source]) // len(every), len(got[source]) // len(every) + 1}
    plan = mixing.mixed(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_no_python_in_the_plan(documents):
    plan = mixing.mixed(documents(corpus(20)))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
