"""The pipeline against the brute-force versions of its stages, one after the other."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quotemill.llm.queries import vocabulary
from quotemill.llm.secret_scan import redact
from quotemill.session import scratch_root

import test_classifiers
import test_mixing
import test_near_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(8)
    words = {
        "en": "the and that with of in to is was for on are this from by".split(), "fr": "le la les des et est une dans pour que qui sur avec pas au".split()}
    rows = []
    for i in range(70):
        lang = rng.choice(["en", "fr"])
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "", "x", "er"]) for _ in range(rng.randint(1, 120)))
        if i % 9 == 4:
            text += " password=abcdefgh12345678 0123456789abcdef0123"
        if i % 7 == 3 and rows:
            text = rows[-1][1] + rng.choice(["", " more"])
        rows.append((i, text, lang, rng.choice(["s0", "s0", "s1", None])))
    return [*rows, (70, None, "en", "s1"), (71, "", None, "s0"), (72, "12 !!", "en", "s1"), (73, "word", None, "s2"), (74, "le la est que pas une", None, "s1")]


def brute(rows):
    found = {d: lang for d, _, lang, _ in test_classifiers.brute(rows) if lang != "und"}
    rows = [r for r in rows if r[0] in found]
    kept = {d for d, _, _, stays in test_near_dedup.brute([r[:2] for r in rows]) if stays}
    rows = [(d, redact(t), lang or found[d], s) for d, t, lang, s in rows if d in kept]
    plan = {d: (size, taken) for d, size, _, _, taken in test_mixing.brute([(d, t, s) for d, t, _, s in rows])}
    tokenizer = Tokenizer.from_file(vocabulary())
    out = []
    for d, t, lang, s in rows:
        size, taken = plan[d]
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        out += [(d, lang, s, len(t), ids)] * int(taken / size + 0.5)
    return sorted(out, key=repr)


def test_run_equals_brute_force(spark, documents, rows, tmp_path):
    documents(corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    before = set(Path(scratch_root(spark).removeprefix("file:")).iterdir())
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert rows(got) == brute(corpus())
    assert {r["lang"] for r in got.where("doc_id IN (73, 74)").collect()} <= {"en", "fr"}
    # of all that was written on the way the last table is left
    left = set(Path(scratch_root(spark).removeprefix("file:")).iterdir()) - before
    assert [p.name.rsplit("-", 1)[0] for p in left] == ["pipeline-bpe_encode"]


def test_clashing_columns_and_repeated_ids(spark, documents, tmp_path):
    docs = documents(corpus()[:12]).withColumn("token_ids", F.lit("mine"))
    got = corpus_pipeline.encode_documents(spark, docs, str(tmp_path))
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "token_ids", "token_ids_"]
    assert {r["token_ids"] for r in got.collect()} == {"mine"}
    twice = documents([(1, "a b c d e f", "en", "s"), (1, "x y z u v w", "fr", "t"), (2, "other words are here", "en", "s")])
    first = corpus_pipeline.drop_near_duplicates(spark, twice, str(tmp_path)).orderBy("doc_id").collect()
    again = corpus_pipeline.drop_near_duplicates(spark, twice.repartition(5), str(tmp_path)).orderBy("doc_id").collect()
    assert [r.doc_id for r in first] == [1, 2] and first == again


def test_stages_return_the_columns_of_documents(spark, documents, tmp_path):
    docs = documents(corpus()[:30])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == COLUMNS, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "secret_scan", "source_mix", "bpe_encode"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_an_empty_table(name, stage, spark, documents, tmp_path):
    assert stage(spark, documents([]), str(tmp_path)).count() == 0


def test_near_duplicates_go_from_a_similarity_of_four_fifths(spark, documents, tmp_path):
    rng = random.Random(11)
    data = []
    for group in range(6):
        words = [f"w{group}x{i}" for i in range(200)]
        data.append((10 * group, " ".join(words)))
        for copy in range(1, 6):  # 1 to 5 words changed: similarities from 0.95 to 0.77
            text = list(words)
            for at in range(copy):
                text[20 + 40 * at + rng.randrange(10)] = f"y{group}x{copy}x{at}"
            data.append((10 * group + copy, " ".join(text)))
    got = corpus_pipeline.drop_near_duplicates(spark, documents([(d, t, "en", "s") for d, t in data]), str(tmp_path))
    kept = sorted(d for d, _, _, stays in test_near_dedup.brute(data, 80) if stays)
    assert sorted(r.doc_id for r in got.collect()) == kept == sorted(10 * g + c for g in range(6) for c in (0, 5))
