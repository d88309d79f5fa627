"""Encoding against the tokenizers library; files against what was written."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotemill.llm import bpe, token_files
from quotemill.llm.queries import vocabulary

PARTS = [
    "a", "b ", " ", "\n", "'s", "'ll", "1", "é", "!", "  ", "\t", "x", "<|endoftext|>", "\r\n", " '", " ", "日本", "👍🏽", "\u0085", "\x1c",
    "²", "ſ", "K", "à ", "word ", "The quick", ".\n", "،", "٣", "​", "　", "thanedble", "Ω", "ß"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("make", [lambda: bpe.Codec(vocabulary(), remembered=50), lambda: token_files.Encoder(vocabulary())])
def test_equals_the_library(library, make):
    codec = make()
    for text in texts(6000):
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        if hasattr(codec, "decode"):
            assert codec.decode(codec.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_fragments_are_cut_at_certain_boundaries_only():
    codec = bpe.Codec(vocabulary())
    assert codec.cut_texts and codec.pairs
    for raw in codec.bytes_of[:50_000:97]:
        assert len(codec.fragments("".join(codec.of_byte[b] for b in raw))) == 1
    joined = "xqjzvwqkxz"
    assert "".join(codec.fragments(joined)) == joined and len(codec.fragments(joined)) > 1


def test_rank_based_encoder_is_proved_for_the_vocabulary():
    assert token_files.Encoder(vocabulary()).ranked is not None


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_and_round_trip(documents, rows, library):
    data = [(i, t, None, None) for i, t in enumerate(texts(60))] + [(90, None, None, None), (None, "a", None, None), (90, None, None, None), (91, "word " * 100_000, None, None)]
    got = rows(bpe.digests(documents(data).withColumn("n_tokens", F.lit(1)), vocabulary()))
    want = []
    for d, t, *_ in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), digest(",".join(map(str, ids))), digest(t or "")))
    assert got == sorted(want, key=repr)
    assert rows(bpe.digests(documents([]), vocabulary())) == []
    docs = documents(data[:60]).withColumn("ids", F.lit(2))
    back = bpe.decode(bpe.encode(docs, vocabulary(), ids="tokens"), vocabulary(), ids="tokens")
    assert rows(back, "doc_id", "text", "ids") == sorted([(d, t, 2) for d, t, *_ in data[:60]], key=repr)


def brute_offsets(data, library):
    out, start = [], 0
    for d, t, *_ in sorted(data, key=lambda r: r[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_read_back(spark, documents, rows, library):
    data = [(i * 7 - 50, t, None, None) for i, t in enumerate(texts(300, 4))] + [(9999, None, None, None)]
    random.Random(2).shuffle(data)
    tokens = token_files.encoded_files(documents(data).withColumns({"file": F.lit(1), "row": F.lit(2)}).repartition(5), vocabulary())
    want = brute_offsets(data, library)
    assert sorted(rows(token_files.checked_offsets(tokens))) == want
    assert sorted(rows(token_files.offsets(tokens))) == [w[:3] for w in want]
    assert rows(token_files.checked_offsets(token_files.encoded_files(documents([]), vocabulary()))) == []


def test_files_have_the_stated_form(documents, spark):
    tokens = token_files.encoded_files(documents([(i, "the quick brown fox " * 40, None, None) for i in range(200)]), vocabulary())
    file = sorted(tokens.inputFiles())[0].removeprefix("file://").removeprefix("file:")
    column = pq.ParquetFile(file).metadata.row_group(0)
    lists = column.column(2)
    assert lists.path_in_schema.startswith("ids") and lists.compression == "ZSTD"
    assert any("DICTIONARY" in e or "DELTA" in e for e in lists.encodings)
    assert lists.has_offset_index and column.column(0).has_column_index
    plan = token_files.offsets(tokens)._jdf.queryExecution().toString()
    assert "ids" not in tokens.where("doc_id = 5").select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_repeated_and_null_ids(documents, rows):
    data = [(1, "a", None, None), (1, "a", None, None), (1, "b c", None, None), (None, "x", None, None), (None, None, None, None)]
    got = sorted(rows(token_files.checked_offsets(token_files.encoded_files(documents(data), vocabulary()))), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1, 1]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(5)]
