"""Groups and links against a walk over the bytes of each text, with the libraries encoding whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotemill.llm import alignment
from quotemill.llm.bpe import byte_alphabet
from quotemill.llm.queries import vocabulary

A, B = vocabulary(), vocabulary("piece_bpe_32k.model")
PARTS = [
    "the", "The", " ", "  ", "   ", "\n", "\t", "don't", "word", "ñandú", "日本語", "🙂", "١٢", "12345", "a_b", "<|endoftext|>", "<s>", "<0x41>",
    "aaaaaaa", "https://x.y/z?q=1", " ", "é", "ﬁ", "\r\n", "...", "naïve", "\x00", "[]{}()", "ß", "​"]


@pytest.fixture(scope="module")
def libraries():
    side = Tokenizer.from_file(A)
    side.encode_special_tokens = True
    return side, sentencepiece.SentencePieceProcessor(model_file=B)


def encoded(libraries, text):
    """((id, bytes) of A, of B), or none where the bytes do not join to the text."""
    if not text:
        return [], []
    side, model = libraries
    alphabet, whole = byte_alphabet(), (" " + text).encode()
    a = [(i, bytes(alphabet[c] for c in side.id_to_token(i))) for i in side.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    joins = all(b"".join(t for _, t in tokens) == whole for tokens in (a, b))
    return (a, b) if joins else ([], [])


def groups_of(a, b):
    """Cut where tokens of both sides end."""
    ends = [set(np.cumsum([len(t) for _, t in side]).tolist()) for side in (a, b)]
    shared = sorted(ends[0] & ends[1])
    groups = [([], []) for _ in shared]
    for which, side in enumerate((a, b)):
        at = 0
        for i, token in side:
            at += len(token)
            groups[next(g for g, end in enumerate(shared) if at <= end)][which].append(i)
    return groups


def brute(libraries, texts):
    grouped = [groups_of(*encoded(libraries, t)) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in grouped]
    documents = Counter(pair for found in links for pair in found)
    most = {}
    for (x, _), n in documents.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for groups, found in zip(grouped, links):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if documents[p] == most[p[0]]), sum(n * documents[p] for p, n in found.items()),
            hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return out, documents


def wild(n, seed, length=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_special_strings_are_plain_text(libraries):
    for text in wild(2000, 4):
        if text:
            got = np.frombuffer(alignment.ByteSide.ids(_byte_side(), text), "<u4").tolist()
            assert got == libraries[0].encode(" " + text, add_special_tokens=False).ids, repr(text)


_SIDE = []


def _byte_side():
    if not _SIDE:
        _SIDE.append(alignment.ByteSide(A))
    return _SIDE[0]


def test_equals_brute_force(documents, libraries):
    texts = [*wild(300, 1), "", None, "a▁b", " ", "  ", " " * 301, "\t" * 99 + " x", "a" * 500, *["the same text"] * 40, "x " * 3000]
    data = [(i % 330 if i else None, t, None, None) for i, t in enumerate(texts)]
    # Many partitions, and so many blocks: counts cross them.
    docs = documents(data).withColumn("block", F.lit(1)).repartition(13)
    got = sorted((tuple(r) for r in alignment.linked(docs, A, B).collect()), key=repr)
    want, _ = brute(libraries, texts)
    assert got == sorted(((d[0], *w) for d, w in zip(data, want)), key=repr)


def test_groups_and_counts(documents, libraries):
    texts = [*wild(60, 9), None, "a▁b"]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)])
    got = {r["doc_id"]: [(g["a"], g["b"]) for g in r["groups"]] for r in alignment.align(docs, A, B).collect()}
    assert got == {i: groups_of(*encoded(libraries, t)) for i, t in enumerate(texts)}
    _, documents_of = brute(libraries, texts)
    counts = alignment.link_counts(docs, A, B).collect()
    assert {(r["a_id"], r["b_id"]): r["documents"] for r in counts} == dict(documents_of)
    best = {r["a_id"] for r in counts if r["best"]}
    assert best == {a for a, _ in documents_of}


def test_empty_table(documents, rows):
    assert rows(alignment.linked(documents([]), A, B)) == [] and rows(alignment.align(documents([]), A, B)) == []


def test_a_long_group_costs_its_distinct_ids():
    """Tokens that never end together: one group, links by product."""
    a, b = np.array([1] + [2] * 20_000), np.array([2] * 20_000 + [1])
    batch = alignment.Batch(np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), np.array([len(a)]), np.array([len(b)]), (np.array([1]), np.array([1])))
    assert batch.n_groups.tolist() == [20_001]
    batch.group_a, batch.group_b = alignment.coalesced(a, b)
    assert int(batch.group_a[-1]) == 0
    ids_a, ids_b = np.arange(len(a)) % 3, np.arange(len(b)) % 2
    one = alignment.Batch.__new__(alignment.Batch)
    one.ids_a, one.ids_b, one.group_a, one.group_b = ids_a, ids_b, batch.group_a, batch.group_b
    one.in_a, one.in_b, one.doc = np.array([len(a)]), np.array([len(b)]), np.array([0])
    doc, x, y, n = one.links()
    assert len(n) == 6 and int(n.sum()) == len(a) * len(b) and set(doc.tolist()) == {0}


def test_packed_runs():
    """A width for all runs, which the largest value needs; runs come back in any order."""
    for largest, width in ((0, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 4), (1 << 32, 8), ((1 << 62) + 1, 8)):
        values, sizes = np.array([1, 0, largest, 7]), np.array([2, 0, 1, 1])
        runs = alignment._packed(values, sizes)
        assert [len(r) // width for r in runs.to_pylist()] == sizes.tolist()
        assert alignment._unpacked(pa.chunked_array([runs]), 4).tolist() == values.tolist()
        turned = pa.chunked_array([runs[2:], runs[:2]])
        assert alignment._unpacked(turned, 4).tolist() == [largest, 7, 1, 0]
    none = alignment._packed(np.zeros(0, np.int64), np.array([0, 0]))
    assert none.to_pylist() == [b"", b""] and alignment._unpacked(pa.chunked_array([none]), 0).tolist() == []


def test_a_pair_of_a_document_is_a_few_bytes(documents, libraries):
    """What is shuffled and sorted for the counts to come back to: twelve bytes a pair took most of the last stage's memory."""
    texts = [*wild(400, 5), "", None]
    docs = documents([(i, t, None, None) for i, t in enumerate(texts)]).coalesce(1)
    found = [len({(x, y) for a, b in groups_of(*encoded(libraries, t)) for x in a for y in b}) for t in texts]
    rows = alignment.blocks(docs, A, B).select("doc_id", "at", "times").collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        size = sum(len(c) if isinstance(c, (bytes, bytearray)) else 4 * len(c) for c in (r["at"], r["times"]))
        assert size <= 3 * found[r["doc_id"]]
