"""Alignment of the tokens of two tokenizers over the same bytes, and how often ids stand side by side.

Vocabulary A (byte-level) encodes a space and the text, vocabulary B (pieces, which adds that
space itself) the text. Tokens are intervals of bytes. All intervals of both sides, of a whole batch of
documents laid end to end, are sorted by start; the running maximum of their ends is
accumulated; a group ends where the next start reaches that maximum, which is where tokens of both sides
end, and at the end of each document. Within a group every token of A is linked with every token of B:
groups of a few tokens are expanded token by token, larger ones by their distinct ids with the product
of their numbers, so that a long run without a common end costs its distinct ids and not their square.

Counting. A block is a run of about 2 MB of text of one task. Each block adds up the documents of its
id pairs before anything is shuffled, so a pair is one row a block, however many documents hold
it, and no pair is more than its share of a block's distinct pairs. Counts go back to the blocks and from there to the documents.
What waits for them, the pairs of each document, is shuffled and sorted as places in its block's list, in as few bytes as the block needs.

Defined cases. A null or empty text, or one whose joined token bytes on either side are not a space and
the text, has no tokens and no groups. Strings of special tokens inside a text are plain text. Repeated rows
and null ids are documents of their own. An empty table gives an empty result. A document is worked on as a
whole: memory follows the longest text and its distinct pairs.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .batches import map_texts, release, slices
from .bpe import byte_alphabet
from .scratch import kept
from .token_files import Encoder

SPACE = "▁"
EXPANDED = 64  # links of a group that are listed token by token


class ByteSide:
    """The byte-level vocabulary: ids of a text and the bytes of each id."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.library.encode_special_tokens = True
        self.encoder.special = []
        alphabet = byte_alphabet()
        vocabulary = self.encoder.library.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            if set(token) <= alphabet.keys():
                self.bytes_of[i] = bytes(map(alphabet.__getitem__, token))

    def ids(self, text: str) -> bytes | None:
        """Ids of a space and the text; None if their bytes are not that."""
        whole = " " + text
        ids = self.encoder.encode(whole)
        joined = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return ids if joined == whole.encode() else None


class PieceSide:
    """The vocabulary of pieces."""

    def __init__(self, path: str):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(len(model))]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def ids(self, text: str) -> bytes | None:
        """Ids of a text; None if their bytes are not a space and the text."""
        ids = self.model.encode(text, num_threads=1)
        joined = b"".join(map(self.bytes_of.__getitem__, ids))
        return array("I", ids).tobytes() if joined == (" " + text).encode() else None


def coalesced(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group, from 0 in order, of every token of A and of B, given their lengths in bytes."""
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    start = np.concatenate([end_a - len_a, end_b - len_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(len_a), len(len_b)])
    order = np.lexsort((side, start))
    running = np.maximum.accumulate(np.concatenate([end_a, end_b])[order])
    group = np.zeros(len(start), np.int64)
    group[order[1:]] = np.cumsum(start[order][1:] >= running[:-1])
    return group[:len(len_a)], group[len(len_a):]


class Batch:
    """The aligned tokens of a list of texts, side by side."""

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, lengths: tuple):
        self.ids_a, self.ids_b, self.n_a, self.n_b = ids_a, ids_b, n_a, n_b
        self.group_a, self.group_b = coalesced(lengths[0][ids_a], lengths[1][ids_b])
        groups = int(self.group_a[-1]) + 1 if len(ids_a) else 0
        self.in_a = np.bincount(self.group_a, minlength=groups)
        self.in_b = np.bincount(self.group_b, minlength=groups)
        doc_a = np.repeat(np.arange(len(n_a)), n_a)
        self.doc = np.zeros(groups, np.int64)
        self.doc[self.group_a] = doc_a
        self.n_groups = np.bincount(self.doc, minlength=len(n_a))
        self.n_links = np.zeros(len(n_a), np.int64)
        np.add.at(self.n_links, self.doc, self.in_a * self.in_b)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """document, A id, B id, number: the links of each document, an entry or more for each pair of ids."""
        first_b = np.cumsum(self.in_b) - self.in_b
        small = self.in_a * self.in_b <= EXPANDED
        of_a = np.flatnonzero(small[self.group_a])
        group = self.group_a[of_a]
        times = self.in_b[group]
        at = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_b[group], times)
        parts = [(np.repeat(self.doc[group], times), np.repeat(self.ids_a[of_a], times), self.ids_b[at], np.ones(len(at), np.int64))]
        first_a = np.cumsum(self.in_a) - self.in_a
        for g in np.flatnonzero(~small).tolist():
            a, times_a = np.unique(self.ids_a[first_a[g]:first_a[g] + self.in_a[g]], return_counts=True)
            b, times_b = np.unique(self.ids_b[first_b[g]:first_b[g] + self.in_b[g]], return_counts=True)
            parts.append((
                np.full(len(a) * len(b), self.doc[g]), np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(times_a, times_b).ravel()))
        return tuple(np.concatenate(column) for column in zip(*parts))


class Aligner:
    """Both vocabularies, for one task."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.lengths = tuple(np.array([len(x) for x in side.bytes_of], np.int64) for side in (self.a, self.b))
        # A token as it is shown: followed by another of its side, or last of A, or of B, in its group.
        decimal = [str(i) for i in range(max(map(len, self.lengths)))]
        self.shown = [d + mark for mark in (",", "|", ";") for d in decimal]

    def _ids(self, text: str | None) -> tuple[bytes, bytes]:
        b = self.b.ids(text) if text else None
        a = self.a.ids(text) if b is not None else None
        return (a, b) if a is not None else (b"", b"")

    def align(self, texts: list) -> Batch:
        both = [self._ids(t) for t in texts]
        ids = [np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in zip(*both)]
        numbers = [np.array([len(i) // 4 for i in side], np.int64) for side in zip(*both)]
        return Batch(*ids, *numbers, self.lengths)

    def written(self, batch: Batch) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        width = len(self.shown) // 3
        codes = np.empty(len(batch.ids_a) + len(batch.ids_b), np.int64)
        # A token's place: behind those of its side, and those of the other side in the groups before (for B: and in its own).
        upto_a, upto_b = np.cumsum(batch.in_a), np.cumsum(batch.in_b)
        places = (
            (batch.ids_a, batch.group_a, (upto_b - batch.in_b)[batch.group_a], width),
            (batch.ids_b, batch.group_b, upto_a[batch.group_b], 2 * width))
        for ids, group, others, mark in places:
            last = np.append(group[1:] != group[:-1], True)[:len(ids)]
            codes[np.arange(len(ids)) + others] = ids + mark * last
        ends = np.cumsum(batch.n_a + batch.n_b).tolist()
        shown = self.shown.__getitem__
        return ["".join(map(shown, codes[begin:end].tolist()))[:-1] for begin, end in zip([0, *ends], ends)]


def _nested(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """A run of the values, none below zero, for each size; every value has as few bytes as the largest of all needs."""
    values = values.astype(f"<u{np.min_scalar_type(values.max(initial=0)).itemsize}")
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes) * values.itemsize]), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], pa.py_buffer(values.tobytes())])


def _unpacked(runs: pa.ChunkedArray, n: int) -> np.ndarray:
    """The n values of runs that were packed together, in any order of the runs."""
    joined = b"".join(runs.to_pylist())
    return np.frombuffer(joined, f"<u{len(joined) // n if n else 1}").astype(np.int64)


def align(docs: DataFrame, path_a: str, path_b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and groups, array<struct<a:array<int>, b:array<int>>>: the ids of both sides, group by group."""

    def start():
        aligner = Aligner(path_a, path_b)

        def work(texts: list) -> dict:
            batch = aligner.align(texts)
            sides = [
                _nested(pa.array(ids, pa.int32()), sizes)
                for ids, sizes in ((batch.ids_a, batch.in_a), (batch.ids_b, batch.in_b))]
            return {"groups": _nested(pa.StructArray.from_arrays(sides, names=["a", "b"]), batch.n_groups)}

        return work

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_texts(rows, "text", "groups array<struct<a:array<int>,b:array<int>>>", start, ["doc_id"])


# Ids of A and of B in one number.
_PAIR = 1 << 32

_ALIGNED = (
    "block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, held int, at binary, times binary, "
    "pairs array<long>, holders array<int>")


def blocks(docs: DataFrame, path_a: str, path_b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: its figures, and its distinct id pairs (``held`` of them) as places (``at``) in the list of pairs of its
    block with the number of their links (``times``), both packed, a width for the block. The block's first row has that list and
    the documents holding each pair."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches):
        aligner = Aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for part in slices(whole, "text"):
                batch = aligner.align(part.column("text").to_pylist())
                doc, a, b, times = batch.links()
                pairs, at = np.unique(a * _PAIR + b, return_inverse=True)
                key, where = np.unique(doc * max(len(pairs), 1) + at, return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, where, times)
                doc, at = np.divmod(key, max(len(pairs), 1))
                n = part.num_rows
                held = np.bincount(doc, minlength=n)
                once = np.array([len(pairs)] + [0] * (n - 1))
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligner.written(batch)]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.full(n, block)), pa.array(batch.n_a), pa.array(batch.n_b),
                    pa.array(batch.n_groups), pa.array(batch.n_links), pa.array(digests),
                    pa.array(held, pa.int32()), _packed(at, held), _packed(total, held),
                    _nested(pa.array(pairs), once), _nested(pa.array(np.bincount(at, minlength=len(pairs)), pa.int32()), once),
                ], names=["doc_id", *[part.split()[0] for part in _ALIGNED.split(", ")]])
                block += 1
        whole = part = batch = aligner = doc = a = b = times = pairs = at = key = where = total = None
        release()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_ALIGNED}")


def _listed(aligned: DataFrame) -> DataFrame:
    """(block, place, pair, holders): a row a block and pair."""
    return aligned.where(F.size("pairs") > 0).select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "entry")).select(
        "block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.holders").cast("long").alias("holders"))


def _counted(listed: DataFrame) -> DataFrame:
    """(pair, documents, best): best says that no other B id has more documents with this A id."""
    counts = listed.groupBy("pair").agg(F.sum("holders").alias("documents"))
    most = F.max("documents").over(W.partitionBy(F.shiftright("pair", 32)))  # at most a row for each id of B
    return counts.select("pair", "documents", (F.col("documents") == most).alias("best"))


def id_pairs(pair: Column) -> tuple[Column, Column]:
    return F.shiftright(pair, 32).cast("int"), pair.bitwiseAND(F.lit(_PAIR - 1)).cast("int")


def link_counts(docs: DataFrame, path_a: str, path_b: str, **columns: str) -> DataFrame:
    """a_id, b_id, documents (that hold the pair linked), best: the correspondence of the two vocabularies."""
    counted = _counted(_listed(kept(blocks(docs, path_a, path_b, **columns), "aligned")))
    a, b = id_pairs(F.col("pair"))
    return counted.select(a.alias("a_id"), b.alias("b_id"), "documents", "best")


def linked(docs: DataFrame, path_a: str, path_b: str, **columns: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row a document."""
    aligned = kept(blocks(docs, path_a, path_b, **columns), "aligned")
    listed = _listed(aligned)
    known = kept(_counted(listed), "pair-counts")
    facts = listed.join(known, "pair").select(F.col("block").alias("of_block"), "place", "documents", "best")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def count(rows: pa.Table, told: pa.Table) -> pa.Table:
        place = told.column("place").to_numpy()
        documents, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        documents[place] = told.column("documents").to_numpy()
        best[place] = told.column("best").to_numpy(zero_copy_only=False)
        held = rows.column("held").to_numpy()
        places, times = (_unpacked(rows.column(c), int(held.sum())) for c in ("at", "times"))
        doc = np.repeat(np.arange(rows.num_rows), held)
        made = {}
        for name, value in (("n_best", best), ("count_sum", documents)):
            total = np.zeros(rows.num_rows, np.int64)
            np.add.at(total, doc, times * value[places])
            made[name] = pa.array(total)
        return pa.table([made.get(c, rows.column(c) if c in rows.column_names else None) for c in out], names=out)

    rows = aligned.drop("pairs", "holders")
    kind = aligned.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(facts.groupBy("of_block")).applyInArrow(
        count, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
