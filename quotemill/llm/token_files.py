"""Token ids as Parquet list columns, in document order, for selective reads.

Documents are range-partitioned and sorted by id before they are encoded, so that files hold
ascending ids and a reader of some documents skips files, row groups and pages by their
statistics. Columns: the document's id, its number of tokens and the list of ids. List items
are dictionary-encoded while a column chunk's distinct ids fit the dictionary page and
delta-encoded (binary packed) beyond it; row groups and pages have set sizes; Spark's Parquet
writer adds column and offset indexes. ``offsets`` reads the two narrow columns only.

The encoder gives the ids of the tokenizers library for its file. Where every token of the
vocabulary is what its own bytes encode to and ids follow the order of merges, merging by
rank and merging by the list of merges are the same: two neighbouring tokens whose bytes
make a token can then only be the pair that its merge lists. This is tested on all tokens
when an encoder is made; texts of Latin letters then go through a rank-based encoder, which
is several times faster. All other texts, and all texts if the test fails, go through the
tokenizers library.

Defined cases. A null text is empty: its list holds the end id only. Null ids come first.
Rows that repeat an id are ordered by their text. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .batches import map_texts
from .bpe import byte_alphabet, id_lists
from .scratch import fresh, kept, running_sums

# Fixed value: the word pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Up to here the classes of the pattern are the same in all versions of Unicode.
OTHER_THAN_LATIN = re.compile("[^\x00-ɏ]")
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
DICTIONARY_BYTES = 512 << 10


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit), as the tokenizers library encodes them."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ranked = self._ranked(path)

    def _ranked(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, before = whole["model"], whole.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or whole.get("normalizer") or before != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": before.get("trim_offsets"), "use_regex": True,
        } or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"):
            return None
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        tokenize = self.library.model.tokenize
        if merged != sorted(set(merged)) or any([t.id for t in tokenize(v)] != [i] for v, i in vocabulary.items()):
            return None
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}
        if len(ranks) != len(vocabulary) or {bytes([b]) for b in range(256)} - set(ranks):
            return None
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ranked is None or OTHER_THAN_LATIN.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, *, end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Write doc_id, n_tokens and ids (with the end id) in ascending order of doc_id."""
    end = np.array([end_id], "<u4").tobytes()

    def start():
        encoder = Encoder(vocabulary)

        def work(texts: list) -> dict:
            encoded = [encoder.encode(t) + end for t in texts]
            return {"n_tokens": [len(e) // 4 for e in encoded], "ids": id_lists(encoded)}

        return work

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    # Equal ids spread by a hash of the text, so that no task has to take all of them.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        map_texts(ordered, "text", "n_tokens long, ids array<int>", start, ["doc_id"])
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        .parquet(path))


def read_tokens(spark: SparkSession, path: str, doc_id_schema: str = "long") -> DataFrame:
    return spark.read.schema(f"doc_id {doc_id_schema}, n_tokens long, ids array<int>").parquet(path)


def checked_offsets(tokens: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it in the files), n_tokens, ids_crc32.

    The checksum is of the ids as little-endian unsigned 32-bit integers. It is taken where
    the lists are read; only narrow rows go on into the running sum.
    """
    def checksums(batches):
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = lists.offsets.to_numpy()
            crc = pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in narrow], crc], names=[*narrow, "ids_crc32"])

    narrow = ["doc_id", "n_tokens", "file", "row"]
    kind = tokens.schema["doc_id"].dataType.simpleString()
    read = tokens.select(
        "doc_id", "n_tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "ids"
    ).mapInArrow(checksums, f"doc_id {kind}, n_tokens long, file string, row long, ids_crc32 long")
    # Files and rows are numbered in the order in which they were written.
    order = [F.col("doc_id").asc_nulls_first(), F.col("file"), F.col("row")]
    # Written first: dealing rows out by ranges looks at them twice, and the lists are to be read once.
    summed = running_sums(kept(read, "token-checksums"), order, {"upto": "n_tokens"}, "token-offsets")
    return summed.select("doc_id", (F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def offsets(tokens: DataFrame) -> DataFrame:
    """doc_id, start and n_tokens from the narrow columns alone; the lists are not read."""
    narrow = tokens.select(
        "doc_id", "n_tokens", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("file"), F.col("row")]
    summed = running_sums(narrow, order, {"upto": "n_tokens"}, "token-offsets")
    return summed.select("doc_id", (F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens")


def encoded_files(docs: DataFrame, vocabulary: str, *, end_id: int = 0) -> DataFrame:
    """Writes the documents' tokens below the shared folder and returns them as read back."""
    path = fresh(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, end_id=end_id)
    return read_tokens(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString())
