"""Byte-pair encoding by forced boundaries, and decoding.

Two bytes that stand side by side inside no token of the vocabulary can never be merged into
one, so every place between two such bytes is a certain cut. Encodings of the fragments
between certain cuts, concatenated, are the encoding of the whole. Cuts are used twice:

* In the text, in front of a space that follows a character other than white space. There
  the vocabulary's word pattern ends a word whatever comes after it, so that cutting before
  the words are known changes no word. (After white space it would.)
* In each word of a fragment, at every such pair of bytes. Merges never leave a word.

Fragments repeat across documents; each task remembers those it has encoded, up to a bound, and
starts anew beyond it. What remains is encoded by the tokenizer's own model.

Defined cases. A null text is empty and has no ids. Strings of special tokens in a text
become their ids, as the tokenizers library does by default. Ids decode to their bytes;
bytes that are no UTF-8 become the replacement character.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from .batches import map_texts, release, unused

REMEMBERED = 600_000
# Up to here the letters of the pattern and of str.isalpha are the same in all versions.
LATIN_END = "\u0250"
ENDS = ".,;:!?"
_AFTER_WORD = re.compile(r"(?<=\S)(?= )")
_BLANK_SPACE = re.compile(r"\s ")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Memo(dict):
    """Values of a function by their key. Beyond ``size`` keys the older half makes room."""

    def __init__(self, size: int, function):
        self.size, self.function, self.older = size // 2, function, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Encoder and decoder of one byte-level vocabulary, for one task."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) or self.tokenizer.normalizer is not None:
            raise ValueError("forced boundaries are worked out for byte-level vocabularies without a normalizer")
        self.alphabet = byte_alphabet()
        self.remembered = remembered
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {content: np.array([i], "<u4").tobytes() for content, i in special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        self.forced = np.ones((256, 256), bool)
        for token, i in vocabulary.items():
            raw = bytes(self.alphabet[c] for c in token)
            self.bytes_of[i] = raw
            for a, b in zip(raw, raw[1:]):
                self.forced[a, b] = False
        # The cut in front of a space is certain if no token holds a space after a character
        # other than white space (some hold it after a no-break space).
        decoded = [raw.decode("utf-8", "surrogateescape") for raw in self.bytes_of if b" " in raw]
        self.cut_texts = not any(b == " " and not a.isspace() for t in decoded for a, b in zip(t, t[1:]))
        for content, i in special.items():
            self.bytes_of[i] = content.encode()
        self.pairs = {chr_a + chr_b for chr_a, a in self.alphabet.items() for chr_b, b in self.alphabet.items() if self.forced[a, b]}
        self.of_byte = {b: c for c, b in self.alphabet.items()}
        self._pieces = Memo(remembered // 10, self._piece)
        self._texts = Memo(remembered // 10, self._words)
        self._spaced = Memo(remembered, lambda text: self._words(" " + text))

    def fragments(self, piece: str) -> list[str]:
        """A word, in the vocabulary's alphabet, cut at its certain boundaries."""
        pairs, begin, found = self.pairs, 0, []
        if pairs.isdisjoint(map(add, piece, piece[1:])):
            return [piece]
        for at in range(1, len(piece)):
            if piece[at - 1:at + 1] in pairs:
                found.append(piece[begin:at])
                begin = at
        found.append(piece[begin:])
        return found

    def _piece(self, piece: str) -> bytes:
        tokenize = self.tokenizer.model.tokenize
        return array("I", [t.id for f in self.fragments(piece) for t in tokenize(f)]).tobytes()

    def _mapped(self, word: str) -> str:
        return "".join(map(self.of_byte.__getitem__, word.encode("utf-8", "surrogatepass")))

    def _words(self, text: str) -> bytes:
        """A fragment of a text, by the words that the vocabulary's pattern makes of it."""
        letters = text.rstrip(ENDS)
        # Letters, after one space at most, and marks behind them: the pattern's simplest case.
        if max(letters, default=" ") < LATIN_END and letters[letters.startswith(" "):].isalpha():
            plain = letters.isascii()
            head = self._piece(letters.replace(" ", self.of_byte[0x20]) if plain else self._mapped(letters))
            return head + self._pieces[text[len(letters):]] if len(letters) < len(text) else head
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return b"".join([self._pieces[word] for word, _ in words])

    def _plain(self, text: str) -> bytes:
        if not self.cut_texts:
            return self._texts[text]
        if _BLANK_SPACE.search(text):
            return b"".join(map(self._texts.__getitem__, _AFTER_WORD.split(text)))
        first, *words = text.split(" ")
        return (self._texts[first] if first else b"") + b"".join(map(self._spaced.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_split is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join([
            self.special[part] if part in self.special else self._plain(part)
            for part in self.special_split.split(text) if part])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<u4").astype(np.int32), pa.int32()))


def encode(
    docs: DataFrame, path: str, *, keep: list[str] | None = None, text: str = "text", ids: str = "ids", remembered: int = REMEMBERED,
) -> DataFrame:
    """The columns ``keep`` (all but the text) and the ids of each text, as array<int>; where a column that is kept has
    that name, underscores go behind it. A task remembers the ids of ``remembered`` fragments at most."""
    keep = [c for c in docs.columns if c not in (text, ids)] if keep is None else keep
    ids = unused(keep, ids)

    def start():
        codec = Codec(path, remembered)
        return lambda texts: {ids: id_lists([codec.encode(t) for t in texts])}

    return map_texts(docs, text, f"{ids} array<int>", start, keep)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """All columns but the ids, and the text that the ids stand for (of null: null)."""
    keep = [c for c in encoded.columns if c not in (ids, text)]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name in keep]

    def run(batches):
        codec = Codec(path)
        for batch in batches:
            made = [None if v is None else codec.decode(np.array(v, "<u4").tobytes()) for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(made, pa.string())], names=[*keep, text])
        batch = made = codec = None
        release()

    return encoded.select(*keep, ids).mapInArrow(run, ", ".join([*fields, f"`{text}` string"]))


def digests(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded and decoded again in one pass."""
    def start():
        codec = Codec(path)
        decimal = [str(i).encode() for i in range(len(codec.bytes_of))]

        def work(texts: list) -> dict:
            n, shown, back = [], [], []
            for t in texts:
                ids = codec.encode(t)
                numbers = np.frombuffer(ids, "<u4").tolist()
                n.append(len(numbers))
                shown.append(hashlib.sha256(b",".join(map(decimal.__getitem__, numbers))).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            return {"n_tokens": n, "ids_sha256": shown, "decoded_sha256": back}

        return work

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return map_texts(rows, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", start, ["doc_id"])
