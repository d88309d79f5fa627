"""Language identification by rank-order profiles.

The profile of a language is the list of its most frequent character 1- to 3-grams (words in
lower case, one space at either end), most frequent first, counted over all its training
documents. A document's own profile is compared with it: every n-gram costs the difference
of its two ranks, and the length of a profile if the language lacks it. The language with the
smallest sum is predicted.

Defined cases. Without text or without a letter: ``und`` and the score 0. Ties go to the
language that is first by code point. With no training document at all every document is
``und``. A null id counts as the empty text for the hold-out. Null languages are not learned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .batches import map_texts, release, unused
from .ngrams import profile, ranked
from .scratch import kept

PROFILE = 300
UNDETERMINED = "und"
TEXTS = 512


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text is 2 modulo 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """lang, code, rank (from 0): ``size`` rows a language, from all rows of (lang, text)."""

    def count(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, TEXTS):
                part = batch.slice(begin, TEXTS)
                found: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    found.setdefault(lang, []).append(ranked(text))
                for lang, pairs in found.items():
                    codes, at = np.unique(np.concatenate([p[0] for p in pairs]), return_inverse=True)
                    counts = np.bincount(at, np.concatenate([p[1] for p in pairs]), len(codes)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts)], names=["lang", "code", "n"])
        batch = part = found = pairs = None
        release()

    counted = (
        docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
        .mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "code")
    # The filter is on the rank as it is, so that Catalyst cuts in front of the shuffle as well.
    first = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    return first.select("lang", "code", (F.col("place") - 1).alias("rank"))


class Ranks:
    """The profiles of all languages, for comparing."""

    def __init__(self, rows: list, size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        place = {c: i for i, c in enumerate(self.codes.tolist())}
        which = {lang: i for i, lang in enumerate(self.langs)}
        # The last column stands for n-grams that no language has.
        self.rank = np.full((len(self.langs), len(self.codes) + 1), -1, np.int32)
        for lang, code, rank in rows:
            self.rank[which[lang], place[code]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = ranked(text)
        if not len(codes) or not self.langs:
            return UNDETERMINED, 0.0
        own = profile(codes, counts, self.size)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != own] = len(self.codes)
        rank = self.rank[:, at]
        off = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own)))).sum(1)
        best = int(off.argmin())
        return self.langs[best], float(1 - off[best] / (self.size * len(own)))


def learn(docs: DataFrame, size: int = PROFILE, doc_id: str = "doc_id") -> list:
    """Profiles from the rows that are not held out; PROFILE rows a language reach the driver."""
    return [tuple(r) for r in kept(profiles(docs.where(~held_out(docs[doc_id])), size), "language-profiles").collect()]


def predict(
    docs: DataFrame, learned: list, keep: list[str], size: int = PROFILE, names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep``, and language and score (1: the profile itself, 0: nothing in common)."""

    def start():
        ranks = Ranks(learned, size)

        def work(texts: list) -> dict:
            found = [ranks.predict(t) for t in texts]
            return {names[0]: [f[0] for f in found], names[1]: [f[1] for f in found]}

        return work

    return map_texts(docs, "text", f"{names[0]} string, {names[1]} double", start, keep)


def identify(docs: DataFrame, *, size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row a document."""
    rows = docs.select("doc_id", "lang", "text")
    found = predict(rows.select("doc_id", "text"), learn(rows, size), ["doc_id"], size)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, *, size: int = PROFILE) -> DataFrame:
    """The documents that have a language, with the one predicted where ``lang`` is null; all else unchanged.

    Rejected are those that are undetermined, for want of a text or of letters, and those that have no n-gram
    in common with the language predicted. Where nothing could be learned, all that have a letter stay.
    """
    learned = learn(docs.select("doc_id", "lang", "text"), size)
    if not learned:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = names = (unused(docs.columns, "lang_pred"), unused(docs.columns, "score"))
    found = predict(docs, learned, docs.columns, size, names).where((F.col(lang) != UNDETERMINED) & (F.col(score) > 0))
    return found.select(*[F.coalesce("lang", lang).alias("lang") if c == "lang" else F.col(c) for c in docs.columns])
