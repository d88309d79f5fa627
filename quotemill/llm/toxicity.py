"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

Features are the hashed character 3- to 6-grams a document has, each counted once. For every
bucket the log-count ratio r = log(p / q) is taken from the training rows: p and q are the smoothed
shares of the bucket in toxic and in other rows. A document's features are its buckets' r, and a
logistic regression with an L2 penalty is fitted on them. Buckets count whose share of toxic rows is off
by three standard deviations or more (``least``), however many these are; there are 2^20 buckets at most, which bounds the model.

The classifier is fitted on a bounded sample: the TRAINING labelled rows, of those that are
not held out, that come first in an order by hash. All documents are scored, on whole texts.

Defined cases. Where rows repeat an id, its smallest text is learned from. Empty and null texts have only the n-grams of two spaces, hence the score of the
intercept. Null labels are no labels; of several labels of an id the highest counts. Without both kinds of label in the
training rows the score is the share of toxic ones (0 without any). A null id is the empty text for the hold-out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_texts, release
from .language import held_out
from .ngrams import hashed_codes
from .scratch import kept

SIZES = (3, 4, 5, 6)
BITS = 20
TRAINING = 16_384
LEAST = 9.0  # squared standard deviations by which a bucket's count of toxic rows is off
SMOOTHING = 1.0
PENALTY = 0.0002
THRESHOLD = 0.3


def _training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, toxic and text of at most ``most`` labelled documents."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most TRAINING narrow rows
    return labelled.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _buckets(text: str | None) -> np.ndarray:
    return np.unique(hashed_codes(text, SIZES, BITS))


def _counts(rows: DataFrame) -> DataFrame:
    """bucket, toxic_n, other_n: documents that have it, summed per task and then by key."""

    def count(batches):
        total = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                total[int(label > 0), _buckets(text)] += 1
        seen = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[1][seen], pa.int64()), pa.array(total[0][seen], pa.int64())],
            names=["bucket", "toxic_n", "other_n"])
        batch = total = seen = None
        release()

    return (
        rows.select("toxic", "text").mapInArrow(count, "bucket int, toxic_n long, other_n long")
        .groupBy("bucket").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("other_n").alias("other_n")))


def fit(docs: DataFrame, labels: DataFrame, *, training: int = TRAINING, least: float = LEAST, penalty: float = PENALTY) -> dict:
    """Intercept and a weight for each bucket that counts: the regression's coefficient times r."""
    rows = kept(_training_rows(docs, labels, training), "toxicity-rows")
    n_toxic, n = rows.agg(F.count_if(F.col("toxic") > 0), F.count("*")).first()
    if not n_toxic or n_toxic == n:
        return {"share": n_toxic / n if n else 0.0, "buckets": [], "weights": [], "intercept": 0.0}
    counts = kept(_counts(rows), "toxicity-counts")
    total_toxic, total_other, distinct = counts.agg(F.sum("toxic_n"), F.sum("other_n"), F.count("*")).first()
    seen = F.col("toxic_n") + F.col("other_n")
    expected = seen * F.lit(n_toxic / n)
    deviation = (F.col("toxic_n") - expected) ** 2 / (seen * F.lit((n_toxic / n) * (1 - n_toxic / n)) + 1)
    p = (F.col("toxic_n") + SMOOTHING) / F.lit(float(total_toxic + SMOOTHING * distinct))
    q = (F.col("other_n") + SMOOTHING) / F.lit(float(total_other + SMOOTHING * distinct))
    # At most 2^BITS pairs of numbers.
    chosen = counts.where(deviation >= least).select("bucket", F.log(p / q).alias("r")).toArrow()
    buckets = chosen.column("bucket").to_numpy()
    order = np.argsort(buckets)
    buckets, ratio = buckets[order], chosen.column("r").to_numpy()[order]
    if not len(buckets):
        return {"share": n_toxic / n, "buckets": [], "weights": [], "intercept": 0.0}

    @F.udf(VectorUDT())
    def scaled(text):
        own = _buckets(text)
        at = np.searchsorted(buckets, own)
        at[at == len(buckets)] = 0
        at = at[buckets[at] == own]
        return Vectors.sparse(len(buckets), at, ratio[at])

    data = kept(
        rows.select(F.when(F.col("toxic") > 0, 1.0).otherwise(0.0).alias("label"), scaled("text").alias("features")),
        "toxicity-features")
    model = LogisticRegression(maxIter=60, regParam=penalty, standardization=False).fit(data)
    return {
        "share": n_toxic / n, "buckets": buckets, "intercept": float(model.intercept),
        "weights": model.coefficients.toArray() * ratio}


def _start(model: dict):
    def start():
        table = np.zeros(1 << BITS, np.float32)
        table[np.asarray(model["buckets"], np.int64)] = model["weights"]

        def one(text: str | None) -> float:
            if not len(model["buckets"]):
                return float(model["share"])
            own = hashed_codes(text, SIZES, BITS)
            own = np.unique(own[table[own] != 0])
            at = model["intercept"] + float(table[own].astype(np.float64).sum())
            return 1 / (1 + math.exp(-at)) if at > -700 else 0.0

        return lambda texts: {"score": [one(t) for t in texts]}

    return start


def score(docs: DataFrame, model: dict, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted; one row a document."""
    scored = map_texts(docs.select("doc_id", "text"), "text", "score double", _start(model), ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
