"""Mixing sources to target weights, by hash-random order and exact cuts.

Every row gets a hash-random key. Rows are range-sorted by source and key, and distributed prefix sums
of their words are taken: a sum within each range, and one total a range carried from range to range. Within
its source the rows in key order are one epoch of it. A source's target is made of as many whole epochs as fit and of
the first rows of one more, cut at the row whose prefix sum reaches the rest of the target. Only (source, key, words) is
sorted, a row a key; a source with a third of all rows is many ranges. Texts are never shuffled: rows are
taken or left by comparing their key with the cut of their source.

Defined cases. A null text has no words. A null source is a source of its own, the last.
Rows of one source that have the same key (the same id and number of words, hence repeated
rows) share what the cut leaves them in proportion to their words, rounded down. An empty
table gives an empty result. A source without words gets the target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import kept, running_sums

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, size: Column, seed: int) -> Column:
    """60 uniform bits that depend on the row's id and words and on the seed."""
    named = F.concat_ws("/", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), size.cast("string"))
    return _bits(named)


def _bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Sources with ``target``: all words shared by weight, ``max_epochs`` times a source's
    own words at most, and what exceeds that shared again among the others.

    ``sources``: (source, source_size). Weights go by the rank of the source by code point,
    null last, and repeat.
    """
    ranked = kept(
        running_sums(
            sources.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()],
            {"_rank": "_one"}, "mix-ranks")
        .select(
            "source", "source_size",
            F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
            .cast("long").alias("weight"),
            (F.col("source_size") * max_epochs).alias("cap")),
        "mix-sources")
    level = None
    while True:
        above = F.lit(False) if level is None else F.col("cap") < F.col("weight") * F.lit(level)
        got = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(above, F.col("cap"))).alias("full"),
            F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if not got.open:
            break
        reached = ((got.total or 0) - (got.full or 0)) / got.open
        if reached == level:
            break
        level = reached
    share = F.col("weight") * F.lit(0.0 if level is None else level)
    return ranked.select(
        "source", "source_size",
        F.when(F.col("cap") < share, F.col("cap").cast("double")).otherwise(share).alias("target"))


def cuts(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """Per source: whole epochs, and the key at which the further epoch is cut.

    Rows with a smaller key are in it; the rows with the key itself, ``cut_size`` words
    together, get ``cut_words`` of them. Without a rest to take the key is null.
    """
    budget = F.floor("target")
    plan = shares.where("source_size > 0").select(
        "source",
        F.floor(budget / F.col("source_size")).alias("epochs"),
        (budget % F.col("source_size")).alias("rest"))
    by_source = F.col("source").asc_nulls_last()
    keys = sized.groupBy("source", "key").agg(F.sum("size").alias("words"))
    summed = running_sums(keys, [by_source, F.col("key")], {"upto": "words"}, "mix-sums")
    # The words of all sources in front of each, a row a source.
    own = sized.groupBy("source").agg(F.sum("size").alias("own"))
    through = running_sums(own, [by_source], {"through": "own"}, "mix-through")
    before = kept(through.select(F.col("source").alias("_source"), (F.col("through") - F.col("own")).alias("before")), "mix-before")
    rests = kept(
        plan.where("rest > 0").join(before, F.col("source").eqNullSafe(F.col("_source"))).select(
            F.col("source").alias("_source"), "rest", (F.col("before") + F.col("rest")).alias("goal")), "mix-rest")
    # The first key that reaches the rest; what precedes it is taken.
    found = (
        summed.join(rests, F.col("source").eqNullSafe(F.col("_source")))
        .where("upto >= goal AND upto - words < goal")
        .select("_source", F.col("key").alias("cut_key"), (F.col("goal") - F.col("upto") + F.col("words")).alias("cut_words"), F.col("words").alias("cut_size")))
    return plan.join(found, plan.source.eqNullSafe(found._source), "left").select(
        "source", "epochs", "cut_key", "cut_words", "cut_size")


def mix_plan(
    docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 1,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """What the mix takes: one row (doc_id, source, size, key) a document, and one row a
    source with its size, target, whole epochs and cut."""
    sized = kept(
        docs.select(
            docs[doc_id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"))
        .withColumn("key", random_key(F.col("doc_id"), F.col("size"), seed)),
        "mix-sizes")
    shares = kept(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs),
        "mix-targets")
    found = cuts(sized, shares)
    plan = shares.join(
        found.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).select("source", "source_size", "target", "epochs", "cut_key", "cut_words", "cut_size")
    return sized, kept(plan, "mix-plan")


def words_taken(size: Column, key: Column) -> Column:
    """Words taken of a row, from the columns of its source's plan."""
    rest = (
        F.when(key < F.col("cut_key"), size)
        .when(key == F.col("cut_key"), F.floor(size * F.col("cut_words") / F.col("cut_size")))
        .otherwise(0))
    return F.coalesce(F.col("epochs") * size + rest, F.lit(0)).cast("long")


def taken(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: a row for each row of ``docs``."""
    sized, plan = mix_plan(docs, **how)
    return sized.withColumnRenamed("source", "_source").join(
        plan, F.col("_source").eqNullSafe(F.col("source")), "left"
    ).select("doc_id", "source", "size", "source_size", "target", words_taken(F.col("size"), F.col("key")).alias("taken"))


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it.

    All columns are returned as they are. Texts stay whole: the document in which a cut
    falls is taken once more if at least half of its words are. A row without words is not
    part of any mix and is left out. Rows of one source that share the key of its cut are
    ordered by a hash of the whole row, and as many of them are taken as fill what the cut
    leaves, to half a row.
    """
    sized, plan = mix_plan(docs, weights=weights, max_epochs=max_epochs, seed=seed)
    # Names of its own, so that columns of the documents cannot clash with the plan's.
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row")).withColumn(
        "_size", word_count(F.col("_row.text"))
    ).withColumn("_key", random_key(F.col("_row.doc_id"), F.col("_size"), seed))
    times = F.when(
        F.col("_size") > 0, F.floor(words_taken(F.col("_size"), F.col("_key")) / F.col("_size") + F.lit(0.5))
    ).otherwise(0).cast("int")
    planned = row.join(plan, F.col("_row.source").eqNullSafe(F.col("source")))
    at_cut = F.coalesce(F.col("_key") == F.col("cut_key"), F.lit(False)) & (F.col("_size") > 0)
    if (
        sized.where("size > 0").join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .where("key = cut_key").groupBy("source").count().where("count > 1").isEmpty()
    ):
        return _repeated(planned.withColumn("_times", times))
    return _repeated(planned.where(~at_cut).withColumn("_times", times)).unionByName(
        _repeated(_tied(planned.where(at_cut))))


def _repeated(rows: DataFrame) -> DataFrame:
    """The fields of ``_row``, ``_times`` times."""
    return (
        rows.select("_row", F.explode(F.sequence(F.lit(1), F.greatest("_times", F.lit(1)))).alias("_copy"), "_times")
        .where("_times >= 1")
        .select("_row.*"))


def _tied(rows: DataFrame) -> DataFrame:
    """_row, _times of the rows with the key of their source's cut.

    The cut is divided again, over a hash of the whole row. Rows with the hash of that cut
    are exact repeats: one of them stands for all.
    """
    tied = rows.withColumn("_hash", _bits(F.to_json("_row")))
    sums = kept(tied.select(F.col("_row.source").alias("source"), F.col("_size").alias("size"), F.col("_hash").alias("key"), "cut_words", "cut_size"), "mix-tied")
    shares = kept(
        sums.groupBy("source").agg(F.first("cut_size").alias("source_size"), F.first("cut_words").alias("target")), "mix-tied-targets")
    found = kept(cuts(sums.select("source", "size", "key"), shares).select(
        F.col("source").alias("_source"), F.col("epochs").alias("_all"), F.col("cut_key").alias("_cut"), F.col("cut_words").alias("_rest")),
        "mix-tied-cuts")
    divided = tied.join(found, F.col("_row.source").eqNullSafe(F.col("_source")))
    here = F.coalesce(F.col("_hash") == F.col("_cut"), F.lit(False))
    before = F.coalesce(F.col("_hash") < F.col("_cut"), F.lit(False)).cast("long")
    apart = divided.where(~here).select("_row", (F.col("epochs") + F.col("_all") + before).cast("int").alias("_times"))
    repeats = divided.where(here).groupBy("_source").agg(
        F.first("_row").alias("_row"),
        (F.count("*") * F.first("epochs") + F.floor(F.first("_rest") / F.first("_size") + F.lit(0.5))).cast("int").alias("_times"))
    return apart.unionByName(repeats.select("_row", "_times"))
