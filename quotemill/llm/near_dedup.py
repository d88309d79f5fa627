"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

1. One pass over the texts: the set of five-word shingles, its size and 128-bit id, its
   SuperMinHash signature (200 positions) and 40 band keys of five positions. Documents with
   equal sets are one class from here on; the one with the smallest id stands for it.
2. Classes that share a band key are in one bucket. Every member is paired with the bucket's
   smallest one only, which finds the links of a large group of copies with one pair each.
3. Pairs whose signatures agree in fewer than AGREEING positions are dropped: for a similarity of 0.85
   that is six standard deviations off. Of the others first each class's pair with its smallest partner is verified
   on full sets and connected classes are grouped; then the pairs between different groups.
4. What that leaves open are pairs of members of one bucket that are in different groups. In
   buckets of three and more each member is paired with the member closest to all of its
   block, the likeliest origin of a group of copies, and these pairs are verified.
5. In buckets that still hold several groups all signatures are compared, in blocks of bounded size.
   Members with a likely partner in another group, not seen in an earlier band, come
   together once more with their full sets, and all links among them are counted exactly. A
   block returns a forest of its links, so rows stay in proportion to members. No bucket is
   capped.

A link of similarity 0.85 shares no band with a probability of (1 - 0.85^5)^40 = 7e-11.

Defined cases. Without text or words the set is empty: no link, a component of its own. A
null id is linked with nothing; its component is null and it is kept. Rows that repeat an
id are one document: their links add up. An empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_texts, release
from .components import components
from .scratch import kept
from .superminhash import POSITIONS, WORDS, band_keys, set_id, shingles, short_form, signatures

BAND_ROWS = 5
BLOCK = 1024
SETS_BLOCK = 256
SETS_SHINGLES = 100_000  # shingles of a block of full sets


def agreeing(percent: int, positions: int = POSITIONS) -> int:
    """Positions in which signatures of sets just similar enough agree, less six deviations."""
    p = percent / 100
    return max(1, math.floor(positions * p - 6 * math.sqrt(positions * p * (1 - p))))


def _signed() -> object:
    def work(texts: list) -> dict:
        sets = [shingles(t) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        signature = signatures([sets[i] for i in full])
        keys, short = band_keys(signature, BAND_ROWS), short_form(signature)
        bands: list = [None] * len(texts)
        shorts: list = [None] * len(texts)
        for row, i in enumerate(full):
            bands[i], shorts[i] = keys[row], short[row].tobytes()
        return {
            "n_shingles": [len(s) for s in sets],
            "set_id": [set_id(s) if len(s) else None for s in sets],
            "bands": pa.array(bands, pa.list_(pa.int64())),
            "signature": pa.array(shorts, pa.binary()),
        }

    return work


def _sets() -> object:
    def work(texts: list) -> dict:
        sets = [shingles(t) for t in texts]
        return {
            "set_id": [set_id(s) if len(s) else None for s in sets],
            "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
        }

    return work


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("own"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("other"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = both.select(
        "a", "b", F.size("own").alias("n"), F.size("other").alias("m"), F.size(F.array_intersect("own", "other")).alias("common"))
    return common.where(100 * F.col("common") >= percent * (F.col("n") + F.col("m") - F.col("common"))).select("a", "b")


def _similar(pairs: DataFrame, signed: DataFrame, least: int) -> DataFrame:
    """The pairs whose signatures agree in at least ``least`` positions."""
    left = signed.select(F.col("class").alias("a"), F.col("signature").alias("own"))
    right = signed.select(F.col("class").alias("b"), F.col("signature").alias("other"))

    def compare(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                near = (_positions(part.column("own")) == _positions(part.column("other"))).sum(1) >= least
                yield part.select(["a", "b"]).filter(pa.array(near))
        batch = part = near = None
        release()

    return pairs.join(left, "a").join(right, "b").select("a", "b", "own", "other").mapInArrow(compare, "a long, b long")


def _positions(signatures: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint16).reshape(len(signatures), POSITIONS)


def _numbers(members: pa.Table, column: str) -> np.ndarray:
    return members.column(column).to_numpy()


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Rows of lists of numbers, without copies."""
    whole = column.combine_chunks()
    values, ends = whole.values.to_numpy(), whole.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _stars(least: int):
    """Pairs of each member with the member that is closest to all of the block.

    In a large block the value most members have is taken at every position; the member that
    agrees with most of these values is the likeliest origin of the others. In a small one it is the
    member that agrees most with the others.
    """
    def choose(members: pa.Table) -> pa.Table:
        own = _positions(members.column("signature"))
        if len(own) <= 32:
            center = int((own[:, None] == own[None]).sum((1, 2)).argmax())
        else:
            ordered = np.sort(own, axis=0)
            starts = np.vstack([np.ones((1, POSITIONS), bool), ordered[1:] != ordered[:-1]])
            common = np.empty(POSITIONS, np.uint16)
            for p in range(POSITIONS):
                at = np.flatnonzero(starts[:, p])
                common[p] = ordered[at[np.diff([*at, len(own)]).argmax()], p]
            center = int((own == common).sum(1).argmax())
        group = _numbers(members, "root")
        near = ((own == own[center]).sum(1) >= least) & (group != group[center])
        ids = _numbers(members, "class")
        return _pairs(np.minimum(ids[near], ids[center]), np.maximum(ids[near], ids[center]))

    return choose


def _likely_members(least: int):
    """Members of a bucket with a likely partner in another group, of the pairs that share no
    earlier band."""
    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("bucket", "class", "variant")})
        own, other = (_positions(x.column("signature")) for x in (left, right))
        bands, facing = (np.array(x.column("bands").to_pylist(), np.int64) for x in (left, right))
        earlier = int(left.column("band")[0].as_py())
        group, groups = _numbers(left, "root"), _numbers(right, "root")
        found: set[tuple[int, int]] = set()
        a, b = (list(zip(_numbers(x, "class").tolist(), _numbers(x, "variant").tolist())) for x in (left, right))
        for i in range(len(own)):
            apart = np.flatnonzero(groups != group[i])
            near = apart[(other[apart] == own[i]).sum(1) >= least] if len(apart) else apart
            near = near[~(facing[near, :earlier] == bands[i, :earlier]).any(1)]
            if len(near):
                found.add(a[i])
                found.update(b[j] for j in near)
        chosen = np.array(sorted(found), np.int64).reshape(-1, 2)
        bucket = np.full(len(chosen), key[0].as_py(), np.int64)
        return pa.table({"bucket": bucket, "class": chosen[:, 0].copy(), "variant": chosen[:, 1].copy()})

    return compare


def _exact_links(percent: int):
    """Links between groups in a block, of exact common counts; a forest of them."""
    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _pairs(np.empty(0), np.empty(0))
        own, other = (_lists(x.column("shingles")) for x in (left, right))
        common = common_counts(own, other)
        n, m = (np.array([len(s) for s in x]) for x in (own, other))
        group, groups = _numbers(left, "root"), _numbers(right, "root")
        linked = (100 * common >= percent * (n[:, None] + m[None] - common)) & (group[:, None] != groups[None])
        a, b = _numbers(left, "class"), _numbers(right, "class")
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        found = []
        for i, j in zip(*np.nonzero(linked)):
            x, y = root(int(group[i])), root(int(groups[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((min(a[i], b[j]), max(a[i], b[j])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return _pairs(pairs[:, 0], pairs[:, 1])

    return compare


def common_counts(own: list[np.ndarray], other: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of membership matrices over
    the elements that both sides have."""
    out = np.zeros((len(own), len(other)), np.int64)
    elements = np.intersect1d(np.unique(np.concatenate(own)), np.unique(np.concatenate(other)))
    if not len(elements):
        return out
    places = []
    for sets in (own, other):
        flat = np.concatenate(sets)
        at = np.searchsorted(elements, flat)
        at[at == len(elements)] = 0
        have = elements[at] == flat
        rows, at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[have], at[have]
        order = np.argsort(at, kind="stable")
        places.append((rows[order], at[order]))
    for begin in range(0, len(elements), width):
        parts = []
        for sets, (rows, at) in zip((own, other), places):
            low, high = np.searchsorted(at, [begin, begin + width])
            part = np.zeros((len(sets), min(width, len(elements) - begin)), np.float32)
            part[rows[low:high], at[low:high] - begin] = 1
            parts.append(part)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out


def _block_pairs(members: DataFrame, size: int, function, schema: str, weight=None) -> DataFrame:
    """``function`` over all pairs of blocks of ``size`` members of each bucket, or of fewer if they weigh more than
    SETS_SHINGLES together."""
    blocks = F.ceil(F.count("*") / size)
    if weight is not None:
        blocks = F.greatest(blocks, F.ceil(F.sum(weight) / SETS_SHINGLES))
    counts = kept(members.groupBy("bucket").agg(blocks.cast("int").alias("blocks")), "dedup-blocks")
    dealt = members.join(counts, "bucket").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.withColumn("facing", every).where("block <= facing")
    right = dealt.withColumn("facing", F.col("block")).withColumn("block", every).where("block <= facing")
    right = right.toDF(*right.columns)  # columns of its own, for the cogroup with the same table
    key = ["bucket", "block", "facing"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(function, schema)


def _grouped(signed: DataFrame, links: DataFrame) -> DataFrame:
    """class, root: every class with the smallest class it is linked with, itself included."""
    roots = components(links)
    return signed.select("class").join(roots, F.col("class") == F.col("node"), "left").select(
        "class", F.coalesce("root", "class").alias("root"))


def near_duplicates(docs: DataFrame, *, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Documents are linked if their sets have at least ``percent`` hundredths of their union in common.
    """
    least = agreeing(percent)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    passed = kept(
        map_texts(rows, "text", "n_shingles long, set_id binary, bands array<bigint>, signature binary", _signed, ["doc_id"]),
        "dedup-signatures")
    narrow = passed.select("doc_id", "n_shingles", "set_id")
    linkable = F.col("doc_id").isNotNull() & F.col("set_id").isNotNull()
    classes = kept(narrow.where(linkable).groupBy("set_id").agg(F.min("doc_id").alias("class")), "dedup-classes")
    # Where ids repeat, one may stand for several sets; the variant tells these apart.
    repeating = not narrow.where(linkable).groupBy("doc_id").count().where("count > 1").isEmpty()
    variant = (F.xxhash64("set_id") if repeating else F.lit(0).cast("long")).alias("variant")
    signed = kept(
        passed.where(linkable).join(classes.withColumnRenamed("set_id", "_set"), (F.col("set_id") == F.col("_set")) & (F.col("doc_id") == F.col("class")))
        .select("class", variant, "set_id", "bands", "signature").dropDuplicates(["class", "set_id"]),
        "dedup-classes-signed")
    banded = signed.select("class", "variant", F.posexplode("bands").alias("band", "bucket"))
    buckets = kept(
        banded.groupBy("bucket").agg(F.min("class").alias("center"), F.max("class").alias("last"), F.count("*").alias("members"))
        .where("center < last"), "dedup-buckets")
    shared = kept(banded.join(buckets, "bucket").select("bucket", "band", "class", "variant", "center", "members"), "dedup-shared")
    stars = shared.where("class <> center").select(F.col("center").alias("a"), F.col("class").alias("b")).distinct()
    likely = kept(_similar(stars, signed.select("class", "signature"), least), "dedup-likely")
    # Classes that may be needed for verifying: those in any bucket with others.
    wanted = signed.join(shared.select("class").distinct(), "class", "left_semi").select("class", "set_id")

    def full_sets(of: DataFrame, name: str) -> DataFrame:
        ids = of.join(wanted, "class").select("class", F.col("set_id").alias("_set"))
        chosen = rows.join(ids.select("class").distinct(), F.col("doc_id") == F.col("class"), "left_semi")
        chosen = chosen.dropDuplicates(["doc_id", "text"]) if repeating else chosen
        made = map_texts(chosen, "text", "set_id binary, shingles array<bigint>", _sets, ["doc_id"])
        return kept(
            made.join(ids, (F.col("doc_id") == F.col("class")) & (F.col("set_id") == F.col("_set")))
            .select("class", variant.alias("variant"), "shingles"), name)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()

    sets = full_sets(ends(likely), "dedup-sets")
    first = likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = kept(_verified(first, sets, percent), "dedup-links")

    def crossing(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs whose ends are in different groups."""
        a = groups.select(F.col("class").alias("a"), F.col("root").alias("_a"))
        b = groups.select(F.col("class").alias("b"), F.col("root").alias("_b"))
        return pairs.join(a, "a").join(b, "b").where("_a <> _b").select("a", "b")

    groups = kept(_grouped(signed.select("class").distinct(), links), "dedup-groups")
    second = kept(crossing(likely, groups), "dedup-open")
    links = kept(links.unionByName(_verified(second, sets, percent)), "dedup-links")
    groups = kept(_grouped(signed.select("class").distinct(), links), "dedup-groups")

    def open_members() -> DataFrame:
        """bucket, band, class, variant, root of the buckets of three and more that hold several groups."""
        in_groups = shared.where("members > 2").join(groups, "class")
        several = in_groups.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return kept(in_groups.join(several.select("bucket"), "bucket").select("bucket", "band", "class", "variant", "root"), "dedup-open-members")

    members = open_members()
    if not members.isEmpty():
        short = members.join(signed.select("class", "variant", "signature"), ["class", "variant"])
        sized = kept(members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "dedup-blocks")
        stars = (
            short.join(sized, "bucket").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .groupBy("bucket", "block").applyInArrow(_stars(least), "a long, b long").distinct())
        stars = kept(stars.join(likely, ["a", "b"], "left_anti"), "dedup-stars")
        links = kept(links.unionByName(_verified(stars, full_sets(ends(stars), "dedup-sets"), percent)), "dedup-links")
        groups = kept(_grouped(signed.select("class").distinct(), links), "dedup-groups")
        members = open_members()
    if not members.isEmpty():
        short = members.join(signed.select("class", "variant", "signature", "bands"), ["class", "variant"])
        chosen = kept(_block_pairs(short, BLOCK, _likely_members(least), "bucket long, class long, variant long").distinct(), "dedup-chosen")
        sets = full_sets(chosen.select("class").distinct(), "dedup-sets")
        whole = chosen.join(members, ["bucket", "class", "variant"]).join(sets, ["class", "variant"])
        links = kept(links.unionByName(
            _block_pairs(whole, SETS_BLOCK, _exact_links(percent), "a long, b long", F.size("shingles")).distinct()), "dedup-links")
    # Rows of one id with different sets link the classes of these sets.
    member = narrow.where(linkable).join(classes, "set_id").select("doc_id", "class", "n_shingles")
    repeated = member.groupBy("doc_id").agg(F.min("class").alias("a"), F.collect_set("class").alias("all")).where(F.size("all") > 1)
    links = links.unionByName(repeated.select("a", F.explode("all").alias("b")).where("a <> b"))
    groups = kept(_grouped(classes.select("class").distinct(), links), "dedup-groups")
    found = narrow.join(classes, "set_id", "left").join(groups, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, *, percent: int = 85) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id.

    All columns are returned as they are. Of rows that repeat the id that is kept, the one with the least hash of all its
    columns stays; rows without an id all stay.
    """
    found = kept(near_duplicates(docs, percent=percent), "dedup-result")
    gone = kept(found.where(~F.col("kept")).select("doc_id").distinct(), "dedup-gone")
    stay = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return stay
    row = F.struct(*[F.col(c) for c in stay.columns])
    one = stay.where("doc_id is not null").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_row"))
    return one.select("_row.*").unionByName(stay.where("doc_id is null"))
