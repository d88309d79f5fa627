"""Personal data and the terms that give it away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers, found in one scan for ``@``, one for
runs of digits and one for ``+``, in time linear in the text whatever it holds, with the
matches of a leftmost search for each pattern.

Information-theoretic sanitisation. The values found are the protected entities. How strongly a term reveals an
entity is estimated from the corpus: the pointwise mutual information of term and entity, over
documents, as a share of the entity's information content,

    disclosure(t, e) = log2(p(t, e) / (p(t) p(e))) / -log2(p(e)),

which is 1 where every document with the term has the entity and 0 where the two are independent. In a document
that holds an entity, terms whose disclosure of it reaches the threshold are spans as well:
generalised to their shape (word, number, code), if that shape itself stays below the threshold, else removed. Entities and pairs need
``support`` documents at least; below that nothing is estimated.

At scale. Terms of documents without an entity are counted only, and only those that some entity's documents
hold: a Bloom filter of a fixed size tells the tasks, a join does so exactly. Counts are added up in each task
before rows are shuffled. Entities with the same documents are one class, and so are
terms with the same documents (told by two 64-bit sums over the documents' numbers): a list of addresses
in thousands of copies is one class and not the square of its length. Pairs of classes are formed
only for terms whose share of documents with any entity could reach the threshold.

Defined cases. A null or empty text has no spans. Offsets are code points of the whole text, end exclusive. Terms
are runs of three or more letters, digits or underscores in lower case, outside base spans. Repeated rows and null ids
are documents of their own. An entity of all documents is revealed by none. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import release, slices, unused
from .scratch import kept

# Kinds in their order, characters and patterns of the base spans, least and most digits.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)

THRESHOLD = 0.95
SUPPORT = 3
FLUSHED = 100_000  # distinct terms that a task counts before it drops those that are not wanted, and of wanted ones before it hands them on
FILTER_BITS = 1 << 22
FILTER_SHIFTS = (0, 20, 40)

_DOMAIN, _PHONE, _DIGITS = re.compile(DOMAIN), re.compile(PHONE), re.compile("[0-9]+")
_OTHER = re.compile("[^0-9]")
_TERM = re.compile(r"\w{3,}")
SHAPE = "~"
SHOWN = {"~a": "[word]", "~9": "[number]"}


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(int(d) * 2 - 9 * (d > "4") for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        # What stands before the sign, back to the last match or sign.
        before = text[free:at]
        start = free + len(before.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _numbers(text: str) -> tuple[list, list]:
    """IP addresses and card numbers, from the runs of digits and what stands between them."""
    runs = [m.span() for m in _DIGITS.finditer(text)]
    ips, cards = [], []
    at = 0
    while at + 3 < len(runs):
        four = runs[at:at + 4]
        if all(b[0] - a[1] == 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            if all(_small(text[a:b]) for a, b in four):
                ips.append((four[0][0], four[3][1]))
            at += 4
        else:
            at += 1
    at = 0
    while at < len(runs):
        last = at
        while last + 1 < len(runs) and runs[last + 1][0] - runs[last][1] == 1 and text[runs[last][1]] in " -":
            last += 1
        digits = sum(b - a for a, b in runs[at:last + 1])
        if CARD_DIGITS[0] <= digits <= CARD_DIGITS[1]:
            start, end = runs[at][0], runs[last][1]
            if luhn(_OTHER.sub("", text[start:end])):
                cards.append((start, end))
        at = last + 1
    return ips, cards


def _phones(text: str) -> list[tuple[int, int]]:
    spans = [m.span() for m in _PHONE.finditer(text)]
    return [(a, b) for a, b in spans if PHONE_DIGITS[0] <= len(_OTHER.sub("", text[a:b])) <= PHONE_DIGITS[1]]


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as listed, then start."""
    if not text:
        return []
    ips, cards = _numbers(text)
    by_kind = (_emails(text), ips, cards, _phones(text) if "+" in text else [])
    return [(kind, a, b) for kind, spans in zip(KINDS, by_kind) for a, b in spans]


def entity(kind: str, value: str) -> str:
    """The value however it is written."""
    if kind == "email":
        return f"email:{value.lower()}"
    if kind == "ip":
        return "ip:" + ".".join(part.lstrip("0") or "0" for part in value.split("."))
    return f"{kind}:{_OTHER.sub('', value)}"


def shape(term: str) -> str:
    """Letters as a, digits as 9, runs as one."""
    if term.isalpha():
        return SHAPE + "a"
    if term.isdigit():
        return SHAPE + "9"
    marks = ["9" if c.isdigit() else "_" if c == "_" else "a" for c in term]
    return SHAPE + "".join(m for i, m in enumerate(marks) if i == 0 or marks[i - 1] != m)


def blanked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with spaces in place of the spans."""
    parts, done = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if b > done:
            parts += [text[done:max(a, done)], " " * (b - max(a, done))]
            done = b
    return "".join([*parts, text[done:]])


def term_places(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Every term with its shape and its places: start, end, start, end, ..."""
    places: dict[str, list[int]] = {}
    for m in _TERM.finditer(blanked(text, spans)):
        places.setdefault(m.group().lower(), []).extend(m.span())
    return [{"term": term, "shape": shape(term), "at": at} for term, at in places.items()]


def _joined(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


_SCANNED = (
    "row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "entities array<string>, terms array<struct<term:string,shape:string,at:array<int>>>")


def scanned(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every document, its columns ``keep`` (all) as the struct ``doc``, with its base spans; entities and terms with their
    places where it has any."""
    rows = docs.select(F.struct(*(docs[c] for c in keep or docs.columns)).alias("doc"), docs[text].alias("text"))

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for part in slices(whole, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [base_spans(t) for t in texts]
                base = [_joined(spans) for spans in found]
                entities = [sorted({entity(kind, t[a:b]) for kind, a, b in spans}) for t, spans in zip(texts, found)]
                terms = [term_places(t, spans) if spans else [] for t, spans in zip(texts, found)]
                kinds = [Counter(kind for kind, _, _ in spans) for spans in found]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc"), pa.array(range(row, row + len(texts)), pa.int64()),
                    *[pa.array([k[kind] for k in kinds], pa.int64()) for kind in KINDS],
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]), pa.array(base),
                    pa.array(entities, pa.list_(pa.string())),
                    pa.array(terms, pa.list_(pa.struct([("term", pa.string()), ("shape", pa.string()), ("at", pa.list_(pa.int32()))]))),
                ], names=["doc", *[p.split()[0] for p in _SCANNED.split(", ")]])
                row += len(texts)
        whole = part = texts = found = terms = None
        release()

    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, {_SCANNED}")


def _positions(term: Column) -> Column:
    hashed = F.xxhash64(term)
    return F.array(*[F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(FILTER_BITS - 1)) for shift in FILTER_SHIFTS])


def term_filter(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of the terms: FILTER_BITS bits however many terms, put together by aggregation."""
    places = terms.select(F.explode(_positions(F.col("term"))).alias("at"))
    words = places.groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 31 AS INT))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for word, bits in words.collect():  # at most FILTER_BITS / 32 rows
        out[word] = bits
    return out


def passed(terms: list[str], bits: np.ndarray) -> np.ndarray:
    """Which terms the filter holds; of others about one in a thousand while it is a tenth full."""
    hashed = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
    held = np.ones(len(terms), bool)
    for shift in FILTER_SHIFTS:
        at = (hashed >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1)
        held &= (bits[at >> np.uint64(5)] >> (at & np.uint64(31)).astype(np.uint32)) & 1 == 1
    return held


def term_counts(docs: DataFrame, wanted: np.ndarray, text: str = "text") -> DataFrame:
    """(term, documents) of parts of the corpus, for the terms that the filter ``wanted`` holds: a term comes once a
    task, more often only where a task has very many."""

    def run(batches):
        counts: Counter = Counter()
        limit = FLUSHED

        def keep_wanted() -> None:
            terms = list(counts)
            for term, held in zip(terms, passed(terms, wanted).tolist()):
                if not held:
                    del counts[term]

        def handed():
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "documents"])
            counts.clear()
            return made

        for whole in batches:
            for part in slices(whole, "text"):
                for t in part.column("text").to_pylist():
                    if t:
                        terms = set(map(str.lower, set(_TERM.findall(blanked(t, base_spans(t))))))
                        counts.update(terms | set(map(shape, terms)))
                if len(counts) > limit:
                    keep_wanted()
                    if len(counts) > FLUSHED:  # very many wanted ones: what they are is handed on
                        yield handed()
                    limit = len(counts) + FLUSHED
        keep_wanted()
        if counts:
            yield handed()
        whole = part = None
        release()

    return docs.select(docs[text].alias("text")).mapInArrow(run, "term string, documents long")


def _class(*parts: str) -> list[Column]:
    """What tells the set of documents: their number and two sums over them."""
    return [F.count(F.lit(1)).alias("held"), *[F.bit_xor(F.xxhash64("row", F.lit(i))).alias(p) for i, p in enumerate(parts)]]


def disclosing(held: DataFrame, docs: DataFrame, text: str, threshold: float, support: int) -> DataFrame | None:
    """(row, term): the terms of a document that give away an entity that it holds. None where nothing can."""
    n = held.count()
    marked = held.where(F.size("entities") > 0)
    of_entity = marked.select("row", F.explode("entities").alias("entity"))
    entities = kept(of_entity.groupBy("entity").agg(*_class("e0", "e1")).where(
        (F.col("held") >= support) & (F.col("held") < n)).withColumnRenamed("held", "e_docs"), "pii-entities")
    if entities.isEmpty():
        return None
    of_entity = kept(of_entity.join(entities, "entity").select("row", "e_docs", "e0", "e1").distinct(), "pii-entity-classes")
    both = F.concat("terms.term", F.array_distinct("terms.shape"))
    # A pair of term and entity lies within the documents that hold an entity with enough documents.
    of_term = marked.join(of_entity.select("row").distinct(), "row", "left_semi").select("row", F.explode(both).alias("term"))
    candidates = kept(of_term.groupBy("term").agg(*_class("t0", "t1")).where(F.col("held") >= support), "pii-candidates")
    counted = term_counts(docs, term_filter(candidates.select("term")), text).join(candidates.select("term"), "term", "left_semi").groupBy("term").agg(
        F.sum("documents").alias("t_docs"))
    least = (support / n) ** (1 - threshold) * (1 - 1e-9)  # the lowest p(e | t) that can reach the threshold
    terms = kept(
        candidates.join(counted, "term").where(F.col("held") >= F.col("t_docs") * F.lit(least)).drop("held"), "pii-terms")
    term_class, entity_class = ["t_docs", "t0", "t1"], ["e_docs", "e0", "e1"]
    of_term = kept(of_term.join(terms, "term"), "pii-term-classes")
    classes = of_term.select("row", *term_class).distinct()
    pairs = classes.join(of_entity, "row").groupBy(*term_class, *entity_class).agg(F.count(F.lit(1)).alias("both"))
    information = -F.log2(F.col("e_docs") / F.lit(float(n)))
    gained = F.log2(F.col("both") * F.lit(float(n)) / (F.col("t_docs").cast("double") * F.col("e_docs")))
    telling = kept(
        pairs.where((F.col("both") >= support) & (gained >= information * F.lit(threshold - 1e-12))).select(
            *term_class, *entity_class), "pii-telling")
    told = classes.join(telling, term_class).join(of_entity, ["row", *entity_class], "left_semi").select("row", *term_class).distinct()
    return kept(of_term.join(told, ["row", *term_class], "left_semi").select("row", "term"), "pii-told")


def personal_data(
    docs: DataFrame, *, text: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT, keep: list[str] | None = None,
) -> DataFrame:
    """doc (the document's columns ``keep``, or all, as a struct), n_email, n_ip, n_card, n_phone, base_sha256, base, and added:
    array<struct<start,end,kind>> of the terms to be generalised (``general``) or removed (``removed``), by start."""
    held = kept(scanned(docs, text, keep), "pii-scanned")
    told = disclosing(held, docs, text, threshold, support)
    added = "array<struct<start:int,end:int,kind:string>>"
    narrow = ["doc", *[f"n_{k}" for k in KINDS], "base_sha256", "base"]
    if told is None:
        return held.select(*narrow, F.array().cast(added).alias("added"))
    # What is told of a document is no more than its terms.
    lists = told.groupBy("row").agg(F.collect_set("term").alias("told"))
    chosen = F.filter("terms", lambda t: F.array_contains("told", t["term"]))
    spans = F.array_sort(F.flatten(F.transform(chosen, _places)))
    return held.join(lists, "row", "left").select(*narrow, F.coalesce(spans, F.array().cast(added)).alias("added"))


def _places(entry: Column) -> Column:
    """The places of a term; its shape stands for it unless the shape tells as much."""
    kind = F.when(F.array_contains("told", entry["shape"]), "removed").otherwise("general")
    return F.transform(
        F.sequence(F.lit(0), F.size(entry["at"]) - 2, F.lit(2)),
        lambda i: F.struct(F.get(entry["at"], i).alias("start"), F.get(entry["at"], i + 1).alias("end"), kind.alias("kind")))


def listed_spans(found: DataFrame) -> Column:
    """All spans as text: the base spans, then the added ones by start."""
    shown = F.transform("added", lambda a: F.concat_ws(":", a["kind"], a["start"].cast("string"), a["end"].cast("string")))
    return F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("added") > 0, F.array_join(shown, ",")))


def cleaned(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with base spans as their kind, generalised terms as their shape and without removed ones. Of overlapping
    spans the first stands for all."""
    parts, done = [], 0
    for a, b, kind in sorted((a, b, kind) for kind, a, b in spans):
        if a >= done:
            mark = "" if kind == "removed" else f"[{kind}]" if kind in KINDS else SHOWN.get(shape(text[a:b]), "[code]")
            parts += [text[done:a], mark]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def sanitized(docs: DataFrame, *, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """The documents with personal data and telling terms replaced; n_chars, if there, follows. All rows stay."""
    found = personal_data(docs, threshold=threshold, support=support)
    new = unused(docs.columns, "text")

    def run(batches):
        for batch in batches:
            base, added, made = batch.column("base").to_pylist(), batch.column("added").to_pylist(), []
            for t, b, more in zip(batch.column("text").to_pylist(), base, added):
                spans = [(kind, int(start), int(end)) for kind, start, end in (s.split(":") for s in b.split(",") if s)]
                spans += [(m["kind"], m["start"], m["end"]) for m in more]
                made.append(t if not spans else cleaned(t, spans))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(made, pa.string())], names=["doc", new])

    rows = found.select("doc", F.col("doc.text").alias("text"), "base", "added")
    kind = found.schema["doc"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc {kind}, `{new}` string")
    changed = {"text": F.col(new), "n_chars": F.length(new).cast("long")}
    return made.select(*[(changed[c] if c in changed else F.col("doc")[c]).alias(c) for c in docs.columns])
