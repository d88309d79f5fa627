"""Secret scan: keyword automaton, anchored patterns at its hits, checksums.

One pass of an Aho-Corasick automaton over the text finds the keywords of all kinds that
have one. Only at a hit an anchored pattern is tried, in order of position, and not within the
match before it, which gives the same matches as a search of the whole text with the
pattern. Tokens of kinds with a checksum inside count only if it is right. Runs of
hexadecimal digits have no keyword; they are found by a scan for 16 such digits in a row.

Fixed values: the base patterns and least lengths, and the published form of checksummed
tokens (a prefix, thirty base-62 characters, and the CRC-32 of these thirty as six base-62
digits, most significant first, digits before capitals before small letters).

Defined cases. A null text is empty and has no spans. Letters of keywords are ASCII, in
either case. Offsets are code points of the whole text, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_texts, unused

# Patterns, least lengths and kinds in their order.
ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
CHECKED = r"[A-Za-z0-9]{36}(?![A-Za-z0-9])"
LEAST = {"assign": 12, "access": 18}
KINDS = ("assign", "access", "hex", "checked")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked",
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN, _ACCESS, _HEX, _CHECKED = (re.compile(p) for p in (ASSIGN, ACCESS, HEX, CHECKED))
_DIGIT = {c: i for i, c in enumerate(BASE62)}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        machine.add_word(word, (len(word), kind))
    machine.make_automaton()
    return machine


def ascii_lower(text: str) -> str:
    """A-Z to a-z and nothing else, so that offsets stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def checksum_holds(body: str) -> bool:
    """Whether the last six of 36 characters are the checksum of the first thirty."""
    value = 0
    for c in body[30:]:
        value = value * 62 + _DIGIT[c]
    return value == zlib.crc32(body[:30].encode())


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then kind as listed."""
    if not text:
        return []
    found = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    free = {"assign": 0, "access": 0, "checked": 0}
    for last, (length, kind) in _automaton().iter(ascii_lower(text)):
        start = last + 1 - length
        if start < free[kind]:
            continue
        if kind == "assign":
            m = _ASSIGN.match(text, start)
            if m:
                free[kind] = m.end()
                if m.end(1) - m.start(1) >= LEAST[kind]:
                    found.append((start, m.end(), kind))
        elif kind == "access":
            m = _ACCESS.match(text, start)
            if m:
                free[kind] = m.end()
                if m.end() - start >= LEAST[kind]:
                    found.append((start, m.end(), kind))
        else:
            m = _CHECKED.match(text, last + 1)
            if m and text[start:last + 1].islower() and checksum_holds(m.group()):
                free[kind] = m.end()
                found.append((start, m.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(found: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def _report() -> dict:
    def work(texts: list) -> dict:
        found = [spans(t) for t in texts]
        base = [[s for s in f if s[2] != "checked"] for f in found]
        return {
            **{f"n_{kind}": [sum(s[2] == kind for s in f) for f in found] for kind in KINDS},
            "base_sha256": [hashlib.sha256(_joined(f).encode()).hexdigest() for f in base],
            "spans": [_joined(f) for f in found],
        }

    return work


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, a count for each kind, base_sha256 (of the spans that are not checked tokens) and
    spans as text; one row a document."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_texts(rows, "text", f"{counts}, base_sha256 string, spans string", _report, ["doc_id"])


def redact(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every secret, or run of overlapping ones, replaced by the mark."""
    parts, done = [], 0
    merged: list[list[int]] = []
    for start, end, _ in spans(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    if not merged:
        return text
    for start, end in merged:
        parts += [text[done:start], mark]
        done = end
    return "".join([*parts, text[done:]])


def redacted(docs: DataFrame, *, mark: str = "[secret]") -> DataFrame:
    """The documents with their secrets replaced; n_chars, if there, follows. All rows stay."""
    new = unused(docs.columns, "text")

    def start():
        return lambda texts: {new: [redact(t, mark) for t in texts]}

    made = map_texts(docs, "text", f"{new} string", start, [c for c in docs.columns if c != "text"])
    changed = {"text": F.col(new), "n_chars": F.length(new).cast("long")}
    return made.select(*[changed[c].alias(c) if c in changed else c for c in docs.columns])
