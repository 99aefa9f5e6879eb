"""Secret scanning by one combined automaton over the bytes of whole texts.

The rules (three base kinds and three more) are compiled by subset construction and minimisation
into transition arrays; one pass marks where each rule's matches end. A match's begin is then
found by the rule's reversed automaton, walking back from the end, so that spans come out
leftmost and without overlaps per kind, as a regular-expression search gives them. Kinds with a
minimum length drop shorter matches afterwards.

Defined results: a NULL or empty text has no spans (and the digest of the empty string);
positions are code points, end exclusive; letters of the assignment keywords match in either
ASCII case; repeated rows are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridcensus.llm import arrow_text
from gridcensus.llm.automaton import (STOP, Automaton, alt, at_least, many, masks_of, maybe, one,
                                      seq, some, span, text)
from gridcensus.session import ship_package

ALNUM = span("AZ", "az", "09")
VALUE = ALNUM + "+/_.=-"
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_QUOTE, _BLANKS = maybe(one("\"'")), many(one(" "))
_PARAM = some(one(ALNUM + "_-"))
#: kind: (rule, least length of the whole match in bytes, least length of an assigned value)
KINDS = {
    "assign": (seq(alt(*(text(w, any_case=True) for w in _WORDS)), _QUOTE, _BLANKS, one(":="),
                   _BLANKS, _QUOTE, some(one(VALUE))), 0, 6),
    "access": (seq(text("AKIA"), some(one(span("AZ", "09")))), 20, 0),
    "hex": (at_least(24, one(span("09", "af"))), 24, 0),
    "private_key": (seq(text("-----BEGIN "), maybe(seq(
        alt(*map(text, ("RSA", "EC", "DSA", "OPENSSH", "ENCRYPTED"))), one(" "))),
        text("PRIVATE KEY-----")), 0, 0),
    "hosting_token": (seq(text("gh"), one("pousr"), one("_"), some(one(ALNUM))), 40, 0),
    "web_token": (seq(text("eyJ"), _PARAM, one("."), text("eyJ"), _PARAM, one("."), _PARAM), 40, 0),
}
BASE = ("assign", "access", "hex")


@cache
def combined() -> Automaton:
    return Automaton([rule for rule, _, _ in KINDS.values()], anchored=False)


@cache
def backwards(kind: str) -> Automaton:
    return Automaton([KINDS[kind][0].reversed()], anchored=True)


def _begin(kind: str, data: bytes, low: int, end: int) -> int | None:
    """Leftmost position from ``low`` on where a match of ``kind`` that ends at ``end`` begins."""
    automaton = backwards(kind)
    step, group, mask, width = automaton.step, automaton.group, automaton.mask, automaton.width
    state, dead, found = automaton.start * width, automaton.dead * width, None
    for at in range(end - 1, low - 1, -1):
        state = step[state + group[data[at]]]
        if state == dead:
            break
        if mask[state // width]:
            found = at
    return found



def _assigned(match: bytes) -> int:
    """Length of the value: what follows the first sign, blanks and quote."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1
    while match[at:at + 1] == b" ":
        at += 1
    return len(match) - at - (match[at:at + 1] in (b'"', b"'"))


def spans_of(data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(begin, kind number, end) of every span of each text of a slice, in code points."""
    texts = len(offsets) - 1
    parted = np.insert(data, offsets[1:], STOP)
    marked = masks_of(combined(), parted)
    found: list[list] = [[] for _ in range(texts)]
    if not marked.any():
        return found
    whole = parted.tobytes()
    limits = offsets[1:] + np.arange(texts)  # where each text's STOP is
    points = np.append(0, np.cumsum((parted & 0xC0) != 0x80))
    for number, (kind, (_, least, least_value)) in enumerate(KINDS.items()):
        on = (marked >> number) & 1
        ends = np.flatnonzero(on[:-1] > on[1:]) + 1
        owners = np.searchsorted(limits, ends - 1, "left")
        past = 0
        for end, owner in zip(ends.tolist(), owners.tolist()):
            first = int(limits[owner - 1]) + 1 if owner else 0
            begin = _begin(kind, whole, max(first, past), end)
            if begin is None:
                continue
            past = end
            if end - begin < least or least_value and _assigned(whole[begin:end]) < least_value:
                continue
            zero = points[first]
            found[owner].append((int(points[begin] - zero), number, int(points[end] - zero)))
    for spans in found:
        spans.sort()
    return found


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, digest of the base spans, and
    all spans as ``kind:start:end``, by start, then in the order of ``KINDS``."""
    ship_package(docs.sparkSession)
    picked = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    kind = dict(picked.dtypes)["doc_id"]
    names = list(KINDS)

    def joined(spans) -> str:
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)

    def run(batches):
        for batch in batches:
            data, offsets = arrow_text.flat_text(batch.column("text"))
            spans = [s for _, _, part, at in arrow_text.slices(data, offsets)
                     for s in spans_of(part, at)]
            counts = [[sum(k == number for _, k, _ in s) for s in spans] for number in range(3)]
            base = [joined(x for x in s if x[1] < len(BASE)) for s in spans]
            yield pa.record_batch({"doc_id": batch.column("doc_id")} | {
                f"n_{name}": pa.array(c, pa.int64()) for name, c in zip(BASE, counts)} | {
                "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base],
                                        pa.string()),
                "spans": pa.array([joined(s) for s in spans], pa.string())})

    return picked.mapInArrow(run, f"doc_id {kind}, n_assign bigint, n_access bigint, "
                                  "n_hex bigint, base_sha256 string, spans string")
