"""Pre-tokenisers of public byte-pair vocabularies as transducers over character classes.

Each writes, per character, which pieces begin: bit 1 at this character, bit 2 at the one
before (known only now, as with the last blank of a run). Texts are separated by an END symbol.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

from gridcensus.llm.chunk_scan import Transducer

LETTER, NUMBER, SPACE, BLANK, OTHER, APOSTROPHE, ONE, TWO_E, E, L, END = range(11)
LETTERS = (LETTER, ONE, TWO_E, E, L)
#: Characters with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
               0x2029, 0x202F, 0x205F, 0x3000]
#: Endings that stand alone after an apostrophe are s t m d, re ve, ll.
ENDINGS = {ONE: "stmd", TWO_E: "rv", E: "e", L: "l"}


@cache
def character_classes() -> np.ndarray:
    """Class of every code point; index 0x110000 is END."""
    table = np.full(sys.maxunicode + 2, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[WHITE_SPACE] = BLANK
    table[ord(" ")] = SPACE
    table[ord("'")] = APOSTROPHE
    for group, letters in ENDINGS.items():
        table[[ord(c) for c in letters]] = group
    table[-1] = END
    return table


START, WORD, DIGITS, SIGNS, SPACE1, BLANK1, SPACES, BLANKS, QUOTE, QUOTE_R, QUOTE_L, CLOSED = range(12)


def _enter(symbol: int) -> int:
    """State after the first character of a new piece."""
    if symbol in LETTERS:
        return WORD
    return {NUMBER: DIGITS, OTHER: SIGNS, APOSTROPHE: QUOTE, SPACE: SPACE1, BLANK: BLANK1,
            END: START}[symbol]


def _tables(rules) -> tuple[np.ndarray, np.ndarray]:
    step, output = np.zeros((12, 11), np.uint16), np.zeros((12, 11), np.uint8)
    for state in range(12):
        for symbol in range(11):
            step[state, symbol], output[state, symbol] = rules(state, symbol)
    return step, output


def _ending(state: int, symbol: int) -> tuple[int, int] | None:
    """What follows an apostrophe that begins a piece: 's, 't, 'm, 'd, 're, 've, 'll or none."""
    if state == QUOTE and symbol in (ONE, TWO_E, L):
        return {ONE: CLOSED, TWO_E: QUOTE_R, L: QUOTE_L}[symbol], 0
    if state == QUOTE and symbol in (OTHER, APOSTROPHE):
        return SIGNS, 0
    if (state, symbol) in ((QUOTE_R, E), (QUOTE_L, L)):
        return CLOSED, 0
    if state in (QUOTE_R, QUOTE_L):  # the letter after the apostrophe began a word
        return (WORD, 2) if symbol in LETTERS else (_enter(symbol), 3)
    return None


def _spaced_rules(state: int, symbol: int) -> tuple[int, int]:
    """A space joins the piece after it; longer runs of blanks give up their last one."""
    fresh = _enter(symbol), 1
    found = _ending(state, symbol)
    if found:
        return found
    joined = {NUMBER: DIGITS, OTHER: SIGNS, APOSTROPHE: SIGNS} | dict.fromkeys(LETTERS, WORD)
    if state == WORD and symbol in LETTERS or state == DIGITS and symbol == NUMBER:
        return state, 0
    if state == SIGNS and symbol in (OTHER, APOSTROPHE):
        return SIGNS, 0
    if state in (SPACE1, BLANK1, SPACES, BLANKS):
        if symbol in (SPACE, BLANK):
            return (SPACES if symbol == SPACE else BLANKS), 0
        if symbol == END or state == BLANK1:
            return fresh
        if state == BLANKS:
            return _enter(symbol), 3
        return joined[symbol], 0 if state == SPACE1 else 2
    return fresh


def _bare_rules(state: int, symbol: int) -> tuple[int, int]:
    """Words, single digits and runs of signs; blanks only separate."""
    found = _ending(state, symbol)
    if found:
        return found
    if state == WORD and symbol in LETTERS:
        return WORD, 0
    if state == SIGNS and symbol in (OTHER, APOSTROPHE):
        return SIGNS, 0
    return _enter(symbol), 1


@cache
def spaced() -> Transducer:
    return Transducer(*_tables(_spaced_rules), START, END)


@cache
def bare() -> Transducer:
    return Transducer(*_tables(_bare_rules), START, END)


def pieces(points: np.ndarray, ends: np.ndarray, transducer: Transducer,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of several texts as (first, end) character positions, text number and class.

    ``ends`` are the texts' end positions in ``points``. The class is that of the piece's first
    character.
    """
    texts, n = len(ends), len(points)
    symbols = np.insert(character_classes()[points], ends, END)
    written = transducer.run(symbols)
    begins = (written & 1).astype(bool)
    begins[:-1] |= (written[1:] & 2).astype(bool)
    at = np.flatnonzero(begins)
    after = np.append(at[1:], n + texts)
    real = symbols[at] != END
    at, after = at[real], after[real]
    text = np.searchsorted(ends + np.arange(texts), at, "right")
    return at - text, after - text, text, symbols[at]
