"""Byte-pair encoding compiled to a deterministic transducer that emits token counts.

In byte-pair encoding the tokens of a prefix are a prefix of valid adjacent pairs, so the last
token of every prefix fixes the whole encoding. After a byte the new last token is the longest
vocabulary entry that ends here and forms a valid pair with the last token before its start.
What the next bytes can ask for is bounded: the longest suffix that still begins some entry,
and the last tokens at the positions inside it. That is the state. A transition carries the
change in the number of tokens (it can be negative, when a merge joins tokens).

States are compiled when first reached and kept, up to a limit, per worker process.
"""

from __future__ import annotations

import json
from functools import cache

#: Bytes that the vocabulary file writes as themselves; others are shifted to 256+.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[str, int]:
    """Vocabulary letter to byte."""
    rest = [b for b in range(256) if b not in set(_PLAIN)]
    return {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(rest)}


class CountTransducer:
    #: Compiled moves and remembered pair tests, each, before a worker starts anew.
    MOST = 450_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        spell = lambda token: bytes(letters[c] for c in token)
        special = {t for t in model["vocab"] if any(c not in letters for c in t)}
        self._entry = {spell(t): i for t, i in model["vocab"].items() if t not in special}
        self._bytes = {i: t for t, i in self._entry.items()}
        self._merge = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            left, right = spell(left), spell(right)
            self._merge[self._entry[left], self._entry[right]] = rank, self._entry[left + right]
        self._begins = {t[:k] for t in self._entry for k in range(len(t))}
        self._whole: dict[bytes, bool] = {}
        self._pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._number, self._content, self._next = {}, [], {}
        self._state((b"", (None,), (0,)))

    def _state(self, key: tuple) -> int:
        if key not in self._number:
            self._number[key] = len(self._content)
            self._content.append(key)
        return self._number[key]

    def merged(self, text: bytes) -> list[int]:
        """Encoding by its definition: the best-ranked adjacent pair is merged until none is."""
        tokens = [self._entry[text[i:i + 1]] for i in range(len(text))]
        while True:
            found = [(m, i) for i in range(len(tokens) - 1)
                     if (m := self._merge.get((tokens[i], tokens[i + 1])))]
            if not found:
                return tokens
            (_, joined), i = min(found)
            tokens[i:i + 2] = [joined]

    def _fits(self, before: int | None, token: bytes) -> bool:
        if before is None:
            if token not in self._whole:
                self._whole[token] = len(self.merged(token)) == 1
            return self._whole[token]
        after = self._entry[token]
        pair = before << 32 | after
        if pair not in self._pairs:
            self._pairs[pair] = self.merged(self._bytes[before] + token) == [before, after]
        return self._pairs[pair]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        suffix, lasts, counts = self._content[state]
        suffix += bytes((byte,))
        k = next(k for k in range(len(suffix))
                 if suffix[k:] in self._entry and self._fits(lasts[k], suffix[k:]))
        emitted = counts[k] + 1
        last = self._entry[suffix[k:]]
        keep = next(k for k in range(len(suffix) + 1) if suffix[k:] in self._begins)
        target = (suffix[keep:], (*lasts, last)[keep:],
                  (*(c - emitted for c in counts), 0)[keep:])
        return self._state(target), emitted

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: the sum of what its transitions emit."""
        if len(self._next) > self.MOST:
            self._reset()
        if max(len(self._pairs), len(self._whole)) > self.MOST:
            self._pairs.clear()
            self._whole.clear()
        total, state, known = 0, 0, self._next
        for byte in piece:
            move = known.get(state << 8 | byte)
            if move is None:
                target, emitted = self._compile(state, byte)
                move = known[state << 8 | byte] = target << 16 | emitted + 0x8000
            state = move >> 16
            total += (move & 0xFFFF) - 0x8000
        return total

    def counts(self, pieces: list[bytes]) -> list[int]:
        return [self.count(p) for p in pieces]


@cache
def transducer(path: str) -> CountTransducer:
    return CountTransducer(path)
