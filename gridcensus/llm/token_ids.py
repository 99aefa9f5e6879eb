"""Token ids of whole texts under a word-level byte-pair vocabulary, many texts at a time.

Words are found by the ``bare`` transducer after the vocabulary's own normalisation, each
distinct word is encoded once by the public library, and a document's ids are gathered from
those. Texts with characters outside a long-settled range, or with a special token's string,
are given whole to the library.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import cache

import numpy as np

from gridcensus.llm import arrow_text, word_split
from gridcensus.llm.piece_table import PieceValues

#: Characters whose class and lower case are alike in all Unicode versions in use: Latin, Greek,
#: Cyrillic, general punctuation, kana and the first block of Han.
SETTLED = ((0x00, 0x250), (0x390, 0x3CF), (0x410, 0x450), (0x2010, 0x2028), (0x3041, 0x3097),
           (0x30A1, 0x30FB), (0x4E00, 0x9FA6))
UNSETTLED = (0x130, 0x3A2, 0x3A3)  # a capital of two lower-case letters, unassigned, sigma


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _settled() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for low, high in SETTLED:
        table[low:high] = True
    table[list(UNSETTLED)] = False
    return table


def _word_encoder(path: str):
    """The vocabulary's merges alone, for words that are normalised and split already."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = spec["added_tokens"]
    bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                  "use_regex": False}
    spec |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {
        "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, bytes_only]}}
    special = [t["content"].encode() for t in added]
    suffix = spec["model"]["end_of_word_suffix"]
    closes = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
    closes[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
    encoder = Tokenizer.from_str(json.dumps(spec))
    encoder.model._resize_cache(0)
    return encoder, closes, special


class WordIds:
    """Ids of words, kept flat: a word's value is where its ids begin and how many they are."""

    def __init__(self, path: str, most: int = 250_000):
        self._path = path
        self._encoder, self._closes, self._special = _word_encoder(path)
        self._words = PieceValues(self._encode, most, self._clear)
        self._clear()

    def _clear(self) -> None:
        self._pool, self._used = np.empty(1 << 16, np.uint32), 0

    def _encode(self, words: list[bytes]) -> list[int]:
        """Many words to a call; a word's last id is one that closes words."""
        texts = [b" ".join(words[i:i + 200]).decode() for i in range(0, len(words), 200)]
        found = self._encoder.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        end = np.flatnonzero(self._closes[ids]) + 1
        if len(end) != len(words):
            raise ValueError("the vocabulary does not close each word with one id")
        begin = np.append(0, end[:-1])
        while self._used + len(ids) > len(self._pool):
            self._pool = np.concatenate([self._pool, np.empty_like(self._pool)])
        self._pool[self._used:self._used + len(ids)] = ids
        values = ((begin + self._used) << 24) | (end - begin)
        self._used += len(ids)
        return values.tolist()

    def _fast(self, data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of each text; all are settled and free of special strings.

        ``ends`` are 0 and the texts' end positions in characters; lower case keeps them.
        """
        lower = data.tobytes().decode().lower().encode()
        data = np.frombuffer(lower, np.uint8)
        points, byte_at = arrow_text.code_points(data)
        first, end, text, kind = word_split.pieces(points, ends[1:], word_split.bare())
        real = (kind != word_split.SPACE) & (kind != word_split.BLANK)
        first, end, text = first[real], end[real], text[real]
        byte_at = np.append(byte_at, len(data))
        values, which = self._words.of(data, byte_at[first], byte_at[end])
        begin, length = (values >> 24)[which], (values & 0xFFFFFF)[which]
        total = np.append(0, np.cumsum(length))
        ids = self._pool[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        cut = total[np.searchsorted(text, np.arange(len(ends)))]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def of(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a slice of UTF-8 bytes."""
        whole = data.tobytes()
        points, byte_at = arrow_text.code_points(data)
        odd = ~_settled()[points]
        ends = np.searchsorted(byte_at, offsets)
        slow = np.zeros(len(offsets) - 1, bool)
        if odd.any():
            slow |= np.diff(np.append(0, np.cumsum(odd))[ends]) > 0
        if not unicodedata.is_normalized("NFC", whole.decode()):
            for i in np.flatnonzero(~slow):
                text = whole[offsets[i]:offsets[i + 1]].decode()
                slow[i] = not unicodedata.is_normalized("NFC", text)
        if any(s in whole for s in self._special):
            for i in range(len(slow)):
                slow[i] |= any(s in whole[offsets[i]:offsets[i + 1]] for s in self._special)
        if not slow.any():
            return self._fast(data, ends)
        found: list = [None] * len(slow)
        for i in np.flatnonzero(slow):
            text = whole[offsets[i]:offsets[i + 1]].decode()
            found[i] = np.array(
                _tokenizer(self._path).encode(text, add_special_tokens=False).ids, np.uint32)
        rest = np.flatnonzero(~slow)
        if len(rest):
            parts = [whole[offsets[i]:offsets[i + 1]] for i in rest]
            sizes = np.append(0, np.cumsum([len(p.decode()) for p in parts]))
            kept = self._fast(np.frombuffer(b"".join(parts), np.uint8), sizes)
            for i, ids in zip(rest, kept):
                found[i] = ids
        return found


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
