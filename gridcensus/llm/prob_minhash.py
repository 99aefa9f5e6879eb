"""ProbMinHash signatures of weighted shingles, many documents at a time.

A shingle that occurs w times in a document sends arrivals of a Poisson process of rate w, drawn
from the shingle's own random stream; each arrival falls into one of the signature's slots, and a
slot keeps the shingle that arrived there first. Two documents agree in a slot with probability
equal to their probability Jaccard similarity. A shingle stops once its next arrival is later
than the latest first arrival of all slots, so most shingles draw once or twice.
"""

from __future__ import annotations

import numpy as np

from gridcensus.llm.words import SHINGLE

_G = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of one document's word hashes, ascending, and their counts.

    A document of fewer words than ``length`` has one shingle of all of them; without words, none.
    """
    words = words.astype(np.uint64) if words.dtype != np.uint64 else words
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = min(length, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total + words[k:len(words) - n + 1 + k] + _G)
    return np.unique(total, return_counts=True)


def signatures(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, docs: int,
               slots: int) -> np.ndarray:
    """(docs, slots) shingle hashes; rows of documents without shingles are 0."""
    first = np.full(docs * slots, np.inf)
    winner = np.zeros(docs * slots, np.uint64)
    latest = np.full(docs, np.inf)
    time = np.zeros(len(hashes))
    state = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    while len(hashes):
        state = state + _G
        draw = mix(state)
        time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / weights
        live = time < latest[owner]
        if not live.all():
            hashes, weights, owner = hashes[live], weights[live], owner[live]
            time, state, draw = time[live], state[live], draw[live]
            if not len(hashes):
                break
        pick = mix(draw ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)
        slot = owner * slots + ((pick * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)
        better = np.flatnonzero(time < first[slot])
        if len(better):
            np.minimum.at(first, slot[better], time[better])
            won = better[time[better] == first[slot[better]]]
            winner[slot[won]] = hashes[won]
            touched = np.unique(owner[better])
            latest[touched] = first.reshape(docs, slots)[touched].max(1)
    return winner.reshape(docs, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(docs, bands) keys, each of ``rows`` slots and the band's number."""
    docs = len(signature)
    parts = signature[:, :bands * rows].reshape(docs, bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _G), (docs, bands))
    for k in range(rows):
        keys = mix(keys + parts[:, :, k] + _G)
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity that the signatures estimate, from shingles and counts of two documents.

    Shingles with the same pair of counts weigh alike, and there are few such pairs.
    """
    both, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][at_a], b[1][at_b]
    if a[1].max() == b[1].max() == 1:
        return len(both) / (len(a[0]) + len(b[0]) - len(both))
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    pairs, n = np.unique(np.stack([x, y], 1), axis=0, return_counts=True)
    ratio_a, ratio_b = pairs[:, 0], pairs[:, 1]
    shared = np.maximum(ratio_a[None, :] / ratio_a[:, None], ratio_b[None, :] / ratio_b[:, None]) @ n
    return float((n / (shared + only_a / ratio_a + only_b / ratio_b)).sum())
