"""Finite automata over flat arrays, run on all chunks of a text at once.

A chunk's effect is a map from entry state to exit state. The maps of all chunks are computed
side by side, composed by a parallel prefix scan, and give every chunk its true entry state; a
second pass then writes each symbol's output. Time grows with the number of symbols, whatever
the number of texts, and a single long text is spread over as many lanes as many short ones.
"""

from __future__ import annotations

import numpy as np

CHUNK, PROBE = 256, 24


class Transducer:
    """``step[state, symbol]`` is the next state, ``output[state, symbol]`` what it writes."""

    def __init__(self, step: np.ndarray, output: np.ndarray, start: int, pad: int):
        self.states, self.symbols = step.shape
        self.step = np.ascontiguousarray(step.astype(np.uint16)).ravel()
        self.output = np.ascontiguousarray(output.astype(np.uint8)).ravel()
        self.start, self.pad = start, pad

    def _advance(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        for k in range(symbols.shape[0]):
            state = self.step[state * np.uint16(self.symbols) + symbols[k]]
        return state

    def chunk_maps(self, lanes: np.ndarray) -> np.ndarray:
        """Exit state of each chunk for every entry state; ``lanes`` is (CHUNK, chunks).

        All entry states run for the first few symbols. Chunks on which they have met by then
        go on with one lane, the others with all.
        """
        chunks = lanes.shape[1]
        maps = np.repeat(np.arange(self.states, dtype=np.uint16)[:, None], chunks, axis=1)
        maps = self._advance(maps, lanes[:PROBE])
        met = (maps == maps[:1]).all(axis=0)
        maps[:, met] = self._advance(maps[0, met], lanes[PROBE:, met])[None, :]
        if not met.all():
            maps[:, ~met] = self._advance(maps[:, ~met], lanes[PROBE:, ~met])
        return maps

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """Output of every symbol, from the start state on."""
        n = len(symbols)
        if not n:
            return np.zeros(0, np.uint8)
        chunks = -(-n // CHUNK)
        lanes = np.full(chunks * CHUNK, self.pad, np.uint16)
        lanes[:n] = symbols
        lanes = np.ascontiguousarray(lanes.reshape(chunks, CHUNK).T)
        state = compose(self.chunk_maps(lanes), self.start)
        written = np.empty((CHUNK, chunks), np.uint8)
        for k in range(CHUNK):
            at = state * np.uint16(self.symbols) + lanes[k]
            written[k] = self.output[at]
            state = self.step[at]
        return written.T.reshape(-1)[:n]


def compose(maps: np.ndarray, start: int) -> np.ndarray:
    """Entry state of every chunk: prefix scan over the maps, in log2(chunks) rounds."""
    scan, chunks, width = maps, maps.shape[1], 1
    while width < chunks:
        later = scan.copy()
        later[:, width:] = np.take_along_axis(scan[:, width:], scan[:, :-width].astype(np.intp), 0)
        scan, width = later, width * 2
    entry = np.empty(chunks, np.uint16)
    entry[0] = start
    entry[1:] = scan[start, :-1]
    return entry
