"""Byte automata: rules are put together from small parts, then made deterministic and minimal.

All rules share one automaton. A state's mask says which rules have just matched, so a single
pass over the bytes serves every rule.
"""

from __future__ import annotations

import numpy as np

#: Ends a text; no rule contains it and UTF-8 never does.
STOP = 0xFF


class Rule:
    """A pattern over bytes, as a tree that writes itself into a nondeterministic automaton."""

    def __init__(self, kind: str, *parts):
        self.kind, self.parts = kind, parts

    def build(self, net: "Net", begin: int, end: int) -> None:
        if self.kind == "set":
            net.moves.append((begin, self.parts[0], end))
        elif self.kind == "seq":
            at = begin
            for part in self.parts:
                after = net.state()
                part.build(net, at, after)
                at = after
            net.empty.append((at, end))
        elif self.kind == "alt":
            for part in self.parts:
                part.build(net, begin, end)
        else:  # many: none or more
            loop = net.state()
            net.empty += [(begin, loop), (loop, end)]
            self.parts[0].build(net, loop, loop)

    def reversed(self) -> "Rule":
        if self.kind == "set":
            return self
        parts = [p.reversed() for p in self.parts]
        return Rule(self.kind, *(parts[::-1] if self.kind == "seq" else parts))


def one(characters: str | bytes) -> Rule:
    """Any one of the characters; ``a-z`` style ranges are written out by ``span``."""
    raw = characters.encode("latin-1") if isinstance(characters, str) else characters
    return Rule("set", frozenset(raw))


def span(*pairs: str) -> str:
    """Characters of the given two-letter ranges."""
    return "".join(chr(c) for a, b in pairs for c in range(ord(a), ord(b) + 1))


def text(word: str, any_case: bool = False) -> Rule:
    return Rule("seq", *(one(c.lower() + c.upper() if any_case else c) for c in word))


def seq(*parts: Rule) -> Rule:
    return Rule("seq", *parts)


def alt(*parts: Rule) -> Rule:
    return Rule("alt", *parts)


def many(part: Rule) -> Rule:
    return Rule("many", part)


def some(part: Rule) -> Rule:
    return seq(part, many(part))


def maybe(part: Rule) -> Rule:
    return alt(part, Rule("seq"))


def at_least(n: int, part: Rule) -> Rule:
    return seq(*[part] * n, many(part))


class Net:
    def __init__(self):
        self.count, self.moves, self.empty = 0, [], []

    def state(self) -> int:
        self.count += 1
        return self.count - 1


class Automaton:
    """``step[state * width + group[byte]]`` is the next state, ``mask[state]`` the rules matched."""

    def __init__(self, rules: list[Rule], anchored: bool):
        net = Net()
        start = net.state()
        ends = {}
        for bit, rule in enumerate(rules):
            begin, end = net.state(), net.state()
            net.empty.append((start, begin))
            rule.build(net, begin, end)
            ends[end] = 1 << bit
        self.group, members = _byte_groups(net)
        step, masks = _subsets(net, start, ends, members, anchored)
        step, masks, first = _minimal(step, masks)
        self.width = step.shape[1]
        self.states = len(step)
        self.start = first
        self.mask = masks.astype(np.uint8)
        self.step = (step * self.width).astype(np.int32).ravel()  # states come pre-multiplied
        self.dead = self._dead(step, masks)

    @staticmethod
    def _dead(step: np.ndarray, masks: np.ndarray) -> int:
        stuck = [s for s in range(len(step)) if not masks[s] and (step[s] == s).all()]
        return stuck[0] if stuck else -1


def _byte_groups(net: Net) -> tuple[np.ndarray, list[int]]:
    """Bytes that no rule tells apart share a group; one member of each group."""
    signature: dict[tuple, int] = {}
    group, members = np.zeros(256, np.uint8), []
    sets = list({m[1] for m in net.moves})
    for byte in range(256):
        key = (byte == STOP, *(byte in s for s in sets))
        if key not in signature:
            signature[key] = len(members)
            members.append(byte)
        group[byte] = signature[key]
    return group, members


def _subsets(net: Net, start: int, ends: dict, members: list[int], anchored: bool):
    follow: dict[int, list[int]] = {}
    for a, b in net.empty:
        follow.setdefault(a, []).append(b)
    moves: dict[int, list] = {}
    for a, accepted, b in net.moves:
        moves.setdefault(a, []).append((accepted, b))

    def closed(states) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for b in follow.get(todo.pop(), ()):
                if b not in found:
                    found.add(b)
                    todo.append(b)
        return frozenset(found)

    first = closed([start])
    number, order, step = {first: 0}, [first], []
    for subset in order:  # grows while it is read
        row = []
        for byte in members:
            reached = {b for s in subset for accepted, b in moves.get(s, ()) if byte in accepted}
            target = closed(reached) | (first if not anchored or byte == STOP else frozenset())
            if anchored and byte == STOP:
                target = frozenset()
            if byte == STOP and not anchored:
                target = first
            if target not in number:
                number[target] = len(order)
                order.append(target)
            row.append(number[target])
        step.append(row)
    masks = np.array([sum(bit for end, bit in ends.items() if end in s) for s in order])
    return np.array(step), masks


def _minimal(step: np.ndarray, masks: np.ndarray):
    """Merge states that no continuation tells apart, by refining a partition until it stands."""
    part = np.unique(masks, return_inverse=True)[1].reshape(-1)
    while True:
        key = np.concatenate([part[:, None], part[step]], axis=1)
        _, at, finer = np.unique(key, axis=0, return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == part.max():
            return part_rows(step, part), masks[_firsts(part)], int(part[0])
        part = finer


def _firsts(part: np.ndarray) -> np.ndarray:
    return np.unique(part, return_index=True)[1]


def part_rows(step: np.ndarray, part: np.ndarray) -> np.ndarray:
    return part[step[_firsts(part)]]


LANE, WARM = 1024, 48


def masks_of(automaton: Automaton, data: np.ndarray) -> np.ndarray:
    """Mask after every byte, from one pass over lanes of bytes side by side.

    A lane begins some bytes early to guess its entry state. Lanes whose guess differs from the
    state that the lane before ended in are run again until all agree.
    """
    n = len(data)
    lanes = max(1, -(-n // LANE))
    symbols = np.full(WARM + lanes * LANE, automaton.group[STOP], np.uint8)
    symbols[WARM:WARM + n] = automaton.group[data]
    symbols = symbols.astype(np.int32)
    step, width = automaton.step, automaton.width
    found = np.zeros((lanes, LANE), np.uint8)
    mask = np.zeros(automaton.states * width, np.uint8)
    mask[::width] = automaton.mask
    begin = WARM + np.arange(lanes) * LANE
    state = np.full(lanes, automaton.start * width, np.int32)
    for k in range(WARM):
        state = step[state + symbols[begin - WARM + k]]
    entry, todo = state, np.arange(lanes)
    leaving = np.empty(lanes, np.int32)
    by_place = np.ascontiguousarray(symbols[WARM:].reshape(lanes, LANE).T)
    while len(todo):
        state = entry[todo]
        part = by_place if len(todo) == lanes else np.ascontiguousarray(by_place[:, todo])
        out = np.empty((LANE, len(todo)), np.uint8)
        for k in range(LANE):
            state = step[state + part[k]]
            out[k] = mask[state]
        found[todo] = out.T
        leaving[todo] = state
        true = np.append(np.int32(automaton.start * width), leaving[:-1])
        todo = np.flatnonzero(true != entry)
        entry = true
    return found.reshape(-1)[:n]
