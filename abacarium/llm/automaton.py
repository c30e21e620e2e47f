"""A minimal acyclic automaton of words that numbers them, as one flat block of bytes.

Words are added in sorted order; states with the same arcs are shared, so common
endings are stored once. Every arc carries how many words come before it in its
state, so the sum along a path is the word's number, and the ids of word ``k`` are
``ids[offsets[k]:offsets[k + 1]]``. The block is memory-mapped where it is used.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable

import numpy as np

from abacarium.llm.common import by_value

#: Arcs in order of state and byte: ``key`` is 256 times the state plus the byte.
_PARTS = ("key", "target", "before", "final", "offsets", "ids")
_TYPES = ("<i8", "<i4", "<i4", "u1", "<i4", "<i4")


def compile_words(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of the given words (sorted, distinct, not empty) with their ids."""
    shared: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    sizes: list[int] = []
    path: list[list] = [[False, []]]  # open states: final, arcs to closed states
    labels: list[int] = []
    last, outputs, offsets = b"", [], [0]

    def close(depth: int) -> None:
        while len(labels) > depth:
            final, arcs = path.pop()
            shape = (final, tuple(arcs))
            if shape not in shared:
                shared[shape] = len(states)
                states.append(shape)
                sizes.append(final + sum(sizes[t] for _, t in arcs))
            path[-1][1].append((labels.pop(), shared[shape]))

    for word, ids in entries:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same)
        for byte in word[same:]:
            labels.append(byte)
            path.append([False, []])
        path[-1][0] = True
        last = word
        outputs += ids
        offsets.append(len(outputs))
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    key, target, before = [], [], []
    for state, (final, arcs) in enumerate(states):
        count = int(final)
        for byte, to in arcs:
            key.append(state << 8 | byte)
            target.append(to)
            before.append(count)
            count += sizes[to]
    parts = (key, target, before, [int(f) for f, _ in states], offsets, outputs)
    blocks = [np.asarray(p, t).tobytes() for p, t in zip(parts, _TYPES, strict=True)]
    head = np.asarray([len(b) for b in blocks], "<i8").tobytes()
    return head + b"".join(b + b"\0" * (-len(b) % 8) for b in blocks)


class Automaton:
    """Looks words up in a compiled block, which is mapped from a file of this machine."""

    def __init__(self, block: bytes):
        path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(block).hexdigest()[:24]}.bin")
        if not os.path.exists(path):
            handle, own = tempfile.mkstemp(dir=os.path.dirname(path))
            with os.fdopen(handle, "wb") as out:
                out.write(block)
            os.replace(own, path)
        # As a plain array: every slice of a memmap object goes through Python.
        mapped = np.asarray(np.memmap(path, np.uint8, "r"))
        lengths, at = mapped[: 8 * len(_PARTS)].view("<i8"), 8 * len(_PARTS)
        for name, kind, length in zip(_PARTS, _TYPES, lengths.tolist(), strict=True):
            setattr(self, name, mapped[at : at + length].view(kind))
            at += length + -length % 8

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that the lexicon does not hold; all words step in parallel."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        state, number = np.full(len(words), len(self.final) - 1, np.int64), np.zeros(len(words), np.int64)
        live, at = np.flatnonzero(sizes > 0), 0
        lost = sizes == 0
        while len(live):
            key = state[live] << 8 | data[starts[live] + at]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            good = self.key[arc] == key
            lost[live[~good]] = True
            live, arc = live[good], arc[good]
            number[live] += self.before[arc]
            state[live] = self.target[arc]
            at += 1
            live = live[sizes[live] > at]
        return np.where(lost | (self.final[state] == 0), -1, number)

    def output(self, number: int) -> list[int]:
        """The ids of word ``number``."""
        return self.ids[self.offsets[number] : self.offsets[number + 1]].tolist()

    def outputs(self, numbers: np.ndarray) -> list[list[int]]:
        """The ids of many words."""
        return [self.ids[lo:hi].tolist() for lo, hi in zip(self.offsets[numbers].tolist(), self.offsets[numbers + 1].tolist(), strict=True)]


by_value(__name__)
