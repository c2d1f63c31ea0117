"""Weighted acyclic automata over words, for counts of n-grams.

An automaton has states and arcs. An arc has a word, the count of the n-gram that
the path up to it spells (0 if that is only the beginning of others) and a target
state; state 0 has no arcs. It is built from sorted n-grams: once the input has
left a state its arcs are complete, and if a state with the same arcs is in the
register already, that one takes its place. So the automaton is the minimal
deterministic one and equal continuations are stored once.

Arcs are columns of numbers over a sorted table of words. Building, expanding and
composing go a depth at a time with numpy; one register look-up per state is the
only Python step.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

_HEAD = struct.Struct("<IIQIII")


class Grams:
    """Sorted distinct n-grams with counts: ``keys`` has a row of word numbers for each, -1 after its end; ``words`` is sorted."""

    def __init__(self, words: pa.Array, keys: np.ndarray, counts: np.ndarray):
        self.words, self.keys, self.counts = words, keys, counts

    def __len__(self) -> int:
        return len(self.counts)

    def take(self, rows) -> Grams:
        return Grams(self.words, self.keys[rows], self.counts[rows])

    def trimmed(self) -> Grams:
        """The same over no other words than its own."""
        used = np.unique(self.keys[self.keys >= 0])
        number = np.full(len(self.words) + 1, -1)
        number[used] = np.arange(len(used))
        return Grams(self.words.take(pa.array(used)), number[self.keys], self.counts)

    def texts(self) -> list[list[bytes]]:
        words = self.words.to_pylist()
        return [[words[w] for w in row if w >= 0] for row in self.keys.tolist()]

    @staticmethod
    def of(grams: list[list[bytes]], counts: list[int], depth: int) -> Grams:
        """From n-grams in any order, repeats summed."""
        flat = pa.array([w for g in grams for w in g], pa.large_binary())
        keys = np.full((len(grams), depth), -1)
        if len(flat):
            lengths = np.fromiter(map(len, grams), np.int64, len(grams))
            keys[np.arange(depth) < lengths[:, None]] = np.arange(len(flat))
        return union([Grams(flat, keys, np.array(counts, np.int64))], depth)


def _numbered(tables: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """One sorted table of all words, and the numbers of the tables' words in it."""
    coded = pa.concat_arrays(tables).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), number[coded.indices.to_numpy()]


def union(parts: list[Grams], depth: int) -> Grams:
    """All n-grams of the parts, the counts of equal ones summed."""
    if not parts:
        return Grams(pa.array([], pa.large_binary()), np.zeros((0, depth), np.int64), np.zeros(0, np.int64))
    words, number = _numbered([p.words for p in parts])
    keys, at = [], 0
    for p in parts:
        keys.append(np.append(number[at : at + len(p.words)], -1)[p.keys])
        at += len(p.words)
    keys, counts = np.concatenate(keys), np.concatenate([p.counts for p in parts])
    order = np.lexsort(keys.T[::-1])
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.zeros(0, np.int64)
    return Grams(words, keys[first], np.add.reduceat(counts, first) if len(first) else counts)


def places(grams: Grams, bounds: Grams) -> np.ndarray:
    """How many of the sorted ``bounds`` are not above each n-gram."""
    words, number = _numbered([grams.words, bounds.words])
    own = np.append(number[: len(grams.words)], -1)[grams.keys]
    cuts = np.append(number[len(grams.words) :], -1)[bounds.keys]
    keys = np.concatenate([cuts, own])
    # The sort is stable: a bound stands before the equal n-gram.
    order = np.lexsort(keys.T[::-1])
    below = np.cumsum(order < len(cuts))
    out = np.empty(len(keys), np.int64)
    out[order] = below
    return out[len(cuts) :]


class Transducer:
    def __init__(self, depth: int, words: pa.Array, starts: np.ndarray, arcs: np.ndarray, root: int):
        """``starts``: the first arc of each state, and the number of arcs; ``arcs``: rows (word, count, target)."""
        self.depth, self.words, self.starts, self.arcs, self.root = depth, words, starts, arcs, root

    @staticmethod
    def build(grams: Grams) -> Transducer:
        grams = grams.trimmed()
        keys, depth = grams.keys, grams.keys.shape[1]
        shared = np.zeros(len(grams), np.int64)
        if len(grams) > 1:
            shared[1:] = np.argmin(np.c_[keys[1:] == keys[:-1], np.zeros(len(keys) - 1, bool)], axis=1)
        # The rows that open a path of d + 1 words; its n-gram, if counted, is that row itself.
        opens = [np.flatnonzero((shared <= d) & (keys[:, d] >= 0)) for d in range(depth)]
        register: dict[bytes, int] = {}
        arcs: list[np.ndarray] = []
        targets = np.zeros(len(opens[-1]), np.int64)
        for d in range(depth - 1, -1, -1):
            rows = opens[d]
            ends = keys[rows, d + 1] < 0 if d + 1 < depth else True
            columns = np.stack([keys[rows, d], np.where(ends, grams.counts[rows], 0), targets], axis=1)
            above = opens[d - 1] if d else np.zeros(1, np.int64)
            limits = np.searchsorted(rows, above)
            limits = np.append(limits, len(rows)).tolist()
            frozen = []
            for a, b in zip(limits, limits[1:]):
                own = columns[a:b]
                state = register.setdefault(own.tobytes(), len(arcs) + 1) if b > a else 0
                if state > len(arcs):
                    arcs.append(own)
                frozen.append(state)
            targets = np.array(frozen, np.int64)
        starts = np.cumsum([0, 0, *map(len, arcs)])
        table = np.concatenate(arcs) if arcs else np.zeros((0, 3), np.int64)
        return Transducer(depth, grams.words, starts, table, int(targets[0]) if len(targets) else 0)

    def grams(self) -> Grams:
        """The n-grams it counts, sorted."""
        states, paths = np.array([self.root]), np.full((1, self.depth), -1)
        keys, counts = [np.zeros((0, self.depth), np.int64)], [np.zeros(0, np.int64)]
        for d in range(self.depth):
            sizes = self.starts[states + 1] - self.starts[states]
            ends = np.cumsum(sizes)
            at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[states] - (ends - sizes), sizes)
            paths = np.repeat(paths, sizes, axis=0)
            paths[:, d] = self.arcs[at, 0]
            states = self.arcs[at, 2]
            counted = self.arcs[at, 1] > 0
            keys.append(paths[counted])
            counts.append(self.arcs[at, 1][counted])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.lexsort(keys.T[::-1])
        return Grams(self.words, keys[order], counts[order])

    def compose(self, asked: Grams) -> np.ndarray:
        """The counts of the asked n-grams, 0 for those it does not count: both are walked together, a depth at a time."""
        width = len(self.words) + 1
        label = np.append(pc.index_in(asked.words, self.words).fill_null(width).to_numpy(), width).astype(np.int64)
        state_of_arc = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        arc_keys = state_of_arc * width + self.arcs[:, 0]
        states, found = np.full(len(asked), self.root), np.zeros(len(asked), np.int64)
        for d in range(asked.keys.shape[1]):
            goes_on = asked.keys[:, d] >= 0
            word = label[asked.keys[:, d]]
            want = states * width + word
            at = np.minimum(np.searchsorted(arc_keys, want), max(0, len(arc_keys) - 1))
            hit = (arc_keys[at] == want) & (word < width) if len(arc_keys) else np.zeros(len(want), bool)
            found = np.where(goes_on, np.where(hit, self.arcs[at, 1] if len(arc_keys) else 0, 0), found)
            states = np.where(goes_on, np.where(hit, self.arcs[at, 2] if len(arc_keys) else 0, 0), states)
        return found

    def to_bytes(self) -> bytes:
        data = pa.concat_arrays([self.words]).cast(pa.large_binary())
        joined = b"".join(data.to_pylist())
        lengths = pc.binary_length(data).to_numpy(zero_copy_only=False)
        body = b"".join(
            x.astype(t).tobytes()
            for x, t in ((lengths, "<u4"), (np.diff(self.starts), "<u4"), (self.arcs[:, 0], "<u4"), (self.arcs[:, 1], "<i8"), (self.arcs[:, 2], "<u4"))
        )
        head = _HEAD.pack(self.depth, len(lengths), len(joined), len(self.starts) - 1, len(self.arcs), self.root)
        return head + zstandard.ZstdCompressor(level=1).compress(joined + body)

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        depth, n_words, n_bytes, n_states, n_arcs, root = _HEAD.unpack_from(data)
        body = zstandard.ZstdDecompressor().decompress(data[_HEAD.size :])
        at = n_bytes

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out.astype(np.int64)

        lengths = read("<u4", n_words)
        offsets = np.cumsum(np.append(0, lengths))
        words = pa.Array.from_buffers(pa.large_binary(), n_words, [None, pa.py_buffer(offsets), pa.py_buffer(body[:n_bytes])])
        starts = np.cumsum(np.append(0, read("<u4", n_states)))
        arcs = np.stack([read("<u4", n_arcs), read("<i8", n_arcs), read("<u4", n_arcs)], axis=1)
        return Transducer(depth, words, starts, arcs, root)
