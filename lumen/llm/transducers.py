"""Weighted acyclic automata over symbols: sorted sequences of one length with a count each.

A transducer reads a sequence symbol by symbol from its one start state; the last arc carries the
sequence's count.  Arcs leave a state in order of symbol, so walking all paths yields the
sequences in order.  It is built layer by layer from sorted sequences: equal beginnings share
states, and states with a single continuation that leads to the same end are shared from the back.
Symbols are byte strings in a sorted table, so order of symbol numbers is order of bytes.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of the ranges that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def summed(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``paths`` in order, each with the sum of its weights."""
    if not len(paths):
        return paths, weights
    order = np.lexsort(paths.T[::-1])
    paths, weights = paths[order], weights[order]
    new = np.flatnonzero(np.r_[True, (paths[1:] != paths[:-1]).any(axis=1)])
    return paths[new], np.add.reduceat(weights, new)


class Transducer:
    """``layers[d]``: of the states after d symbols where their arcs begin, and the arcs' symbols and
    values: states after d + 1 symbols, in the last layer counts."""

    def __init__(self, symbols: pa.Array, layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.symbols, self.layers = symbols, layers

    @classmethod
    def of_sorted(cls, symbols: pa.Array, paths: np.ndarray, weights: np.ndarray) -> Transducer:
        """From distinct sequences (rows of symbol numbers) in order; symbols that none uses are left out."""
        used = np.unique(paths)
        paths = np.searchsorted(used, paths)
        new = np.logical_or.accumulate(np.vstack([np.ones((1, paths.shape[1]), bool), paths[1:] != paths[:-1]]), axis=1)
        layers, place = [], None                 # place: where each state of the next layer went
        for depth in reversed(range(paths.shape[1])):
            at = new[:, depth]
            labels = paths[at, depth].astype(np.int32)
            values = weights[at] if place is None else place
            states = int(new[:, depth - 1].sum()) if depth else 1
            parent = np.cumsum(new[:, depth - 1])[at] - 1 if depth else np.zeros(len(labels), np.int64)
            first = np.searchsorted(parent, np.arange(states + 1))
            size = np.diff(first)
            # states with one arc are equal if the arcs are
            single = np.flatnonzero(size == 1)
            label, value = labels[first[single]], values[first[single]]
            order = np.lexsort((value, label))
            differs = np.r_[True, (label[order][1:] != label[order][:-1]) | (value[order][1:] != value[order][:-1])][:len(order)]
            keeper = np.arange(states)
            keeper[single[order]] = single[order][np.flatnonzero(differs)[np.cumsum(differs) - 1]] if len(order) else []
            kept = np.flatnonzero(keeper == np.arange(states))
            place = np.searchsorted(kept, keeper)
            arcs = ranges(first[kept], size[kept])
            layers.append((np.r_[0, np.cumsum(size[kept])], labels[arcs], values[arcs]))
        return cls(symbols.take(pa.array(used)), layers[::-1])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences in order, as rows of symbol numbers, and their counts."""
        states, columns = np.zeros(1, np.int64), []
        for first, labels, values in self.layers:
            size = first[states + 1] - first[states]
            arcs = ranges(first[states], size)
            columns = [np.repeat(c, size) for c in columns] + [labels[arcs]]
            states = values[arcs]
        return np.stack(columns, axis=1), states

    def to_bytes(self) -> bytes:
        return pickle.dumps((self.symbols.to_pylist(), [tuple(a.tobytes() for a in (f.astype(np.int32), x, v.astype(np.int64)))
                                                       for f, x, v in self.layers]), protocol=5)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        symbols, layers = pickle.loads(data)
        return cls(pa.array(symbols, pa.binary()), [(np.frombuffer(f, np.int32).astype(np.int64), np.frombuffer(x, np.int32), np.frombuffer(v, np.int64))
                                                    for f, x, v in layers])

    def composed(self, asked: Transducer) -> tuple[np.ndarray, np.ndarray]:
        """Of the sequences of ``asked``, in its order, the counts here, and which are here at all."""
        numbers = pc.index_in(asked.symbols, value_set=self.symbols).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        wanted = numbers[asked.paths()[0]]
        states, here = np.zeros(len(wanted), np.int64), (wanted >= 0).all(axis=1)
        for depth, (first, labels, values) in enumerate(self.layers):
            wide = len(self.symbols) + 1
            keys = np.repeat(np.arange(len(first) - 1), np.diff(first)) * wide + labels
            key = np.where(here, states * wide + wanted[:, depth], 0)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            here &= keys[at] == key
            states = np.where(here, values[at], 0)
        return states, here


def union(parts: list[Transducer], least: int = 1) -> Transducer | None:
    """The sequences of all ``parts``, counts of equal ones summed; None where none reaches ``least``."""
    table = pa.concat_arrays([p.symbols for p in parts]).unique()
    table = table.take(pc.sort_indices(table))
    rows = []
    for part in parts:
        numbers = pc.index_in(part.symbols, value_set=table).to_numpy(zero_copy_only=False)
        paths, weights = part.paths()
        rows.append((numbers[paths], weights))
    paths, weights = summed(np.concatenate([p for p, _ in rows]), np.concatenate([w for _, w in rows]))
    held = weights >= least
    return Transducer.of_sorted(table, paths[held], weights[held]) if held.any() else None
