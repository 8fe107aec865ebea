"""What the tasks of ``boosted`` run: rows as codes, the generator that draws a tree's rows, routing and sums.

A module of its own, so that a worker imports no more than it needs."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Rows of a block: its arrays stay in a processor's cache.
BLOCK = 1 << 16
#: Columns share a code while it has at most so many values.
WIDTH = 1024


# ---------------------------------------------------------------- Spark's generator
def _murmur(data: bytes, seed: int) -> int:
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def xorshift_state(seed: int) -> int:
    """State of Spark's ``XORShiftRandom`` after ``setSeed(seed)``."""
    data = struct.pack(">q", seed)
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(state: np.ndarray) -> np.ndarray:
    state = state ^ state << np.uint64(21)
    state ^= state >> np.uint64(35)
    state ^= state << np.uint64(4)
    return state


def xorshift_int(seed: int) -> int:
    """``new XORShiftRandom(seed).nextInt()``."""
    low = int(_step(np.array([xorshift_state(seed)], np.uint64))[0]) & 0xFFFFFFFF
    return low - (1 << 32) if low >> 31 else low


@lru_cache(maxsize=64)
def _jump(power: int) -> np.ndarray:
    """The generator is linear over bits: 2**power steps at once, by lookups of a state's 8 bytes."""
    bits = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    images = _step(bits) if power == 0 else _jumped(_jumped(bits, power - 1), power - 1)
    table = np.zeros((8, 256), np.uint64)
    for b in range(8):
        for k in range(8):
            table[b, 1 << k:2 << k] = table[b, :1 << k] ^ images[8 * b + k]
    return table


def _jumped(state: np.ndarray, power: int) -> np.ndarray:
    table, out = _jump(power), np.zeros_like(state)
    for b in range(8):
        out ^= table[b].take((state >> np.uint64(8 * b) & np.uint64(255)).astype(np.int64))
    return out


def drawn(seed: int, start: int, n: int, rate: float) -> np.ndarray:
    """Whether draws ``start`` to ``start + n`` of ``XORShiftRandom(seed).nextDouble()`` lie below ``rate``."""
    state = np.array([xorshift_state(seed)], np.uint64)
    for power in range(63):
        if 2 * start >> power & 1:
            state = _jumped(state, power)
    lanes, power = max(1, -(-n // 16)), 5                 # a lane makes 16 draws of two steps each
    while len(state) < lanes:
        state = np.concatenate([state, _jumped(state, power)])
        power += 1
    state, out, below = state[:lanes], np.empty((16, lanes), bool), np.uint64(math.ceil(rate * (1 << 53)))
    for i in range(16):
        state = _step(state)
        high = (state & np.uint64((1 << 26) - 1)) << np.uint64(27)
        state = _step(state)
        high += state & np.uint64((1 << 27) - 1)
        np.less(high, below, out=out[i])
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- columns and trees
@dataclass
class Columns:
    """Numeric columns by bin, categorical ones by level (one more bin for no level); ``groups`` share a code."""
    thresholds: list[list[float]]
    levels: list[int]
    groups: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        self.bins = [len(t) + 1 for t in self.thresholds] + [n + 1 for n in self.levels]
        widths: list[int] = []
        for c in sorted(range(len(self.bins)), key=lambda c: -self.bins[c]):
            g = next((g for g, w in enumerate(widths) if w * self.bins[c] <= WIDTH), len(widths))
            if g == len(widths):
                self.groups.append([])
                widths.append(1)
            self.groups[g].append(c)
            widths[g] *= self.bins[c]
        self.widths = widths
        self.first = np.concatenate([[0], np.cumsum(self.bins)])
        self.dtype = np.uint16 if max(widths) <= 1 << 16 else np.uint32
        # slots of the feature vector: (column, level), numeric columns first
        self.slots = [(c, -1) for c in range(len(self.thresholds))]
        self.slots += [(len(self.thresholds) + i, v) for i, n in enumerate(self.levels) for v in range(n)]

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """One row of codes per group."""
        out = np.zeros((len(self.groups), len(columns[0])), np.int64)
        for g, members in enumerate(self.groups):
            for c in members:
                v = columns[c]
                if c < len(self.thresholds):
                    b = np.searchsorted(np.array(self.thresholds[c], np.float64), v, side="left")
                else:
                    b = np.minimum(v, self.bins[c] - 1).astype(np.int64)
                out[g] = out[g] * self.bins[c] + b
        return out.astype(self.dtype)

    def bin_of(self, column: int) -> tuple[int, np.ndarray]:
        """The group of a column, and the column's bin of each of its codes."""
        g = next(i for i, members in enumerate(self.groups) if column in members)
        shape = [self.bins[c] for c in self.groups[g]]
        return g, np.unravel_index(np.arange(self.widths[g]), shape)[self.groups[g].index(column)]

    def by_column(self, sums: Sequence[np.ndarray], nodes: int) -> np.ndarray:
        """Sums per code of each group -> sums per (statistic, node, bin of every column)."""
        out = np.zeros((3, nodes, int(self.first[-1])))
        for members, s in zip(self.groups, sums):
            s = s.reshape(3, nodes, *[self.bins[c] for c in members])
            for i, c in enumerate(members):
                out[:, :, self.first[c]:self.first[c + 1]] = s.sum(axis=tuple(2 + j for j in range(len(members)) if j != i))
        return out


@dataclass
class Grown:
    """Nodes in the order they were made, the root first; ``slot`` -1 marks a leaf.  ``cut`` is the last bin that goes
    left, or for a one-hot slot 1 if the rows of the level go left and 0 if the others do."""
    slot: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    stats: list[tuple[float, float, float]] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    valid: list[bool] = field(default_factory=list)
    depth: int = 0

    def add(self, stats) -> int:
        self.slot.append(-1)
        self.cut.append(-1)
        self.left.append(-1)
        self.stats.append(tuple(float(x) for x in stats))
        self.gain.append(-1.0)
        self.valid.append(True)
        return len(self.slot) - 1

    def value(self, node: int) -> float:
        n, s, _ = self.stats[node]
        return s / n if n else 0.0


class Router:
    """Takes rows to the nodes they end in by one lookup a level: (node, code) -> next node."""

    def __init__(self, columns: Columns, tree: Grown):
        narrow = int(np.argmin(columns.widths))
        self.depth, tables, self.group = tree.depth, [], np.full(max(1, len(tree.slot)), narrow)
        for node, slot in enumerate(tree.slot):
            if slot < 0:
                tables.append(np.full(columns.widths[narrow], node))
                continue
            column, level = columns.slots[slot]
            self.group[node], b = columns.bin_of(column)
            left = b <= tree.cut[node] if level < 0 else (b == level) == bool(tree.cut[node])
            tables.append(np.where(left, tree.left[node], tree.left[node] + 1))
        self.after = np.concatenate(tables) if tables else np.zeros(columns.widths[narrow], np.int64)
        self.base = np.cumsum([0] + [len(t) for t in tables[:-1]])

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        if not self.depth:
            return np.zeros(n, np.int64)
        node, flat, row = self.after.take(codes[self.group[0]]), codes.reshape(-1), np.arange(n)
        for _ in range(self.depth - 1):
            node = self.after.take(self.base.take(node) + flat.take(self.group.take(node) * n + row))
        return node


# ---------------------------------------------------------------- jobs
def packed(columns: Columns, label: str, names: Sequence[str]):
    """Blocks of a partition's rows: codes and labels as bytes, with the place of the first row."""
    def block(start: int, batch: pa.Table) -> pa.RecordBatch:
        y = batch.column(label).to_numpy().astype(np.float64)
        values = [batch.column(c).to_numpy().astype(np.float64) for c in names]
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError(f"labels must be 0 or 1, and {label} has others")
        if not all(np.isfinite(v).all() for v in values):
            raise ValueError("feature values must not be missing or infinite")
        return pa.record_batch([pa.array([start], pa.int64()), pa.array([y.astype(np.int8).tobytes()], pa.binary()),
                                pa.array([columns.codes(values).tobytes()], pa.binary())], names=["start", "y", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, held, rows = 0, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held.append(batch.slice(at, BLOCK))
                rows += held[-1].num_rows
                if rows >= BLOCK:
                    yield block(start, pa.Table.from_batches(held))
                    start, held, rows = start + rows, [], 0
        if rows:
            yield block(start, pa.Table.from_batches(held))
    return run


def first_margins(columns: Columns):
    """Blocks as (partition, place of the first row, labels, codes, margins)."""
    def run(part: int, rows):
        for start, labels, codes in rows:
            y = np.frombuffer(labels, np.int8)
            yield part, start, y, np.frombuffer(codes, columns.dtype).reshape(-1, len(y)), np.zeros(len(y))
    return run


def next_margins(columns: Columns, tree: Grown, weight: float):
    def run(blocks):
        router, value = Router(columns, tree), np.array([tree.value(i) for i in range(len(tree.slot))])
        for part, start, y, codes, margin in blocks:
            yield part, start, y, codes, margin + weight * value.take(router(codes))
    return run


def targets(index: int, rate: float, seed: int):
    """Codes and targets of the rows drawn for a tree: the label first, then minus the gradient of the log loss."""
    def run(blocks):
        for part, start, y, codes, margin in blocks:
            sign = 2.0 * y - 1.0
            target = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)) if index else sign
            if rate < 1.0:
                use = np.flatnonzero(drawn(seed + index + part + 1, start, len(y), rate))
                codes, target = codes.take(use, axis=1), target.take(use)
            yield codes, target
    return run


def sums_of(columns: Columns, tree: Grown, nodes: Sequence[int]):
    """Per task: weight, target and squared target of the rows in ``nodes``, by node and bin of every column."""
    def run(blocks):
        place, router = np.full(max(1, len(tree.slot)), -1), Router(columns, tree)
        place[list(nodes)] = np.arange(len(nodes))
        sums = [np.zeros((3, len(nodes) * w)) for w in columns.widths]
        for codes, target in blocks:
            at = place.take(router(codes))
            use = np.flatnonzero(at >= 0)
            if len(use) < len(at):
                at, codes, target = at.take(use), codes.take(use, axis=1), target.take(use)
            square = target * target
            for s, w, code in zip(sums, columns.widths, codes):
                cell = at * w + code
                s[0] += np.bincount(cell, minlength=s.shape[1])
                s[1] += np.bincount(cell, target, s.shape[1])
                s[2] += np.bincount(cell, square, s.shape[1])
        yield columns.by_column(sums, len(nodes))
    return run
