"""Vector code compression: product codes by exact integer k-means with LAESA pivots.

Every component becomes an integer and a vector is cut into equal parts.  The distance of each
part to a few fixed pivots is computed once and kept beside the integers.  In a round only the
entries' distances to the pivots are new: their differences bound the distance of a part to an
entry from below.  Entries are tried in the order of that bound and exact integer distances are
evaluated only while the bound can still beat the best one found, so the result is that of the
full search, ties to the lower index included.

Only the codebooks (parts x entries x width integers) and their sums pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import saved

SCALE = 4096
PARTS, ENTRIES, ROUNDS, PIVOTS = 8, 16, 6, 4
#: Slack on a bound made of rounded square roots; below 2**31 each is off by less than 1e-6.
SLACK = 1e-5


@dataclass
class Codebooks:
    """entries[part, entry, position]; evaluated and possible count exact distances over all rounds."""
    entries: np.ndarray
    pivots: np.ndarray
    limit: int
    evaluated: int = 0
    possible: int = 0
    rounds: list[np.ndarray] = field(default_factory=list)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _finite(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and has neither null nor non-finite components."""
    x = F.col("vector")
    return vectors.where(x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))


def _limit(dimension: int) -> int:
    """Largest integer component for which a whole vector's squared distance still fits a long."""
    return math.isqrt((2**63 - 1) // (4 * max(dimension, 1)))


def _integers(column, dimension: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be coded, and their integer components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.flatnonzero(np.diff(ends) == dimension)
    at = ends[rows][:, None] + np.arange(dimension)
    scaled = flat[at] * SCALE
    fits = (np.abs(scaled) <= limit).all(axis=1)
    return rows[fits], np.floor(scaled[fits]).astype(np.int64)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return (d * d).sum(axis=-1)


def farthest_first(entries: np.ndarray, count: int) -> np.ndarray:
    """Pivots of one part: the first entry, then each time the entry farthest from all chosen."""
    chosen = [0]
    nearest = _squared(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def nearest_entry(x: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to each row's nearest entry, and the exact distances evaluated.

    to_pivot: distances of the rows to the pivots (not squared)."""
    low = np.zeros((len(x), len(entries)))
    for p, pivot in enumerate(pivots):
        np.maximum(low, np.abs(to_pivot[:, p, None] - np.sqrt(_squared(entries, pivot))), out=low)
    order = low.argsort(axis=1, kind="stable")
    best = np.full(len(x), np.iinfo(np.int64).max)
    index = np.zeros(len(x), np.int64)
    left, evaluated = np.arange(len(x)), 0
    for k in range(len(entries)):
        e = order[left, k]
        may = low[left, e] <= np.sqrt(best[left]) + SLACK
        left, e = left[may], e[may]
        if not len(left):
            break
        d = _squared(x[left], entries[e])
        evaluated += len(left)
        better = (d < best[left]) | ((d == best[left]) & (e < index[left]))
        best[left[better]] = d[better]
        index[left[better]] = e[better]
    return index, best, evaluated


def _prepared(model: Codebooks):
    """Integer components and pivot distances of each vector, computed once; null where a vector can't be coded."""
    parts, _, width = model.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _integers(batch.column("vector"), parts * width, model.limit)
            cut = x.reshape(len(x), parts, 1, width)
            far = np.sqrt(_squared(cut, model.pivots[None]))
            ints, dist = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            for i, a, b in zip(rows, x.astype("<i4"), far):
                ints[i], dist[i] = a.tobytes(), b.tobytes()
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(ints, pa.binary()), pa.array(dist, pa.binary())],
                                  names=["vec_id", "label", "ints", "to_pivot"])
    return run


def _read(batch: pa.RecordBatch, model: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, _, width = model.entries.shape
    ints = batch.column("ints")
    rows = np.flatnonzero(ints.is_valid().to_numpy(zero_copy_only=False))
    raw = b"".join(ints.drop_null().to_pylist())
    far = b"".join(batch.column("to_pivot").drop_null().to_pylist())
    return rows, np.frombuffer(raw, "<i4").reshape(len(rows), parts, width).astype(np.int64), np.frombuffer(far).reshape(len(rows), parts, model.pivots.shape[1])


def _sums(model: Codebooks):
    """Per task: for each part and entry the number of its parts (position -1) and their sum at each position."""
    parts, entries, width = model.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        evaluated = possible = 0
        for batch in batches:
            _, x, far = _read(batch, model)
            for p in range(parts):
                index, _, tried = nearest_entry(x[:, p], far[:, p], model.entries[p], model.pivots[p])
                np.add.at(total[p, :, 1:], index, x[:, p])
                total[p, :, 0] += np.bincount(index, minlength=entries)
                evaluated += tried
            possible += len(x) * parts * entries
        at = np.indices(total.shape).reshape(3, -1)
        yield pa.record_batch([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(at[2] - 1, pa.int32()), pa.array(total.reshape(-1))],
                              names=["part", "entry", "position", "total"])
        yield pa.record_batch([pa.array([-1, -1], pa.int32()), pa.array([-1, -1], pa.int32()), pa.array([0, 1], pa.int32()),
                               pa.array([evaluated, possible], pa.int64())], names=["part", "entry", "position", "total"])
    return run


def _codes(model: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x, far = _read(batch, model)
            got = [nearest_entry(x[:, p], far[:, p], model.entries[p], model.pivots[p])[:2] for p in range(len(model.entries))]
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            if got:
                codes[rows] = [c.tobytes().hex() for c in np.stack([i for i, _ in got], 1).astype(np.uint8)]
                errors[rows] = np.sum([d for _, d in got], axis=0)
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                  names=["vec_id", "label", "code", "error"])
    return run


def train_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                    pivots: int = PIVOTS) -> tuple[Codebooks, DataFrame]:
    """Codebooks over all rows of vectors(vec_id, vector, label), and the prepared table they were trained on.

    The first codebook is made of the vectors of the smallest vec_ids (fewer vectors: fewer entries).
    At most 256 entries, as a code is one byte."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    first = _finite(vectors).where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    lead = first.orderBy(*order).select(F.size("vector").alias("n")).first()
    dimension = lead["n"] if lead else 0
    limit = _limit(dimension)
    codable = first.where((F.size("vector") == dimension) & F.forall("vector", lambda c: F.abs(c.cast("double") * SCALE) <= limit))
    seeds = codable.orderBy(*order).limit(entries).select("vector").collect()
    start = np.floor(np.array([r[0] for r in seeds], np.float64) * SCALE).astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2) \
        if seeds else np.zeros((parts, 0, 0), np.int64)
    fixed = np.stack([farthest_first(e, pivots) for e in start]) if seeds else start
    model = Codebooks(start.copy(), fixed, limit)
    if not seeds:
        return model, _finite(vectors).select("vec_id", "label", F.lit(None).cast("binary").alias("ints"), F.lit(None).cast("binary").alias("to_pivot"))
    kind = vectors.schema["label"].dataType.simpleString()
    table = saved(_finite(vectors).mapInArrow(_prepared(model), f"vec_id long, label {kind}, ints binary, to_pivot binary"), "vectors")
    for _ in range(rounds):
        got = (table.mapInArrow(_sums(model), "part int, entry int, position int, total long")
               .groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
        total = {(r["part"], r["entry"], r["position"]): int(r["total"]) for r in got}
        model.evaluated += total.pop((-1, -1, 0))
        model.possible += total.pop((-1, -1, 1))
        model.rounds.append(model.entries.copy())
        for (p, e, j), s in total.items():
            if j >= 0 and total[p, e, -1]:
                model.entries[p, e, j] = s // total[p, e, -1]
    return model, table


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of each row of vectors(vec_id, vector, label).

    A row whose vector is null or holds null or non-finite components is dropped.  A vector whose length is
    not that of the smallest vec_id's (the first one whose length parts divide), or with a component so large
    that squared distances leave 64 bits (about 46,000 at 64 components), takes no part in training and
    stays with null code and error.  Rows with one vec_id are coded each on its own; among the first entries they are
    ordered by vector, null vec_ids last.  Null labels form one label; a label_error beyond 64 bits is null.
    An empty table gives an empty result.  Other columns are ignored."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector", "label")
    model, table = train_codebooks(vectors, parts, entries, rounds, pivots)
    kind = vectors.schema["label"].dataType.simpleString()
    coded = saved(table.mapInArrow(_codes(model), f"vec_id long, label {kind}, code string, error long"), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(model.sha256()).alias("codebooks_sha256")))
