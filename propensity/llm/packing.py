"""Packing by non-negative least squares over length combinations.

A document's ids are cut into whole windows and one remainder.  Remainders are counted by length in
units of `unit` tokens, rounded up: a histogram of window / unit numbers, whatever the corpus' size.
Shallow combinations that fill a window (two or three lengths, or one length repeated with one other)
are the columns of A in min ||A x - histogram||, x >= 0; the solution, rounded down, says how often each
combination is used.  Pieces of one length take its places by their rank, found from counts per partition.
Pieces left over are packed greedily one after another and cut at window ends; the last, unfilled window
becomes sequences of powers of two.  So only combined sequences are padded, by less than a unit a piece."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import blobs, saved, slices
from propensity.llm.tokens import encoder

WINDOW, UNIT = 4096, 16


def combinations(total: int) -> list[tuple[int, ...]]:
    """Multisets of lengths with the sum total: up to three parts, or one length repeated plus at most one other."""
    found = {(total,)}
    for a in range(1, total // 2 + 1):
        found.add((a, total - a))
    for a in range(1, total // 3 + 1):
        for b in range(a, (total - a) // 2 + 1):
            found.add((a, b, total - a - b))
    for a in range(1, total // 4 + 1):
        for m in range(3, total // a + 1):
            rest = total - m * a
            found.add(tuple(sorted((a,) * m + ((rest,) if rest else ()))))
    return sorted(found)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 2000) -> np.ndarray:
    """x >= 0 with least ||a x - b||, by the active-set method.  Only the products of active columns
    with each other are formed, at most as many as a has rows; all of them would be hundreds of MB."""
    target = a.T @ b
    n = len(target)
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(target).max(initial=0.0))
    for _ in range(steps):
        slope = target - a.T @ (a[:, active] @ x[active])
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on].T @ a[:, on], target[on], rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[on] = z
                break
            low = z <= 1e-12
            ratio = x[on][low] / np.maximum(x[on][low] - z[low], 1e-300)
            step = float(ratio.min(initial=1.0))
            x[on] += step * (z - x[on])
            off = on[(x[on] <= 1e-12) & low]
            if not len(off):
                off = on[low][:1]
            x[off] = 0
            active[off] = False
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(combination, times) for a histogram of lengths 1..n that fill n: solved, rounded down, then filled up greedily."""
    n = len(histogram)
    combos = combinations(n)
    a = np.zeros((n, len(combos)))
    for c, parts in enumerate(combos):
        np.add.at(a[:, c], np.array(parts) - 1, 1)
    b = histogram.astype(float)
    x = np.floor(nonnegative_least_squares(a, b) + 1e-6).astype(np.int64)
    used = np.flatnonzero(x)
    for c in used[np.argsort(x[used], kind="stable")]:           # rounding may ask for more than there are
        need = a[:, c] > 0
        over = (a[:, used] @ x[used] - histogram)[need]
        if (over > 0).any():
            x[c] = max(0, x[c] - int(np.ceil((over / a[need, c]).max())))
    left = histogram - (a @ x).astype(np.int64)
    for c in range(len(combos)):
        need = a[:, c] > 0
        more = int((left[need] // a[need, c]).min())
        if more > 0:
            x[c] += more
            left = left - (more * a[:, c]).astype(np.int64)
    return [(combos[c], int(x[c])) for c in np.flatnonzero(x)]


def _pieces(path: str, end: int, window: int):
    def run(batches):
        enc = encoder(path, end)
        for batch in batches:
            for i, j in slices(batch, "text", 2 << 20):
                part = batch.slice(i, j - i)
                out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
                for doc, ids in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text"))):
                    for s in range(0, len(ids), window):
                        piece = ids[s:s + window]
                        out["doc_id"].append(doc)
                        out["start"].append(s)
                        out["length"].append(len(piece))
                        out["ids_crc32"].append(zlib.crc32(piece.astype("<u4").tobytes()))
                        out["doc_tokens"].append(len(ids))
                        out["ids"].append(piece.tobytes())
                yield pa.record_batch([*(pa.array(out[k], pa.int64()) for k in list(out)[:5]), pa.array(out["ids"], pa.binary())], names=list(out))
    return run


def _places(slots):
    """Sequence of each ranked piece; -1 for those left over.  slots: per length the first rank and first sequence of each run."""
    def run(batches):
        for batch in batches:
            u, k = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("units", "rank"))
            seq = np.full(len(u), -1, np.int64)
            for length in np.unique(u):
                first, base = slots.value.get(int(length), (np.zeros(1, np.int64), np.zeros(0, np.int64)))
                if len(base):
                    mine = np.flatnonzero(u == length)
                    at = np.searchsorted(first, k[mine], side="right") - 1
                    inside = at < len(base)
                    seq[mine[inside]] = base[at[inside]] + k[mine[inside]] - first[at[inside]]
            yield pa.record_batch([batch.column("piece"), batch.column("length"), pa.array(seq)], names=["piece", "length", "combined"])
    return run


def _chopped(window: int, total: int):
    """Pieces of the left-over stream, cut at window ends; the end of the stream at powers of two."""
    tail = total % window
    ends, at = [], total - tail
    for bit in range(window.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            at += 1 << bit
            ends.append(at)
    full = total // window

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{len(r['ids']) // r['length']}").astype("<u4")
                s, stop = r["at"], r["at"] + len(ids)
                while s < stop:
                    if s < full * window:
                        number, begin, close = s // window, s // window * window, (s // window + 1) * window
                    else:
                        k = int(np.searchsorted(ends, s, side="right"))
                        number, begin, close = full + k, ends[k - 1] if k else full * window, ends[k]
                    e = min(stop, close)
                    lo, hi = s - r["at"], e - r["at"]
                    for name, value in (("doc_id", r["doc_id"]), ("start", r["start"] + lo), ("length", e - s), ("ids_crc32", zlib.crc32(ids[lo:hi].tobytes())),
                                        ("doc_tokens", r["doc_tokens"]), ("sequence_id", number * 3 + 2), ("offset", s - begin)):
                        out[name].append(value)
                    s = e
            yield pa.record_batch([pa.array(v, pa.int64()) for v in out.values()], names=list(out))
    return run


def pack(docs: DataFrame, tokenizer: str, end: int = 2, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """Per piece of docs(doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text is empty (one token, `end`); rows with null or equal doc_id are packed like others; other columns
    are ignored.  sequence_id is unique, not dense: 3k whole windows, 3k + 1 combinations, 3k + 2 the rest."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = saved(docs.mapInArrow(_pieces(tokenizer, end, window), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
                   .withColumn("piece", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = pieces.where(F.col("length") == window).withColumn("sequence_id", F.col("piece") * 3).withColumn("offset", F.lit(0).cast("long"))

    # rank of each remainder among those of its length: counts per partition of the table, then places in it
    short = pieces.where(F.col("length") < window).select("piece", "length", F.ceil(F.col("length") / unit).cast("long").alias("units"), F.shiftright("piece", 33).alias("shard"))
    counts = saved(short.groupBy("units", "shard").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("units").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = (short.withColumn("nth", F.row_number().over(Window.partitionBy("units", "shard").orderBy("piece")) - 1)
              .join(firsts.select("units", "shard", "first"), ["units", "shard"]).select("piece", "length", "units", (F.col("first") + F.col("nth")).alias("rank")))
    histogram = np.zeros(window // unit, np.int64)
    for r in counts.groupBy("units").agg(F.sum("n").alias("n")).collect():       # at most window / unit rows
        histogram[r["units"] - 1] = r["n"]
    runs: dict[int, tuple[list, list, int]] = {}
    sequence = 0
    for parts, times in plan(histogram) if histogram.any() else []:
        for length in parts:
            first, base, end_ = runs.setdefault(length, ([], [], 0))
            first.append(end_)
            base.append(sequence)
            runs[length] = (first, base, end_ + times)
        sequence += times
    slots = {u: (np.array([*f, e], np.int64), np.array(b, np.int64)) for u, (f, b, e) in runs.items()}
    placed = saved(ranked.mapInArrow(_places(spark.sparkContext.broadcast(slots)), "piece long, length long, combined long"), "placed")

    in_sequence = Window.partitionBy("combined").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    combined = placed.where("combined >= 0").select("piece", (F.col("combined") * 3 + 1).alias("sequence_id"),
                                                    F.coalesce(F.sum("length").over(in_sequence), F.lit(0)).alias("offset"))
    combined = pieces.drop("ids").join(combined, "piece")

    # the left-over stream: sums per shard, then places in it
    rest = placed.where("combined < 0").withColumn("shard", F.shiftright("piece", 33))
    sums = saved(rest.groupBy("shard").agg(F.sum("length").alias("n")), "sums")
    total = sums.agg(F.sum("n")).first()[0] or 0
    starts = sums.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    in_shard = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    at = (rest.withColumn("inner", F.coalesce(F.sum("length").over(in_shard), F.lit(0))).join(starts, "shard")
          .select("piece", (F.col("first") + F.col("inner")).alias("at")))
    chopped = (pieces.select("piece", "doc_id", "start", "length", "doc_tokens", "ids").join(at, "piece")
               .mapInArrow(_chopped(window, total), ", ".join(f"{c} long" for c in columns)))
    return whole.select(columns).unionByName(combined.select(columns)).unionByName(chopped)
