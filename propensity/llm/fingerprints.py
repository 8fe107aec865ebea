"""Document fingerprints by I-Match over randomised lexicon subsets.

Terms are words hashed to CELLS cells; a cell's document frequency is counted over all documents.  The lexicon
is the band of cells whose inverse document frequency lies between two bounds.  For each of SUBSETS
random orders of the lexicon there are nested subsets, each half as large as the one before.  A document's level
is the one at which about one of its distinct lexicon terms is expected in a subset; its fingerprint has, for
that level and the next, one 16-bit hash per order of the sorted distinct terms in that subset (0: none).
The likeness of two fingerprints is the share of equal hashes among the orders where either has a term, on the
better of their common levels: a third of the text can change while many small subsets see none of it.

The lexicon is CELLS bits and is broadcast; counts reach the driver as CELLS / RANGES sums per range."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm import textnp as T
from propensity.llm.common import blobs, saved, slices

CELLS, RANGES, SUBSETS = 1 << 20, 64, 32
#: Inverse document frequency (natural logarithm of documents per document with the term), at least and at most.
BAND = (2.5, 14.0)
_U64 = np.uint64
_SALTS = np.random.default_rng(11).integers(1, 2**63, SUBSETS, dtype=_U64) | _U64(1)
#: Below so many lexicon terms, all terms of the text count as lexicon terms.
FEW = 4


def _terms(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, cell), sorted."""
    buf, off = T.buffer_of(texts)
    starts, ends, first = T.word_spans(buf, off)
    cell = (T.word_hashes(buf, starts, ends) >> _U64(44)).astype(np.int64)
    code = np.unique(np.repeat(np.arange(len(first) - 1), np.diff(first)) * CELLS + cell)
    return code // CELLS, code % CELLS


def _frequencies(batches):
    total, docs = np.zeros(CELLS, np.int64), 0
    for batch in batches:
        docs += len(batch)
        for i, j in slices(batch, "text"):
            total += np.bincount(_terms(batch.slice(i, j - i).column("text"))[1], minlength=CELLS)
    per = CELLS // RANGES
    rows = []
    for r in range(RANGES):
        used = np.flatnonzero(total[r * per:(r + 1) * per])
        rows.append((r, docs if r == 0 else 0, used.astype("<u4").tobytes(), total[r * per + used].astype("<i8").tobytes()))
    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["part", "docs", "cells", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(CELLS // RANGES, np.int64)
    for cells, counts in zip(blobs(table.column("cells")), blobs(table.column("counts"))):
        total[np.frombuffer(cells, "<u4")] += np.frombuffer(counts, "<i8")
    docs = int(np.sum(table.column("docs").to_numpy()))
    return pa.table({"part": [table.column("part")[0].as_py()], "docs": [docs], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """True for each cell in the band, from the counts of all documents."""
    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies, "part long, docs long, cells binary, counts binary")
            .groupBy("part").applyInArrow(_summed, "part long, docs long, counts binary").collect())
    df = np.zeros(CELLS, np.int64)
    per = CELLS // RANGES
    for r in rows:
        df[r["part"] * per:(r["part"] + 1) * per] = np.frombuffer(r["counts"], "<i8")
    idf = np.log(max(1, sum(r["docs"] for r in rows)) / np.maximum(df, 1))
    return (df > 0) & (idf >= band[0]) & (idf <= band[1])


def fingerprint(texts, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level per text (-1: no word), and (texts x 2 x SUBSETS) hashes at that level and the next."""
    n = len(texts)
    doc, cell = _terms(texts)
    inside = keep[cell]
    few = np.bincount(doc[inside], minlength=n) < FEW
    inside |= few[doc]
    doc, cell = doc[inside], cell[inside]
    m = np.bincount(doc, minlength=n)
    level = np.where(m > 0, np.maximum(0, np.rint(np.log2(np.maximum(m, 1)))), -1).astype(np.int64)
    out = np.zeros((n, 2, SUBSETS), np.uint16)
    if len(doc):
        first = np.searchsorted(doc, np.arange(n))
        held = np.flatnonzero(m)
        place = (np.arange(len(doc)) - first[doc]).astype(_U64)      # terms are sorted within a document
        for k, salt in enumerate(_SALTS):
            rank = T.mix(cell.astype(_U64) * _U64(0x9E3779B97F4A7C15) ^ salt)
            term = T.mix(rank ^ _U64(0x632BE59BD9B4E019))
            for step in (0, 1):
                within = (rank >> _U64(11)).astype(np.float64) * 2.0**-53 < np.exp2(-(level[doc] + step).astype(float))
                value = np.where(within, term, _U64(0))
                sums = np.add.reduceat(value, first[held])
                some = np.add.reduceat(within.astype(np.int64), first[held]) > 0
                out[held, step, k] = np.where(some, T.mix(sums) % _U64(65535) + _U64(1), 0).astype(np.uint16)
    return level, out


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1; texts without words are only like each other."""
    (la, x), (lb, y) = a, b
    if la < 0 or lb < 0:
        return float(la == lb)
    best = 0.0
    for i in (0, 1):
        j = la + i - lb
        if 0 <= j <= 1:
            either = (x[i] > 0) | (y[j] > 0)
            if either.any():
                best = max(best, float((x[i] == y[j])[either].mean()))
            elif la == lb and np.array_equal(x, y):
                best = 1.0
    return 1.0 if la == lb and np.array_equal(x, y) else best


def as_text(level: int, hashes: np.ndarray) -> str:
    return "" if level < 0 else f"{level:02d}:" + hashes.astype(">u2").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """text with its last quarter of code points replaced by the first as many of the following text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(rows: list[tuple], nexts: list[str], keep: np.ndarray, prints=None):
    """Results of rows (doc_id, text, level, hashes) given the following texts and their fingerprints."""
    edited = [edited_text(r[1], x) for r, x in zip(rows, nexts)]
    level, hashes = fingerprint(pa.array(edited, pa.large_string()), keep)
    if prints is None:
        prints = list(zip(*fingerprint(pa.array(nexts, pa.large_string()), keep)))
    cols = [[r[0] for r in rows], [len(r[1]) for r in rows], [hashlib.sha256(x.encode()).hexdigest() for x in edited], [as_text(r[2], r[3]) for r in rows],
            [as_text(int(a), b) for a, b in zip(level, hashes)], [likeness((r[2], r[3]), (int(a), b)) for r, a, b in zip(rows, level, hashes)],
            [likeness((r[2], r[3]), (int(p[0]), p[1])) for r, p in zip(rows, prints)]]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array(c, k) for c, k in zip(cols, kinds)]


def _in_order(keep):
    """Over documents sorted by doc_id: each with the one after it.  A partition's first text and last document are
    kept for the step across partitions."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "first_text", "last_text"]

    def emit(cols, part, first=None, last=None):
        n = len(cols[0])
        return pa.record_batch([*cols, pa.array([part] * n, pa.int64()), pa.array([first] * n, pa.string()), pa.array([last] * n, pa.string())], names=names)

    def single(doc):
        return [pa.array([doc], pa.int64()), pa.array([None], pa.int64()), *(pa.array([None], pa.string()) for _ in range(3)), *(pa.array([None], pa.float64()) for _ in range(2))]

    def run(batches):
        part, held, begun = TaskContext.get().partitionId(), None, False
        for batch in batches:
            for i, j in slices(batch, "text", 2 << 20):
                piece = batch.slice(i, j - i)
                texts = [x or "" for x in piece.column("text").to_pylist()]
                level, hashes = fingerprint(pa.array(texts, pa.large_string()), keep.value)
                rows = list(zip(piece.column("doc_id").to_pylist(), texts, level.tolist(), hashes))
                if not begun:
                    begun = True
                    yield emit(single(None), part, first=texts[0])
                if held is not None:
                    rows.insert(0, held)
                held = rows[-1]
                if len(rows) > 1:
                    yield emit(_pairs(rows[:-1], [r[1] for r in rows[1:]], keep.value, [(r[2], r[3]) for r in rows[1:]]), part)
        if held is not None:
            yield emit(single(held[0]), part, last=held[1])
    return run


def _across(keep):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            level, hashes = fingerprint(pa.array([r["last_text"] for r in rows], pa.large_string()), keep.value)
            mine = [(r["doc_id"], r["last_text"], int(a), b) for r, a, b in zip(rows, level, hashes)]
            yield pa.record_batch(_pairs(mine, [r["first_text"] for r in rows], keep.value), names=[c.split()[0] for c in _COLUMNS.split(", ")])
    return run


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Per row of docs(doc_id, text): n_chars, the fingerprint, that of the edited text (its last quarter replaced by the
    beginning of the next document's text in ascending doc_id; after the last one, the first's), and two likenesses.

    Null text is empty; null doc_ids come first and rows with equal doc_id in the order of a text hash;
    other columns are ignored; an empty table gives an empty result."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keep = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    out = saved(ordered.mapInArrow(_in_order(keep), _COLUMNS + ", part long, first_text string, last_text string"), "fingerprints")
    columns = [c.split()[0] for c in _COLUMNS.split(", ")]
    inner = out.where("first_text IS NULL AND last_text IS NULL").select(columns)
    # one row per partition from here: the next partition that has documents, the first one after the last
    parts = out.where("first_text IS NOT NULL").select("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    last = out.where("last_text IS NOT NULL").select("doc_id", "part", "last_text").join(following, "part")
    first = out.where("first_text IS NOT NULL").select(F.col("part").alias("next_part"), "first_text")
    edge = last.join(first, "next_part").select("doc_id", "last_text", "first_text").mapInArrow(_across(keep), _COLUMNS)
    return inner.unionByName(edge)
