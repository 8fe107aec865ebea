"""Substring dedup by fixed-block anchors.

A window of ``window`` words holds, wherever it starts, one whole block of
``block = (window + 1) // 2`` words from a document's own grid of non-overlapping
blocks.  So every repeat shows as a rolling block in one document that equals a grid
block in another, and only the surroundings of such hits need the exact window test.

1. index and probe: documents are dealt into groups by a hash of their id; a group sends
   each distinct rolling block once, marked if it stands on a grid and if several documents
   of the group hold it.  A bucket answers those which stand on a grid somewhere and occur
   in more than one document.
2. extend: around each hit, the windows that contain it are sent as 80-bit keys (with the
   bucket over 86) and their smallest document; the answer names the windows that start in a document with a
   smaller id.
3. remove: in each document, the union of those windows: overlapping windows merge into
   maximal repeated spans.

Groups and buckets hold about ``GROUP_BYTES`` of text each, whatever the size of the corpus.  A passage
that a third of all documents share is one entry per group and key, never one per document.

Defined results: null or empty text has no words; a null doc_id neither removes nor loses
words; rows with equal doc_id do not remove from each other (no id is smaller); columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import textnp as T
from propensity.llm.common import blobs, bucket_of, group_count, pack48, slices, splits, unpack48

_U64 = np.uint64
_M46 = _U64((1 << 46) - 1)
_M48 = _U64((1 << 48) - 1)


def _parts(table: pa.Table):
    """Texts in bounded slices: ids (null: masked), words' spans and hashes, first word per document."""
    for i, j in slices(table, "text"):
        part = table.slice(i, j - i)
        ids = part.column("doc_id").combine_chunks() if isinstance(part, pa.Table) else part.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        buf, off = T.buffer_of(part.column("text"))
        starts, ends, first = T.word_spans(buf, off)
        yield part, doc, known, buf, starts, ends, first, T.word_hashes(buf, starts, ends)


def _anchors(words: np.ndarray, first: np.ndarray, known: np.ndarray, block: int):
    """Rolling blocks of the documents with an id: position, document, hash."""
    at, doc = T.inside(first, block)
    at, doc = at[known[doc]], doc[known[doc]]
    return at, doc, T.rolling(words, block, 7)[at]


def _lookup(h: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """A value for (bucket, 46 bits of the hash)."""
    return T.mix((h & _M46) ^ (bucket.astype(_U64) << _U64(46)))


def _windows(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return T.rolling(words, window, 11)[at], T.rolling(words, window, 12)[at] & _U64(0xFFFFFFFF)


def _composite(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a & _M48) + (b << _U64(32))


def _send_blocks(block: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        hs, grid, ids = [], [], []
        for _, doc, known, _, _, _, first, words in _parts(table):
            at, d, h = _anchors(words, first, known, block)
            hs.append(h)
            grid.append((at - first[:-1][d]) % block == 0)
            ids.append(doc[d])
        h, on_grid, doc = (np.concatenate(x) for x in (hs, grid, ids))
        order = np.lexsort((doc, h))
        h, doc, on_grid = h[order], doc[order], on_grid[order]
        cut = splits(h)
        lo = cut[:-1]
        if len(h):
            mark = np.logical_or.reduceat(on_grid, lo).astype(_U64) | ((doc[lo] != doc[cut[1:] - 1]).astype(_U64) << _U64(1))
        else:
            mark = np.zeros(0, _U64)
        h = h[lo]
        b = bucket_of(h, buckets)           # ascending with h
        value = (h & _M46) | (mark << _U64(46))
        runs = splits(b)
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array(b[runs[:-1]] if len(b) else [], pa.int64()),
                         "chunk": pa.array([chunk] * (len(runs) - 1), pa.int64()),
                         "entries": pa.array([pack48(value[s:e]) for s, e in zip(runs[:-1], runs[1:])], pa.binary())})
    return send


def _answer_blocks(table: pa.Table) -> pa.Table:
    """Blocks on a grid somewhere that more than one document holds, back to the groups that sent them."""
    entries = [unpack48(x) for x in blobs(table.column("entries"))]
    who = np.repeat(np.arange(len(entries)), [len(x) for x in entries])
    value = np.concatenate(entries)
    h, mark = value & _M46, value >> _U64(46)
    order = np.argsort(h, kind="stable")
    cut = splits(h[order])
    grid = np.bitwise_or.reduceat(mark[order], cut[:-1])
    shared = ((grid & _U64(1)) > 0) & (((grid & _U64(2)) > 0) | (np.diff(cut) > 1))
    keep = np.zeros(len(h), bool)
    keep[order] = np.repeat(shared, np.diff(cut))
    h, who = h[keep], who[keep]
    runs = splits(who)
    rows = who[runs[:-1]] if len(who) else np.zeros(0, np.int64)
    return pa.table({"chunk": table.column("chunk").combine_chunks().take(pa.array(rows)),
                     "bucket": table.column("bucket").combine_chunks().take(pa.array(rows)),
                     "hits": pa.array([pack48(h[s:e]) for s, e in zip(runs[:-1], runs[1:])] if len(who) else [], pa.binary())})


def _send_windows(block: int, window: int, buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        none = pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "docs": pa.array([], pa.binary()),
                         "counts": pa.array([], pa.binary()), "multi": pa.array([], pa.binary()), "keys": pa.array([], pa.binary()), "keys2": pa.array([], pa.binary())})
        if not answers.num_rows or not docs.num_rows:
            return none
        hits = np.sort(np.concatenate([_lookup(unpack48(x), np.full(len(x) // 6, b)) for x, b in
                                       zip(blobs(answers.column("hits")), answers.column("bucket").to_pylist())]))
        a_all, b_all, ids = [], [], []
        for _, doc, known, _, _, _, first, words in _parts(docs):
            at, d, h = _anchors(words, first, known, block)
            seek = _lookup(h, bucket_of(h, buckets))
            found = hits[np.minimum(np.searchsorted(hits, seek), len(hits) - 1)] == seek
            seen = np.zeros(len(words) + 1, np.int64)
            seen[at[found] + 1] = 1
            seen = np.cumsum(seen)
            w, d = T.inside(first, window)
            near = known[d] & (seen[w + window - block + 1] > seen[w])
            w, d = w[near], d[near]
            a, b = _windows(words, w, window)
            a_all.append(a)
            b_all.append(b)
            ids.append(doc[d])
        a, b, doc = (np.concatenate(x) for x in (a_all, b_all, ids))
        if not len(a):
            return none
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        lo = np.flatnonzero(new)
        hi = np.r_[lo[1:], len(a)] - 1
        multi = doc[lo] != doc[hi]
        a, b, doc = a[lo], b[lo], doc[lo]
        bucket = bucket_of(a, buckets)
        order = np.lexsort((a, doc, bucket))
        a, b, doc, multi, bucket = (x[order] for x in (a, b, doc, multi, bucket))
        out = {k: [] for k in none.column_names}
        chunk = docs.column("chunk")[0].as_py()
        runs = splits(bucket)
        for s, e in zip(runs[:-1], runs[1:]):
            inner = splits(doc[s:e])
            out["bucket"].append(int(bucket[s]))
            out["chunk"].append(chunk)
            out["docs"].append(doc[s:e][inner[:-1]].tobytes())
            out["counts"].append(np.diff(inner).astype("<u4").tobytes())
            out["multi"].append(np.packbits(multi[s:e]).tobytes())
            out["keys"].append(pack48(a[s:e]))
            out["keys2"].append(b[s:e].astype("<u4").tobytes())
        return pa.table({k: pa.array(v, none.schema.field(k).type) for k, v in out.items()})
    return send


def _answer_windows(table: pa.Table) -> pa.Table:
    """For each group its windows that start in a document with a smaller id than some document of the group:
    `before` where that document is elsewhere, `own` where it is the smallest of the group itself."""
    a, b, doc, multi = [], [], [], []
    cols = {k: blobs(table.column(k)) for k in ("docs", "counts", "multi", "keys", "keys2")}
    for ds, cs, ms, ks, k2 in zip(*cols.values()):
        a.append(unpack48(ks))
        b.append(np.frombuffer(k2, "<u4").astype(_U64))
        doc.append(np.repeat(np.frombuffer(ds, np.int64), np.frombuffer(cs, "<u4")))
        multi.append(np.unpackbits(np.frombuffer(ms, np.uint8))[:len(a[-1])].astype(bool))
    who = np.repeat(np.arange(len(a)), [len(x) for x in a])
    a, b, doc, multi = (np.concatenate(x) for x in (a, b, doc, multi))
    order = np.lexsort((doc, b, a))
    sa, sb = a[order], b[order]
    lo = np.flatnonzero(np.r_[True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
    least = np.empty(len(a), np.int64)
    least[order] = np.repeat(doc[order][lo], np.diff(np.r_[lo, len(a)]))
    before, own = least < doc, (least == doc) & multi
    code = _composite(a, b)
    chunk = table.column("chunk").to_pylist()
    cut = np.searchsorted(who, np.arange(len(chunk) + 1))
    rows = [(c, code[s:e][before[s:e]].tobytes(), code[s:e][own[s:e]].tobytes()) for c, s, e in zip(chunk, cut[:-1], cut[1:]) if (before[s:e] | own[s:e]).any()]
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()), "before": pa.array([r[1] for r in rows], pa.binary()),
                     "own": pa.array([r[2] for r in rows], pa.binary())})


_RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept_text string, kept_sha256 string"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPAN),
                    ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _remove(window: int, with_text: bool):
    def codes(answers: pa.Table, name: str) -> np.ndarray:
        got = [np.frombuffer(x, "<u8") for x in blobs(answers.column(name))]
        return np.unique(np.concatenate(got)) if got else np.zeros(0, _U64)

    def among(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
        return keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x if len(keys) else np.zeros(len(x), bool)

    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        before, own = codes(answers, "before"), codes(answers, "own")
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "spans", "kept_text", "kept_sha256")}

        def hits(doc, known, first, words):
            w, d = T.inside(first, window)
            w, d = w[known[d]], d[known[d]]
            if not len(before) and not len(own):
                return w[:0], d[:0], np.zeros(0, _U64), np.zeros(0, bool), np.zeros(0, bool)
            code = _composite(*_windows(words, w, window))
            x, y = among(before, code), among(own, code)
            keep = x | y
            return w[keep], d[keep], code[keep], x[keep], y[keep]

        if len(own):
            first_doc = np.full(len(own), np.iinfo(np.int64).max)
            for _, doc, known, _, _, _, first, words in _parts(docs):
                _, d, code, _, y = hits(doc, known, first, words)
                np.minimum.at(first_doc, np.searchsorted(own, code[y]), doc[d[y]])
        for part, doc, known, buf, starts, ends, first, words in _parts(docs):
            w, d, code, x, y = hits(doc, known, first, words)
            if len(own):
                later = np.zeros(len(w), bool)
                later[y] = doc[d[y]] > first_doc[np.searchsorted(own, code[y])]
                w = w[x | later]
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, w, 1)
            np.add.at(edge, w + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
            counts = np.r_[0, np.cumsum(gone)]
            removed = counts[first[1:]] - counts[first[:-1]]
            raw = buf.tobytes()
            off = np.r_[starts, len(raw)]
            texts = part.column("text").to_pylist()
            for i, n in enumerate(removed):
                lo, hi = int(first[i]), int(first[i + 1])
                each = (texts[i] or "").encode().split()
                runs: list[dict] = []
                if n:
                    g = gone[lo:hi]
                    cut = np.flatnonzero(np.diff(np.r_[0, g.astype(np.int8), 0]))
                    runs = [{"start": int(s), "length": int(e - s)} for s, e in zip(cut[::2], cut[1::2])]
                    kept, at = [], 0
                    for r in runs:
                        kept += each[at:r["start"]]
                        at = r["start"] + r["length"]
                    each = kept + each[at:]
                left = b" ".join(each)
                out["spans"].append(runs)
                out["kept_text"].append(left.decode() if with_text else None)
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            out["doc_id"].append(part.column("doc_id"))
            out["n_words"].append(np.diff(first))
            out["n_removed"].append(removed)
        ids = pa.chunked_array([c for x in out["doc_id"] for c in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])], pa.int64())
        cols = [ids, np.concatenate(out["n_words"]), np.concatenate(out["n_removed"]), out["spans"], out["kept_text"], out["kept_sha256"]]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)
    return remove


def substring_dedup(docs: DataFrame, window: int = 13, with_text: bool = True) -> DataFrame:
    """Per row of docs(doc_id, text): word count, removed words, the removed spans (word offsets),
    the kept words joined by one space, and that text's SHA-256.

    A word goes if a window of `window` words that covers it also starts in a document with a
    smaller doc_id; windows are those of the input texts."""
    block = (window + 1) // 2
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = group_count(docs)
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n)))
    blocks = (docs.groupBy("chunk").applyInArrow(_send_blocks(block, n), "bucket long, chunk long, entries binary")
              .groupBy("bucket").applyInArrow(_answer_blocks, "chunk long, bucket long, hits binary"))
    windows = (docs.groupBy("chunk").cogroup(blocks.groupBy("chunk"))
               .applyInArrow(_send_windows(block, window, n), "bucket long, chunk long, docs binary, counts binary, multi binary, keys binary, keys2 binary")
               .groupBy("bucket").applyInArrow(_answer_windows, "chunk long, before binary, own binary"))
    keep = _remove(window, with_text)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return keep(left, right) if left.num_rows else _ARROW.empty_table()
    return docs.groupBy("chunk").cogroup(windows.groupBy("chunk")).applyInArrow(finish, _RESULT)
