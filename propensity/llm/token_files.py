"""Token files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Format (two tables in the shared folder, written by Spark's committer so a lost executor leaves no half file):

* `ranks`: rank, id.  Rank 0 is the most frequent id of the whole corpus (ties by id).
* `blocks`: part, block, then per block the documents' ids (`docs`, 64-bit; `known` marks those that are
  not null) and token counts (`counts`, 32-bit), `control` and `data`.  A token is its rank in one to four
  little-endian bytes; a control byte holds four two-bit lengths less one.  Documents stand in ascending
  doc_id order through parts and blocks.

Texts are dealt by ranges of doc_id and sorted before they are encoded, so every later step reads
parts that are already in order.  What reaches the driver is one count per vocabulary entry."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import blobs, saved, slices
from propensity.llm.tokens import encoder

#: Tokens a block aims at; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 19
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def _width(longest: int) -> int:
    """Bytes of the narrowest unsigned type that holds values of that many bytes."""
    return longest if longest < 3 else 4


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    top = int(values.max(initial=0))
    width = _width(max(1, (top.bit_length() + 7) // 8))
    v = values.astype(f"<u{width}")
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    for bits in range(8, 8 * width, 8):
        code[:len(v)] += v >> bits > 0
    data = v.view(np.uint8).reshape(-1, width)[np.arange(width, dtype=np.uint8) <= code[:len(v), None]]
    code = code.reshape(-1, 4)
    return (code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values back: lengths by table lookup, bytes to their places by one mask."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    width = _width(int(size.max(initial=1)))
    out = np.zeros((n, width), np.uint8)
    out[np.arange(width, dtype=np.uint8) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view(f"<u{width}").astype("<u4")


@dataclass
class TokenFiles:
    ranks: DataFrame
    blocks: DataFrame


def _encode(path: str, end: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        enc = encoder(path, end)
        nth = 0
        for batch in batches:
            for i, j in slices(batch, "text", 2 << 20):
                piece = batch.slice(i, j - i)
                ids = enc.encode(piece.column("text"))
                yield pa.record_batch([pa.array([part] * len(ids), pa.int64()), pa.array(range(nth, nth + len(ids)), pa.int64()), piece.column("doc_id"),
                                       pa.array([x.astype(enc.kind).tobytes() for x in ids], pa.binary())], names=["part", "nth", "doc_id", "ids"])
                nth += len(ids)
    return run


def _count(width: int, vocabulary: int):
    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            buf = np.frombuffer(b"".join(blobs(batch.column("ids"))), f"<u{width}")
            total += np.bincount(buf, minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])
    return run


def _blocks(width: int, rank_of):
    def block(part, number, docs, known, ids):
        counts = np.array([len(x) // width for x in ids], "<u4")
        control, data = encode_values(rank_of.value[np.frombuffer(b"".join(ids), f"<u{width}")])
        return [part, number, len(docs), int(counts.sum()), np.array(docs, "<i8").tobytes(), np.packbits(np.array(known, bool)).tobytes(), counts.tobytes(), control, data]

    names = ["part", "block", "n_docs", "n_tokens", "docs", "known", "counts", "control", "data"]
    kinds = [pa.int64()] * 4 + [pa.binary()] * 5

    def run(batches):
        part, number, docs, known, ids, held = None, 0, [], [], [], 0
        for batch in batches:
            out = []
            for p, nth, d, x in zip(*(batch.column(c).to_pylist() for c in ("part", "nth")), batch.column("doc_id").to_pylist(), blobs(batch.column("ids"))):
                if docs and (p != part or held + len(x) // width > BLOCK_TOKENS):
                    out.append(block(part, number, docs, known, ids))
                    docs, known, ids, held = [], [], [], 0
                if not docs:
                    part, number = p, nth
                docs.append(d or 0)
                known.append(d is not None)
                ids.append(bytes(x))
                held += len(x) // width
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        if docs:
            yield pa.record_batch([pa.array([c], k) for c, k in zip(block(part, number, docs, known, ids), kinds)], names=names)
    return run


def write_token_files(docs: DataFrame, tokenizer: str, end: int = 2) -> TokenFiles:
    """Encode every whole text of docs(doc_id, text), null as empty, with `end` appended, in ascending doc_id order
    (null ids first; equal ids in any order).  `tokenizer` is the path of a tokenizer file that every executor has."""
    enc = encoder(tokenizer, end)
    width, vocabulary = int(enc.kind[2:]), 1 << 16 if enc.kind == "<u2" else enc.vocabulary
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ids = saved(ordered.mapInArrow(_encode(tokenizer, end), "part long, nth long, doc_id long, ids binary"), "token_ids")
    counts = ids.select("ids").mapInArrow(_count(width, vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))        # at most one row per vocabulary entry
    rank_of = np.zeros(vocabulary, "<u4")
    rank_of[[r["id"] for r in ranked]] = np.arange(len(ranked))
    spark = docs.sparkSession
    ranks = saved(spark.createDataFrame([(n, r["id"]) for n, r in enumerate(ranked)], "rank long, id long").coalesce(1), "ranks")
    blocks = saved(ids.mapInArrow(_blocks(width, spark.sparkContext.broadcast(rank_of)),
                                  "part long, block long, n_docs long, n_tokens long, docs binary, known binary, counts binary, control binary, data binary"), "blocks")
    return TokenFiles(ranks, blocks)


def read_token_files(files: TokenFiles, with_ids: bool = True) -> DataFrame:
    """Per document, from the files: doc_id, start (tokens before it), n_tokens, ids_crc32, ids."""
    spark = files.blocks.sparkSession
    rows = files.ranks.collect()
    id_of = np.zeros(len(rows), "<u4")
    id_of[[r["rank"] for r in rows]] = [r["id"] for r in rows]
    id_of = spark.sparkContext.broadcast(id_of)

    # sums per part are one row per part; within a part, one row per block
    parts = files.blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.blocks.select("part", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("block_start"))
    starts = saved(starts.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("block_start")).alias("first")), "starts")

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                counts = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                ids = id_of.value[decode_values(r["control"], r["data"], int(counts.sum()))]
                cut = np.r_[0, np.cumsum(counts)]
                known = np.unpackbits(np.frombuffer(r["known"], np.uint8))[:len(counts)].astype(bool)
                pieces = [ids[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])]
                yield pa.record_batch([pa.array(np.frombuffer(r["docs"], "<i8"), mask=~known), pa.array(cut[:-1] + r["first"]), pa.array(counts),
                                       pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
                                       pa.array([np.frombuffer(x, "<u4").astype(np.int64) if with_ids else None for x in pieces], pa.list_(pa.int64()))],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
    return (files.blocks.join(starts, ["part", "block"]).select("first", "docs", "known", "counts", "control", "data")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>"))
