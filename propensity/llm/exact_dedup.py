"""Exact dedup by deterministic block naming.

Each normalised text is cut into blocks of `block` bytes.  Distinct blocks are sorted and
numbered; then adjacent numbers are paired, distinct pairs sorted and numbered, and so on
until a document has one number.  Two documents have the same (level, number) exactly if
their texts are equal.

Block contents travel once: per 128-bit digest the smallest and the largest content meet.  Where they
agree, the digest stands for that one content and the numbers are joined by digest; if any digest
ever had two contents, all blocks are named by content instead (slower, as exact).
A hot block or a large group of copies is one row per task after partial aggregation, and the
joins back are plain shuffled joins that adaptive execution can split."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import saved, slices

BLOCK = 4096
#: Text bytes that a worker holds as Python objects at once.
SLICE_BYTES = 2 << 20


def _normal(part):
    """A-Z folded, UTF-8; null counts as empty."""
    return ((x.as_py() or "").encode().lower() for x in part.column("text"))


def _key(text: bytes) -> int:
    """Tells rows apart that share a doc_id; never an identity by itself."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _rows(batches):
    for batch in batches:
        for i, j in slices(batch, "text", SLICE_BYTES):
            part = batch.slice(i, j - i)
            texts = list(_normal(part))
            yield pa.record_batch([part.column("doc_id"), pa.array([_key(x) for x in texts], pa.int64()), pa.array([len(x) for x in texts], pa.int64()),
                                   pa.array([hashlib.sha256(x).hexdigest() for x in texts])], names=["doc_id", "h", "n_bytes", "text_sha256"])


def _contents(block: int, digest: int):
    """Distinct blocks of each slice with their digests."""
    def run(batches):
        for batch in batches:
            for i, j in slices(batch, "text", SLICE_BYTES):
                seen = {x[s:s + block] for x in _normal(batch.slice(i, j - i)) for s in range(0, max(len(x), 1), block)}
                seen = list(seen)
                yield pa.record_batch([pa.array([hashlib.blake2b(x, digest_size=digest).digest() for x in seen], pa.binary()), pa.array(seen, pa.binary())],
                                      names=["digest", "content"])
    return run


def _places(block: int, digest: int, with_content: bool):
    """One row per document and block."""
    def run(batches):
        for batch in batches:
            for i, j in slices(batch, "text", SLICE_BYTES):
                part = batch.slice(i, j - i)
                out = {"doc_id": [], "h": [], "pos": [], "blocks": [], "digest": []}
                for doc, text in zip(part.column("doc_id").to_pylist(), _normal(part)):
                    cuts = range(0, max(len(text), 1), block)
                    key = _key(text)
                    for p, s in enumerate(cuts):
                        piece = text[s:s + block]
                        out["doc_id"].append(doc)
                        out["h"].append(key)
                        out["pos"].append(p)
                        out["blocks"].append(len(cuts))
                        out["digest"].append(piece if with_content else hashlib.blake2b(piece, digest_size=digest).digest())
                yield pa.record_batch([pa.array(out["doc_id"], pa.int64()), pa.array(out["h"], pa.int64()), pa.array(out["pos"], pa.int64()),
                                       pa.array(out["blocks"], pa.int64()), pa.array(out["digest"], pa.binary())], names=list(out))
    return run


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Distinct rows with integer names: sorted within partitions, numbered by partition and place, kept as a table."""
    return saved(distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id()), "names")


def block_identities(docs: DataFrame, block: int = BLOCK, digest: int = 16) -> DataFrame:
    """(doc_id, h, level, name) of each distinct (doc_id, text): equal level and name, equal normalised text."""
    contents = docs.mapInArrow(_contents(block, digest), "digest binary, content binary")
    met = contents.groupBy("digest").agg(F.min("content").alias("content"), (F.min("content") != F.max("content")).alias("clash"))
    names = saved(met.sortWithinPartitions("content").select("digest", "clash", F.monotonically_increasing_id().alias("name")), "names")
    clash = not names.where("clash").isEmpty()
    if clash:
        names = _numbered(contents.select(F.col("content").alias("digest")).distinct(), ["digest"])
    places = docs.mapInArrow(_places(block, digest, clash), "doc_id long, h long, pos long, blocks long, digest binary")
    rows = saved(places.join(names.select("digest", "name"), "digest").select("doc_id", "h", "pos", "blocks", "name"), "level")
    level, done = 0, None
    while True:
        single = rows.where("blocks = 1").select("doc_id", "h", F.lit(level).alias("level"), "name").distinct()
        done = single if done is None else done.unionByName(single)
        rows = rows.where("blocks > 1")
        if rows.isEmpty():
            return done
        even = F.col("pos") % 2 == 0
        pairs = saved(rows.groupBy("doc_id", "h", "blocks", F.floor(F.col("pos") / 2).alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("r")), "pairs")
        names = _numbered(pairs.select("l", "r").distinct(), ["l", "r"])
        rows = saved(pairs.join(names, ["l", "r"]).select("doc_id", "h", "pos", F.ceil(F.col("blocks") / 2).alias("blocks"), "name"), "level")
        level += 1


def exact_dedup(docs: DataFrame, block: int = BLOCK, digest: int = 16) -> DataFrame:
    """Per row of docs(doc_id, text): keep_id (the largest doc_id of its group of equal texts), group_size,
    kept, text_sha256, and the identity (level, name).

    Texts are equal if identical after folding A-Z; null counts as empty.  A null doc_id stays only in a
    group without any other; repetitions of the row that stays all stay, being the same document.
    Columns other than doc_id and text are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = docs.mapInArrow(_rows, "doc_id long, h long, n_bytes long, text_sha256 string")
    named = block_identities(docs, block, digest)
    i = named.select(F.col("doc_id").alias("i_doc"), F.col("h").alias("i_h"), "level", "name")
    rows = saved(rows.join(i, F.col("doc_id").eqNullSafe(F.col("i_doc")) & (F.col("h") == F.col("i_h"))).drop("i_doc", "i_h", "h", "n_bytes"), "rows")
    groups = rows.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return (rows.join(groups, ["level", "name"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "level", "name"))
