"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

An index is a folder of Spark tables in generations, one for each insertion or deletion:

    lines    the distinct line keys of each document, as it was inserted
    refs     per key: documents that hold it, the smallest of them, and the count before this generation
    filters  per shard of keys two cuckoo filters: keys that any document holds, keys that several hold
    gone     documents deleted in this generation
    commits  written last; a generation without it does not exist and is written anew

An insertion probes its keys in the first filter.  A miss proves that a key is new, so only hits are
looked up in the exact table.  A deletion takes a document's keys off the counts; a key at zero leaves the
first filter, a key at one the second, and a key that lost its smallest document gets the next one from
the lines of the documents that are left.  The index is then the one that the rest alone would have given.
Applying the index to documents probes the second filter: most lines occur once and end there.

Filters decide nothing by themselves, they only spare lookups: every line dropped is found in the exact
table.  A key is the line stripped and folded, named by 128 bits of its sha256: two different keys meet
with probability below n^2 / 2^129 for n keys.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.common import GROUP_BYTES, group_count, saved, slices
from propensity.llm.cuckoo import CuckooFilter
from propensity.session import ensure_checkpoint_dir

#: Least code points of a key that can be dropped.
LEAST = 10
#: Text bytes per shard of keys and per group of documents.
SHARD_BYTES = 4 * GROUP_BYTES

SCHEMAS = {
    "lines": "doc_id long, keys array<binary>, gen int",
    "refs": "shard int, key binary, n long, first long, was long, gen int",
    "filters": "shard int, held binary, shared binary, gen int",
    "gone": "doc_id long, gen int",
}


def line_key(line: bytes, least: int) -> bytes | None:
    """The name of a line's key, or None if the key is too short to be dropped."""
    key = line.strip().lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return hashlib.sha256(key).digest()[:16]


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch, "text"):
                part = batch.slice(i, j - i)
                keys = [list(dict.fromkeys(k for line in t.split(b"\n") if (k := line_key(line, least)))) for t in _texts(part)]
                yield pa.record_batch([part.column("doc_id"), pa.array(keys, pa.list_(pa.binary()))], names=["doc_id", "keys"])
    return run


def _asks(least: int):
    """Per slice: each key and chunk once, with the largest document that asks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch, "text"):
                part = batch.slice(i, j - i)
                last: dict[tuple, int] = {}
                for doc, chunk, text in zip(part.column("doc_id").to_pylist(), part.column("chunk").to_pylist(), _texts(part)):
                    for line in text.split(b"\n"):
                        k = line_key(line, least)
                        if k and doc > last.get((k, chunk), doc - 1):
                            last[k, chunk] = doc
                yield pa.record_batch([pa.array([k for k, _ in last], pa.binary()), pa.array([c for _, c in last], pa.int32()),
                                       pa.array(last.values(), pa.int64())], names=["key", "chunk", "last"])
    return run


def _hashes(column) -> np.ndarray:
    """The half of each key's name that the filters use."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)[:, 1]


def _state(table: pa.Table, which: str) -> CuckooFilter:
    return CuckooFilter.load(table.column(which)[0].as_py() if table.num_rows else None)


def _probed(which: str, keep_all: bool):
    """Rows of a shard with whether the filter may hold their key, or only those it may hold."""
    def run(_key, rows: pa.Table, state: pa.Table) -> pa.Table:
        found = pa.array(_state(state, which).contains(_hashes(rows.column("key"))))
        return rows.append_column("maybe", found) if keep_all else rows.filter(found)
    return run


def _moved(key, rows: pa.Table, state: pa.Table) -> pa.Table:
    """A shard's filters after its counts went from was to n; nothing for a shard without changes."""
    h = _hashes(rows.column("key"))
    n, was = (rows.column(c).to_numpy() for c in ("n", "was"))
    blobs = []
    for which, least in (("held", 1), ("shared", 2)):
        f = _state(state, which)
        f.delete(h[(was >= least) & (n < least)])
        f.insert(h[(was < least) & (n >= least)])
        blobs.append(f.dump())
    moved = pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "held": pa.array(blobs[:1], pa.binary()), "shared": pa.array(blobs[1:], pa.binary())})
    return moved if rows.num_rows else moved.slice(0, 0)


def _dropped(least: int, with_text: bool):
    """Streams rows sorted by chunk, the chunk's answers (kind 0) before its documents (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, first = None, {}
        for batch in batches:
            for i, j in slices(batch, "text"):
                part = batch.slice(i, j - i)
                out: list[tuple] = []
                kinds = part.column("kind").to_pylist()
                texts = _texts(part)
                for r, c in enumerate(part.column("chunk").to_pylist()):
                    if c != chunk:
                        chunk, first = c, {}
                    if kinds[r] == 0:
                        first[part.column("key")[r].as_py()] = part.column("first")[r].as_py()
                        continue
                    doc = part.column("doc_id")[r].as_py()
                    lines = texts[r].split(b"\n")
                    kept = lines
                    if first and doc is not None:
                        kept = [x for x in lines if (k := line_key(x, least)) is None or first.get(k, doc) >= doc]
                    text = b"\n".join(kept)
                    out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None))
                cols = list(zip(*out)) or [()] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                      names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"])
    return run


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


class LineIndex:
    """The lines of a growing and shrinking set of documents.

    Null text counts as empty.  Rows without doc_id are not indexed and lose no line.  Several rows with one doc_id
    are one document for all decisions, and are inserted and deleted together; inserting a
    document again adds to it, so delete it first to replace it.  Columns other than doc_id and text are ignored."""

    def __init__(self, spark: SparkSession, path: str, shards: int, gens: list[int], least: int):
        #: gens[0] is where the index starts (empty, or the generation before the last compaction).
        self.spark, self.path, self.shards, self.gens, self.least = spark, path, shards, gens, least

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, shards: int = 64, least: int = LEAST) -> LineIndex:
        """An empty index; shards should grow with the text it is going to hold (one for each SHARD_BYTES)."""
        path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/line-index-{uuid.uuid4().hex[:12]}"
        index = cls(spark, path, shards, [], least)
        index._commit(0)
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        done = spark.read.schema("gen int, base int, shards int, least int").json(f"{path}/commits/*").orderBy("gen").collect()
        last = done[-1]
        return cls(spark, path, last["shards"], [last["base"]] + [r["gen"] for r in done if r["gen"] > last["base"]], last["least"])

    def _commit(self, gen: int) -> None:
        base = self.gens[0] if self.gens else gen
        row = self.spark.range(1).select(F.lit(gen).alias("gen"), F.lit(base).alias("base"), F.lit(self.shards).alias("shards"), F.lit(self.least).alias("least"))
        row.write.mode("overwrite").json(f"{self.path}/commits/{gen:06d}")
        self.gens.append(gen)

    def _write(self, df: DataFrame, table: str, gen: int) -> DataFrame:
        path = f"{self.path}/{table}/gen={gen}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self._read(table, [gen])

    def _read(self, table: str, gens: list[int] | None = None) -> DataFrame:
        """The committed generations of a table, or the given ones."""
        gens = self.gens[1:] if gens is None else gens
        if not gens:
            return self.spark.createDataFrame([], SCHEMAS[table])
        paths = [f"{self.path}/{table}/gen={g}" for g in gens]
        return self.spark.read.schema(SCHEMAS[table]).option("basePath", f"{self.path}/{table}").parquet(*paths)

    def _latest(self, table: str, by: list[str], values: list[str]) -> DataFrame:
        rows = self._read(table)
        if len(self.gens) <= 2:
            return rows.select(*by, *values)
        top = F.max_by(F.struct(*values), "gen").alias("v")
        return rows.groupBy(*by).agg(top).select(*by, "v.*")

    def counts(self) -> DataFrame:
        """The exact reference counts: shard, key, n (rows of documents that hold it), first (smallest doc_id)."""
        return self._latest("refs", ["shard", "key"], ["n", "first"]).where("n > 0")

    def _filters(self) -> DataFrame:
        return self._latest("filters", ["shard"], ["held", "shared"])

    def _live(self) -> DataFrame:
        """doc_id and keys of the documents that are in the index."""
        lines = self._read("lines")
        gone = self._read("gone").groupBy(F.col("doc_id").alias("left_id")).agg(F.max("gen").alias("left_gen"))
        return (lines.join(gone, F.col("doc_id") == F.col("left_id"), "left")
                .where(F.col("left_gen").isNull() | (F.col("left_gen") < F.col("gen"))).select("doc_id", "keys"))

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[table].rsplit(",", 1)[0])

    def _finish(self, gen: int, refs: DataFrame, filters: DataFrame) -> None:
        moved = refs.select("shard", "key", "n", "was").groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(
            _moved, "shard int, held binary, shared binary")
        self._write(moved, "filters", gen)
        self._commit(gen)

    def insert(self, docs: DataFrame) -> None:
        gen = self.gens[-1] + 1
        known = _documents(docs).where("doc_id IS NOT NULL")
        lines = self._write(known.mapInArrow(_keys(self.least), "doc_id long, keys array<binary>").where(F.size("keys") > 0), "lines", gen)
        new = (lines.select("doc_id", F.explode("keys").alias("key")).groupBy("key")
               .agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).select(self._shard(), "key", "n", "first"))
        filters = self._filters()
        if len(self.gens) > 1:
            probed = new.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(
                _probed("held", True), "shard int, key binary, n long, first long, maybe boolean")
            probed = saved(probed, "probed")
            old = self.counts().select(F.col("shard").alias("o_shard"), F.col("key").alias("o_key"), F.col("n").alias("o_n"), F.col("first").alias("o_first"))
            met = probed.where("maybe").join(old, (F.col("shard") == F.col("o_shard")) & (F.col("key") == F.col("o_key")), "left")
            new = met.select("shard", "key", (F.col("n") + F.coalesce("o_n", F.lit(0))).alias("n"), F.least("first", "o_first").alias("first"),
                             F.coalesce("o_n", F.lit(0)).cast("long").alias("was")).unionByName(
                probed.where("NOT maybe").select("shard", "key", "n", "first", F.lit(0).cast("long").alias("was")))
        else:
            new = new.withColumn("was", F.lit(0).cast("long"))
        self._write(self._empty("gone"), "gone", gen)
        self._finish(gen, self._write(new, "refs", gen), filters)

    def delete(self, ids: DataFrame) -> None:
        """Takes out every document whose doc_id is in ids(doc_id); others are ignored."""
        gen = self.gens[-1] + 1
        ids = self._write(ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct(), "gone", gen).select("doc_id")
        live = self._live()
        out = live.join(ids, "doc_id", "left_semi")
        less = (out.select("doc_id", F.explode("keys").alias("key")).groupBy(F.col("key").alias("o_key"))
                .agg(F.count("*").alias("o_n"), F.min("doc_id").alias("o_first")))
        met = (self.counts().join(less, F.col("key") == F.col("o_key"))
               .select("shard", "key", (F.col("n") - F.col("o_n")).alias("n"), "first", F.col("n").alias("was"),
                       (F.col("first") == F.col("o_first")).alias("lost")))
        met = saved(met, "less")
        lost = met.where("lost AND n > 0").select(F.col("key").alias("l_key"))
        rest = live.join(ids, "doc_id", "left_anti").select("doc_id", F.explode("keys").alias("l_key"))
        following = rest.groupBy("l_key").agg(F.min("doc_id").alias("following")).join(lost, "l_key", "left_semi")
        refs = met.join(following, F.col("key") == F.col("l_key"), "left").select(
            "shard", "key", "n", F.coalesce("following", "first").alias("first"), "was")
        filters = self._filters()
        self._write(self._empty("lines"), "lines", gen)
        self._finish(gen, self._write(refs, "refs", gen), filters)

    def compact(self, shards: int | None = None) -> None:
        """One generation in place of all, in as many shards as given; older generations are no longer read."""
        gen = self.gens[-1] + 1
        self._write(self._live(), "lines", gen)
        counts = self.counts()
        self.shards = shards or self.shards
        refs = self._write(counts.select(self._shard(), "key", "n", "first", F.lit(0).cast("long").alias("was")), "refs", gen)
        self._write(self._empty("gone"), "gone", gen)
        self.gens = [gen - 1]
        self._finish(gen, refs, self._empty("filters"))

    def apply(self, docs: DataFrame, with_text: bool = True, chunks: int | None = None) -> DataFrame:
        """Per row of docs: doc_id, n_lines, n_dropped, kept_sha256 and kept_text (null if not with_text).

        A line is dropped if its key has at least `least` code points and a document of the index with a smaller
        doc_id holds it.  Keys go to the shards once a chunk of documents, so a key held by any number of
        documents makes at most one row a chunk there."""
        docs = _documents(docs)
        chunks = chunks or group_count(docs, per_group=SHARD_BYTES)
        docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks)).cast("int"))
        asks = (docs.where("doc_id IS NOT NULL").mapInArrow(_asks(self.least), "key binary, chunk int, last long")
                .groupBy("key", "chunk").agg(F.max("last").alias("last")).select(self._shard(), "key", "chunk", "last"))
        hits = asks.groupBy("shard").cogroup(self._filters().select("shard", "shared").groupBy("shard")).applyInArrow(
            _probed("shared", False), "shard int, key binary, chunk int, last long")
        refs = self.counts().where("n > 1").select(F.col("shard").alias("o_shard"), F.col("key").alias("o_key"), "first")
        answers = hits.join(refs, (F.col("shard") == F.col("o_shard")) & (F.col("key") == F.col("o_key")) & (F.col("first") < F.col("last")))
        rows = answers.select("chunk", F.lit(0).alias("kind"), "key", "first", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
        rows = rows.unionByName(docs.select("chunk", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("first"), "doc_id", "text"))
        got = rows.repartitionById(max(chunks, 1), "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(
            _dropped(self.least, with_text), "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string")
        return got if with_text else got.drop("kept_text")


def line_dedup(docs: DataFrame, least: int = LEAST, with_text: bool = True) -> DataFrame:
    """All of docs inserted into a fresh index and cleaned by it; see LineIndex."""
    docs = _documents(docs)
    index = LineIndex.create(docs.sparkSession, shards=group_count(docs, per_group=SHARD_BYTES), least=least)
    index.insert(docs)
    return index.apply(docs, with_text, chunks=index.shards)
