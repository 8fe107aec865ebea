"""Fill-in-the-middle transformation by secondary sort.

Each document is cut into pieces of whole units (lines), keyed by the document and the place of
the piece in the output.  One exchange by document with a sort inside its partitions (Spark's
repartition-and-sort-within-partitions on DataFrames) then streams the pieces of a document in
output order into an incremental digest.  The same pass reads the output back: it finds the
sentinels in the stream, knowing the form only, and gives every piece the place it has in the
restored text.  A second sort inside the same partitions, without an exchange, streams them in
that order into the digest of the restored text.

No task holds more than a batch of pieces, however long a document is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import GROUP_BYTES, group_count, slices

#: Bytes of text a piece aims at; a piece ends with a unit unless the unit alone is longer.
PIECE = 1 << 16


@dataclass(frozen=True)
class Layout:
    """What is drawn for a document: seed text, per cent of documents transformed, per cent of these
    with the suffix first, and the sentinels of prefix, suffix and middle."""
    seed: str = "7"
    rate: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def order(self, form: str) -> list[tuple[bytes, int]]:
        """Sentinel and segment number (0 prefix, 1 middle, 2 suffix) in output order."""
        p, m, s = (self.prefix.encode(), 0), (self.middle.encode(), 1), (self.suffix.encode(), 2)
        return {"psm": [p, s, m], "spm": [s, p, m]}[form]


PIECES = "doc_id long, sha binary, copies long, place int, data binary, form string, n long, prefix_chars long, middle_chars long"


def _chars(data: bytes) -> int:
    return int((np.frombuffer(data, np.uint8) & 0xC0 != 0x80).sum())


def _plan(doc_id, text: bytes, layout: Layout) -> tuple[str, int, int, int]:
    """Form, number of units, and the byte where the prefix and the middle end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    n = len(ends) + (len(text) > (ends[-1] if len(ends) else 0))
    digest = hashlib.sha256(f"{layout.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))
    marks = (layout.prefix, layout.suffix, layout.middle)
    if not text or h3 % 100 >= layout.rate or any(m.encode() in text for m in marks):
        return "plain", n, 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut = [0 if u == 0 else len(text) if u == n else int(ends[u - 1]) for u in (a, b)]
    return ("spm" if h4 % 100 < layout.suffix_first else "psm"), n, *cut


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """Runs of whole lines of at most size bytes; a longer line is cut."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            line = data.rfind(b"\n", at, end) + 1
            end = line or end
        yield data[at:end]
        at = end


def _pieces(layout: Layout, size: int):
    """Rows of equal doc_id and text met in one slice become one document with its number of copies."""
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("copies", pa.int64()), ("place", pa.int32()), ("data", pa.binary()),
                        ("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch, "text", GROUP_BYTES):
                part = batch.slice(i, j - i)
                met: dict[tuple, list] = {}
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    text = text or b""
                    met.setdefault((doc, hashlib.sha256(text).digest()), [text, 0])[1] += 1
                out: list[tuple] = []
                for (doc, sha), (text, copies) in met.items():
                    form, n, a, b = _plan(doc, text, layout)
                    if form == "plain":
                        runs, counts = [(b"", text)], (None, None)
                    else:
                        segments = text[:a], text[a:b], text[b:]
                        runs = [(mark, segments[k]) for mark, k in layout.order(form)]
                        counts = _chars(segments[0]), _chars(segments[1])
                    place = 0
                    for mark, segment in runs:
                        for piece in ([mark] if mark else []) + list(_cut(segment, size)) or [b""]:
                            out.append((doc, sha, copies, place, piece, form, n, *counts))
                            place += 1
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def output_pieces(docs: DataFrame, layout: Layout = Layout(), piece: int = PIECE) -> DataFrame:
    """The transformed documents as pieces in output order: those of a document stand together in one
    partition, sorted by place, and joined they are its output.  Schema: PIECES; sha names the input text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = group_count(docs, per_group=8 * GROUP_BYTES)
    return docs.mapInArrow(_pieces(layout, piece), PIECES).repartition(max(parts, docs.sparkSession.sparkContext.defaultParallelism), "doc_id", "sha") \
        .sortWithinPartitions("doc_id", "sha", "place")


class _Reader:
    """Finds the segments in the output stream of one document from its form alone."""

    def __init__(self, form: str, layout: Layout):
        self.left = [] if form == "plain" else layout.order(form)
        self.segment = 0
        self.carry = b""

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        """Segment number and bytes, without sentinels; up to a sentinel's length less one is held back."""
        data = self.carry + data
        self.carry = b""
        while self.left:
            mark, segment = self.left[0]
            at = data.find(mark)
            if at < 0:
                keep = 0 if last else min(len(mark) - 1, len(data))
                data, self.carry = data[:len(data) - keep], data[len(data) - keep:]
                break
            if at:
                yield self.segment, data[:at]
            data, self.segment = data[at + len(mark):], segment
            self.left.pop(0)
        if data:
            yield self.segment, data


RESTORED = ("doc_id long, sha binary, copies long, segment int, place int, data binary, form string, n long, prefix_chars long, "
            "middle_chars long, output_sha256 string")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, dict]]:
    """(key, whether it is the key's first row, row) of sorted rows."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["doc_id"], row["sha"])
            yield key, key != last, row
            last = key


def _flush(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_pylist(rows, schema=schema)
    rows.clear()
    return batch


def _assembled(layout: Layout):
    """Streams pieces in output order: digests of the output, and the pieces placed for restoration.

    A document that several slices held comes with equal pieces next to each other: the first of a
    place counts, and the copies are summed over place 0.  The document's own row has segment -1."""
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("copies", pa.int64()), ("segment", pa.int32()), ("place", pa.int32()),
                        ("data", pa.binary()), ("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()),
                        ("middle_chars", pa.int64()), ("output_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0
        head, digest, reader, copies, place, written = None, None, None, 0, -1, 0

        def close():
            nonlocal written
            for segment, data in reader.feed(b"", last=True):
                out.append({"doc_id": head["doc_id"], "sha": head["sha"], "segment": segment, "place": written, "data": data})
                written += 1
            out.append({k: head[k] for k in ("doc_id", "sha", "form", "n", "prefix_chars", "middle_chars")}
                       | {"copies": copies, "segment": -1, "place": 0, "output_sha256": digest.hexdigest()})

        for _, first, row in _documents(batches):
            if first:
                if head:
                    close()
                head, digest, reader, copies, place, written = row, hashlib.sha256(), _Reader(row["form"], layout), 0, -1, 0
            if row["place"] == 0:
                copies += row["copies"]
            if row["place"] > place:
                place = row["place"]
                digest.update(row["data"])
                for segment, data in reader.feed(row["data"]):
                    out.append({"doc_id": row["doc_id"], "sha": row["sha"], "segment": segment, "place": written, "data": data})
                    written += 1
                    held += len(data)
            if held > GROUP_BYTES or len(out) > 20_000:
                held = 0
                yield _flush(out, schema)
        if head:
            close()
        if out:
            yield _flush(out, schema)
    return run


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams pieces in restored order; one row per document with its digests."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("copies", pa.int64())])
    out: list[dict] = []
    head, digest = None, None
    for _, first, row in _documents(batches):
        if first:
            if head:
                out.append({f: head.get(f) for f in schema.names} | {"restored_sha256": digest.hexdigest()})
            head, digest = row, hashlib.sha256()
        if row["segment"] >= 0:
            digest.update(row["data"])
        if len(out) > 20_000:
            yield _flush(out, schema)
    if head:
        out.append({f: head.get(f) for f in schema.names} | {"restored_sha256": digest.hexdigest()})
    if out:
        yield _flush(out, schema)


def restore_pieces(pieces: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Pieces in restored order (RESTORED), made from output_pieces by reading the output alone: the rows of
    a document with segment >= 0, in order, join to its text; the row with segment -1 comes first and
    holds its form, counts, copies and output digest."""
    return pieces.mapInArrow(_assembled(layout), RESTORED).sortWithinPartitions("doc_id", "sha", "segment", "place")


def fill_in_middle(docs: DataFrame, layout: Layout = Layout(), piece: int = PIECE) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    Null text is empty, and an empty text, or one that contains a sentinel, is plain.  A null doc_id draws
    as if its decimal text were empty.  Rows with one doc_id are documents of their own; equal rows give
    equal rows as often.  An empty table gives an empty result.  Other columns are ignored."""
    digests = restore_pieces(output_pieces(docs, layout, piece), layout).mapInArrow(
        _restored, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, copies long")
    return digests.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")


def fill_in_middle_texts(docs: DataFrame, layout: Layout = Layout(), piece: int = PIECE) -> DataFrame:
    """doc_id, form and output text of each distinct (doc_id, text), for outputs that fit one string."""
    return output_pieces(docs, layout, piece).mapInArrow(_joined, "doc_id long, form string, output string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])
    head, parts, place = None, [], -1
    for _, first, row in _documents(batches):
        if first:
            if head:
                yield pa.RecordBatch.from_pylist([{"doc_id": head["doc_id"], "form": head["form"], "output": b"".join(parts).decode()}], schema=schema)
            head, parts, place = row, [], -1
        if row["place"] > place:
            place = row["place"]
            parts.append(row["data"])
    if head:
        yield pa.RecordBatch.from_pylist([{"doc_id": head["doc_id"], "form": head["form"], "output": b"".join(parts).decode()}], schema=schema)
