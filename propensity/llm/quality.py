"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

Features of a text: a bucket for each word, one for a word that repeats the word before it, and one for each window of 3 and of 4 bytes that has white space at its
ends only.  A document is the mean of its features' learned vectors; two output rows and a bias give the
label's probabilities.  Everything is trained by numpy stochastic gradient descent in one task, on a sample of
at most `sample` labelled documents (those whose id hashes lowest), so what that task holds is bounded; the driver
gets the model alone.
For two labels the score only needs each vector's product with the difference of the output rows: a
table of one number per bucket is broadcast, and scoring is a lookup and a mean."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import textnp as T
from propensity.llm.common import held_out, saved, slices

BUCKETS, DIM, SAMPLE, EPOCHS, STEPS, BATCH, RATE = 1 << 17, 16, 6000, 6, 1000, 32, 0.5
GRAMS = (3, 4)
#: Bucket of a word that repeats the one before.
AGAIN = 1
_SHIFT = np.uint64(64 - 17)


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature, and per feature its document."""
    starts, ends, first = T.word_spans(buf, off)
    idx = [(T.word_hashes(buf, starts, ends) >> _SHIFT).astype(np.int32)]
    doc = [np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))]
    words = idx[0]
    again = np.flatnonzero((words[1:] == words[:-1]) & (doc[0][1:] == doc[0][:-1]))
    idx.append(np.full(len(again), AGAIN, np.int32))
    doc.append(doc[0][again])
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    value = T._BYTE[np.where(space, 32, buf)]
    owner = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    for n in GRAMS:
        k = len(buf) - n + 1
        if k <= 0:
            continue
        ok = owner[:k] == owner[n - 1:]
        for j in range(1, n - 1):
            ok &= ~space[j:j + k]
        acc = np.full(k, np.uint64(n))
        for j in range(n):
            acc *= np.uint64(0x9E3779B97F4A7C15)
            acc ^= value[j:j + k]
        acc ^= acc >> np.uint64(29)
        acc *= np.uint64(0xBF58476D1CE4E5B9)
        idx.append((acc[ok] >> _SHIFT).astype(np.int32))
        doc.append(owner[:k][ok])
    return np.concatenate(idx), np.concatenate(doc)


def _bags(batches):
    """Each document's distinct buckets with their shares."""
    for batch in batches:
        for i, j in slices(batch, "text", 1 << 20):
            part = batch.slice(i, j - i)
            idx, doc = features(*T.buffer_of(part.column("text")))
            code, n = np.unique(doc.astype(np.int64) * BUCKETS + idx, return_counts=True)
            doc, idx = code // BUCKETS, (code % BUCKETS).astype("<i4")
            cut = np.searchsorted(doc, np.arange(len(part) + 1))
            rows = [(idx[s:e].tobytes(), (n[s:e] / max(1, n[s:e].sum())).astype("<f4").tobytes()) for s, e in zip(cut[:-1], cut[1:])]
            yield pa.record_batch([part.column("doc_id"), part.column("label"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())],
                                  names=["doc_id", "label", "idx", "share"])


@dataclass
class QualityModel:
    """vectors (BUCKETS x DIM), output (DIM x 2), bias (2), prior: the share of label 1 in the sample."""
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    prior: float

    def table(self) -> np.ndarray:
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> QualityModel:
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM).astype(np.float32)
    prior = float(labels.mean()) if len(labels) else 0.5
    output = np.zeros((DIM, 2), np.float32)
    bias = np.log(np.clip([1 - prior, prior], 1e-3, 1)).astype(np.float32)
    usable = [i for i, (idx, _) in enumerate(bags) if len(idx)]
    if len(set(labels[usable].tolist())) < 2:
        return QualityModel(vectors, output, bias, prior)
    each = -(-len(usable) // BATCH)
    epochs = max(epochs, -(-STEPS // each))          # a small sample is gone through more often
    steps, done = epochs * each, 0
    for _ in range(epochs):
        order = rng.permutation(usable)
        for b in range(0, len(order), BATCH):
            pick = order[b:b + BATCH]
            step = rate * (1 - done / steps) * 10
            done += 1
            sizes = np.array([len(bags[i][0]) for i in pick])
            idx = np.concatenate([bags[i][0] for i in pick])
            share = np.concatenate([bags[i][1] for i in pick])[:, None]
            first = np.r_[0, np.cumsum(sizes)[:-1]]
            hidden = np.add.reduceat(vectors[idx] * share, first)
            logit = hidden @ output + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            back = p @ output.T
            output -= step / len(pick) * (hidden.T @ p)
            bias -= step / len(pick) * 0.1 * p.sum(0)
            # one update per distinct bucket of the batch
            used, slot = np.unique(idx, return_inverse=True)
            grad = share * np.repeat(back, sizes, axis=0)
            total = np.stack([np.bincount(slot, grad[:, d], len(used)) for d in range(DIM)], axis=1)
            vectors[used] -= (step * total).astype(np.float32)
    return QualityModel(vectors, output, bias, prior)


def _fit(batches):
    """The model of all bags of the one partition, whatever their order."""
    rows = []
    for batch in batches:
        ids, labels = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
        rows += zip(ids, labels, batch.column("idx").to_pylist(), batch.column("share").to_pylist())
    rows.sort(key=lambda r: (r[0], r[2]))
    model = train([(np.frombuffer(idx, "<i4"), np.frombuffer(share, "<f4")) for _, _, idx, share in rows], np.array([r[1] for r in rows], np.int64))
    yield pa.record_batch([pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in (model.vectors, model.output, model.bias)] + [pa.array([model.prior])],
                          names=["vectors", "output", "bias", "prior"])


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Trains on labels(doc_id, quality) of rows that are not held out; a doc_id with several labels counts by its smallest,
    each row of a labelled doc_id is trained on, null doc_ids and texts without a word are not.  Without two labels every text scores the prior."""
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
             .where(~held_out(F.col("doc_id"))))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bags = saved(texts.join(picked, "doc_id").select("doc_id", "label", "text").mapInArrow(_bags, "doc_id long, label int, idx binary, share binary"), "bags")
    # one short row from the only task; the bags stay in the shared folder, so a lost executor costs the training alone
    fitted = bags.repartition(1).mapInArrow(_fit, "vectors binary, output binary, bias binary, prior double").first()
    if fitted is None:
        return train([], np.zeros(0, np.int64))
    return QualityModel(np.frombuffer(fitted["vectors"], "<f4").reshape(BUCKETS, DIM), np.frombuffer(fitted["output"], "<f4").reshape(DIM, 2),
                        np.frombuffer(fitted["bias"], "<f4"), fitted["prior"])


def _score(model, name: str):
    def run(batches):
        table, bias, prior = model.value
        for batch in batches:
            for i, j in slices(batch, "text", 1 << 20):
                part = batch.slice(i, j - i)
                idx, doc = features(*T.buffer_of(part.column("text")))
                n = np.bincount(doc, minlength=len(part))
                mean = np.bincount(doc, table[idx], len(part)) / np.maximum(n, 1)
                score = np.where(n > 0, 1 / (1 + np.exp(-np.clip(mean + bias, -50, 50))), prior)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, name])
    return run


def score_quality(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """docs with a score column (0 to 1, higher: label 1 likelier).  Empty and null texts get the prior.
    All other columns pass through; an existing column of that name is replaced."""
    docs = docs.drop(name)
    sent = docs.sparkSession.sparkContext.broadcast((model.table(), float(model.bias[1] - model.bias[0]), model.prior))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{name}` double"
    return docs.mapInArrow(_score(sent, name), schema)
