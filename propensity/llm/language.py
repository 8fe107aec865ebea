"""Language ID with spans: scripts narrow the candidates, Viterbi over per-word scores labels the words.

A letter's script follows from its code point.  Per language the model has smoothed log shares of hashed letter triples (a letter
with its neighbours; anything but a letter is a border) and the scripts it is written in.  A word's score for a language
is the sum over its letters; languages not written in the word's script are out.  Changing the language
between words costs `penalty`; the best path over a document's words gives spans, and the language with
most letters on the path is the document's.  The path is worked for many documents at once, word by word.

Counts are summed per task, then by Spark; the model has LETTERS counts per language and is broadcast."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import held_out, saved, slices

LETTERS, SAMPLE, PENALTY, OUT = 1 << 16, 20_000, 8.0, -60.0
#: Cells (documents x words) that are worked at once.
CELLS = 1 << 18
# First and last code point of the main blocks of each script.
SCRIPTS = (
    ("Latin", ((0x41, 0x24F), (0x1E00, 0x1EFF))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F),)),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F))),
    ("Devanagari", ((0x900, 0x97F),)),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Georgian", ((0x10A0, 0x10FF),)),
    ("Hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("Kana", ((0x3040, 0x30FF),)),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF))),
)
_tables: list[np.ndarray] = []


def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: script number (0: no letter, last: a letter of another script), and lower case."""
    if not _tables:
        letter = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])
        script = np.where(letter, len(SCRIPTS) + 1, 0).astype(np.uint8)
        for n, (_, ranges) in enumerate(SCRIPTS, 1):
            for lo, hi in ranges:
                script[lo:hi + 1][letter[lo:hi + 1]] = n
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(letter):
            x = chr(c).lower()
            if len(x) == 1:
                lower[c] = ord(x)
        _tables.extend((script, lower))
    return _tables[0], _tables[1]


def _letters(texts: list[str | None]):
    """Per letter: hashed triple, word, script; per word: letters and script of the first; first word per document."""
    script_of, lower = _code_points()
    size = np.array([len(t or "") for t in texts], np.int64)
    cp = np.frombuffer("".join([t or "" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    off = np.r_[0, np.cumsum(size)]
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    begin = np.ones(len(cp), bool)
    if len(cp):
        begin[1:] = space[:-1]
    begin[off[:-1][off[:-1] < len(cp)]] = True
    begin &= ~space
    word = np.cumsum(begin) - 1
    first = np.r_[0, np.cumsum(begin)][off]
    script = script_of[cp]
    at = np.flatnonzero(script)
    x = np.where(script > 0, lower[cp], 0).astype(np.uint64)
    x = np.r_[np.uint64(0), x, np.uint64(0)]
    edge = np.zeros(len(cp) + 2, bool)
    edge[off] = True                                   # document borders: the neighbour there is none
    before = np.where(edge[at], np.uint64(0), x[at])
    after = np.where(edge[at + 1], np.uint64(0), x[at + 2])
    h = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (x[at + 1] * np.uint64(0xBF58476D1CE4E5B9)) ^ (after * np.uint64(0x94D049BB133111EB))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    triple = (h >> np.uint64(48)).astype(np.int64)
    return triple, word[at], script[at], first


@dataclass
class LanguageModel:
    """languages by name; weight (LETTERS x languages): log shares; written (scripts x languages)."""
    languages: list[str]
    weight: np.ndarray
    written: np.ndarray


def _counts(batches):
    total: dict[str, np.ndarray] = {}
    kinds = len(SCRIPTS) + 2
    for batch in batches:
        for i, j in slices(batch, "text", 2 << 20):
            part = batch.slice(i, j - i)
            triple, word, script, first = _letters(part.column("text").to_pylist())
            doc = np.searchsorted(first, word, side="right") - 1
            langs = np.array(part.column("lang").to_pylist(), object)
            for name in set(langs.tolist()):
                mine = (langs == name)[doc]
                n = total.setdefault(name, np.zeros(LETTERS + kinds, np.int64))
                n[:LETTERS] += np.bincount(triple[mine], minlength=LETTERS)
                n[LETTERS:] += np.bincount(script[mine], minlength=kinds)
    for name, n in total.items():
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(n[used])], names=["lang", "cell", "n"])


def fit_language(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learns from text and non-null lang of at most `sample` documents per language (lowest id hashes) that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out(F.col("doc_id")))
    # the share of ids that keeps every language within the bound; a language above it is thinned by its id hash
    # the sizes are a written table of one row per language, so Spark sees its bytes and no text moves by language
    sizes = saved(known.groupBy("lang").agg(F.count("*").alias("docs")), "languages")
    unit = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = known.select("lang", "text", unit.alias("u")).join(sizes, "lang").where(F.col("u") * F.col("docs") < sample).select("lang", "text")
    rows = picked.mapInArrow(_counts, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["lang"] for r in rows})
    n = np.zeros((LETTERS + len(SCRIPTS) + 2, max(1, len(names))))
    number = {x: i for i, x in enumerate(names)}
    for r in rows:
        n[r["cell"], number[r["lang"]]] = r["n"]
    letters, scripts = n[:LETTERS], n[LETTERS:]
    share = (letters + 0.05) / (letters.sum(0) + 0.05 * LETTERS)
    written = scripts >= 0.005 * np.maximum(scripts.sum(0), 1)
    return LanguageModel(names, np.log(share).astype(np.float32), written)


def viterbi(score: np.ndarray, first: np.ndarray, penalty: float, cells: int = CELLS) -> np.ndarray:
    """Best state per word of each document (words x states; first word per document): staying is free, changing costs penalty."""
    n, states = np.diff(first), score.shape[1]
    number = np.min_scalar_type(states)
    path = np.zeros(len(score), number)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    at = 0
    while at < len(order):
        longest = int(n[order[at]])
        group = order[at:at + max(1, cells // longest)]
        at += len(group)
        size, begin = n[group], first[group]
        came = np.zeros((longest, len(group), states), number)      # the state before, per state
        best = score[begin].copy()
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # documents with more than t words
        own = np.arange(states, dtype=number)
        for t in range(1, longest):
            m = int(live[t])
            top = best[:m].argmax(1)
            switch = best[np.arange(m), top][:, None] - penalty
            stay = best[:m] >= switch
            came[t, :m] = np.where(stay, own, top[:, None])
            best[:m] = np.where(stay, best[:m], switch) + score[begin[:m] + t]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            m = int(live[t])
            path[begin[:m] + t] = state[:m]
            if t:
                state[:m] = came[t, np.arange(m), state[:m]]
    return path


def _spans(path: np.ndarray, names: list[str]) -> list[dict]:
    cut = np.flatnonzero(np.r_[True, path[1:] != path[:-1], True]) if len(path) else np.zeros(1, int)
    return [{"start": int(s), "length": int(e - s), "lang": names[path[s]]} for s, e in zip(cut[:-1], cut[1:])]


def _identify(model, penalty: float, with_spans: bool):
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        m: LanguageModel = model.value
        k = len(m.languages)
        for batch in batches:
            for i, j in slices(batch, "text", 2 << 20):
                part = batch.slice(i, j - i)
                triple, word, script, first = _letters(part.column("text").to_pylist())
                words, docs = int(first[-1]), len(part)
                label, share, spans = [None] * docs, np.zeros(docs), [[] for _ in range(docs)]
                if k and len(word):
                    new = np.r_[True, word[1:] != word[:-1]]
                    letters = np.bincount(word, minlength=words)
                    kind = np.zeros(words, np.int64)
                    kind[word[new]] = script[new]
                    score = np.stack([np.bincount(word, m.weight[triple, s], words) for s in range(k)], axis=1)
                    out = ~m.written[kind]
                    none = out.all(1)
                    score[none] = 0
                    score = np.where(out & ~none[:, None], score + OUT * np.maximum(letters, 1)[:, None], score)
                    path = viterbi(score, first, penalty)
                    doc = np.repeat(np.arange(docs), np.diff(first))
                    held = np.bincount(doc * k + path, letters, docs * k).reshape(docs, k)
                    top = held.argmax(1)
                    total = held.sum(1)
                    share = np.where(total > 0, held[np.arange(docs), top] / np.maximum(total, 1), 0.0)
                    label = [m.languages[t] if n else None for t, n in zip(top, total)]
                    if with_spans:
                        spans = [_spans(path[s:e], m.languages) if n else [] for s, e, n in zip(first[:-1], first[1:], total)]
                yield pa.record_batch([part.column("doc_id"), pa.array([x or "und" for x in label]), pa.array(share, pa.float64()), pa.array(spans, span)],
                                      names=["doc_id", "lang_pred", "score", "spans"])
    return run


def identify_language(docs: DataFrame, model: LanguageModel, penalty: float = PENALTY, with_spans: bool = True) -> DataFrame:
    """Per row of docs(doc_id, text): lang_pred, score (share of its letters on the path), spans (word offsets, lang).
    Null text, text without a letter, or a model without languages: `und`, score 0, no spans."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _identify(sent, penalty, with_spans), "doc_id long, lang_pred string, score double, spans array<struct<start:long,length:long,lang:string>>")
