"""N-gram Jaccard join by token-combination prefixes.

Tokens are word shingles; a class is one distinct set of them (documents with equal sets are
one class).  Sets of at least `percent` % Jaccard similarity are found with signatures:

* Order all tokens by document frequency, rare first.  A set of n tokens can lack at most
  n - ceil(n * percent / 100) of them and still match, so a prefix that forces one more loss
  must share something.
* Rare tokens are signatures by themselves.  Frequent ones are divided into parts by a hash, and
  in a part whose tokens are worth k-combinations, l prefix tokens force only l - (k - 1) losses: the
  prefix is extended until the forced losses suffice, and each k-combination in a part is one
  signature.  (The set whose prefix ends earlier has k common tokens in some part, all of which
  lie in the other prefix too.)
* Sizes of matching sets lie in equal or neighbouring size bands, which name the signatures.

Sharing a signature only makes a pair a candidate.  Signatures with the same members count once.  A pair then has
to pass a bound that never rejects a match: sets hashed to parity bits differ in at most as many bits as
the sets differ in tokens.  What passes is verified on the whole texts.  Signature groups are not expanded into pairs: in each round a group's members are
compared with a few centres, links are contracted into components, and members already connected
are left alone; used centres leave the group, and the number of centres grows from round to round until every pair
is linked through a component or tested.  So components are exact.  Near copies share many groups, so each node
has LEADS min-hashes of its signatures: nodes with an equal one form a group of their own, and these groups are
worked first (the first min-hash alone before all of them, which joins most of what links).  A pair is met at the
first min-hash that it shares; only pairs that share none are met in the signature groups.

Corpus counts never pass the driver.  Classes are divided into parts by hash; a part counts each of its tokens
and sends token and count to the token's hash bucket, which adds the counts up and answers every part the document
frequency of its tokens in more than one class.  So a token that a third of all texts hold is one entry a part, and no
group holds its postings.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm import common
from propensity.llm import textnp as T
from propensity.llm.common import blobs, bucket_of, int64s, pack48, saved, slices, splits, unpack48
from propensity.llm.components import connected_components

_U64 = np.uint64
#: Document frequency from which a token class takes combinations: (above, k, tokens a part).
CLASSES = ((0, 1, 0), (64, 2, 16), (1024, 3, 8))
#: Below this size all tokens count as rare: a part of k - 1 tokens would be a large share of the set.
SMALL = 64
#: Min-hashes of a node's signatures, two to a 64-bit word.
LEADS = 12
_LEADS = [f"l{i}" for i in range(LEADS // 2)]
#: Centres a group has in the first round of the min-hash groups and of the signature groups; their growth in each later one.
FEW, CENTRES, GROWTH = 4, 64, 64
#: Text bytes and rows that a worker cuts into shingles at once: what it holds is some thirty times the text and 8 KB a row.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 2_000
#: Text bytes of a part of the classes (and of a bucket's share of the tokens): a worker holds all tokens of one part or bucket.
PART_BYTES = 4 << 20
#: 64-bit words of parity bits per set.
PARITY = 8
_BITS = [f"p{i}" for i in range(PARITY)]


def group_count(docs: DataFrame) -> int:
    """How many parts the classes, and buckets the tokens, are divided into."""
    return common.group_count(docs, per_group=PART_BYTES)


def _tokens(batch, width: int):
    """Distinct shingle hashes of each text: hashes sorted within a document, and first index per document."""
    buf, off = T.buffer_of(batch.column("text"))
    starts, ends, first = T.word_spans(buf, off)
    words = T.word_hashes(buf, starts, ends, lower=True)
    at, doc = T.inside(first, width)
    h = T.rolling(words, width, 21)[at]
    n = np.diff(first)
    for short in range(1, width):
        rows = np.flatnonzero(n == short)
        if len(rows):
            h = np.r_[h, T.rolling(words, short, 30 + short)[first[rows]]]
            doc = np.r_[doc, rows]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, doc, np.searchsorted(doc, np.arange(len(n) + 1))


def _fingerprints(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums over each set: equal sets have equal sums."""
    out = []
    for salt in (0x51ED270B0A1F39C1, 0x2127599BF4325C37):
        sums = np.r_[_U64(0), np.cumsum(T.mix(h ^ _U64(salt)), dtype=_U64)]
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _parities(h: np.ndarray, doc: np.ndarray, n: int) -> list[np.ndarray]:
    """PARITY words per set: each bit tells whether an odd number of its tokens hash to it."""
    bits = 64 * PARITY
    odd = np.bincount(doc * bits + (T.mix(h) % _U64(bits)).astype(np.int64), minlength=n * bits) & 1
    words = np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1).view(np.int64)
    return [words[:, i] for i in range(PARITY)]


def _may_match(percent: int):
    """Condition on sides x and y: they differ in few enough parity bits."""
    apart = sum((F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in _BITS), F.lit(0))
    return apart * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent)


def _leads() -> list:
    """Min-hashes of a node's signatures, to be taken by node."""
    least = [F.min(F.hash("sig", F.lit(i))).cast("long") for i in range(LEADS)]
    return [F.shiftleft(least[2 * i], 32).bitwiseOR(least[2 * i + 1].bitwiseAND(F.lit(0xFFFFFFFF))).alias(c) for i, c in enumerate(_LEADS)]


def _lead(i: int, of: str = ""):
    """Min-hash i of a node."""
    word = F.col(of + _LEADS[i // 2])
    return word.bitwiseAND(F.lit(0xFFFFFFFF)) if i % 2 else F.shiftrightunsigned(word, 32)


def _first_met():
    """Condition on sides x and y of one group: no earlier min-hash has them in one group too."""
    met = F.lit(False)
    for i in range(LEADS):
        met = met | ((F.col("x.lead") > i) & (_lead(i, "x.") == _lead(i, "y.")))
    return ~met


def _classes(width: int):
    def run(batches):
        for batch in batches:
            for i, j in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                part = batch.slice(i, j - i)
                h, doc, first = _tokens(part, width)
                hi, lo = _fingerprints(h, first)
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(hi), pa.array(lo), *map(pa.array, _parities(h, doc, len(part)))],
                                      names=["doc_id", "n_shingles", "hi", "lo", *_BITS])
    return run


def _sets(width: int):
    """Each slice's distinct non-empty sets: class, number of tokens and the tokens, sorted."""
    def run(batches):
        for batch in batches:
            for i, j in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                h, _, first = _tokens(batch.slice(i, j - i), width)
                hi, lo = _fingerprints(h, first)
                _, once = np.unique(np.stack([hi, lo]), axis=1, return_index=True)      # a copy in the slice adds nothing
                once = once[np.diff(first)[once] > 0]
                yield pa.record_batch([pa.array(hi[once]), pa.array(lo[once]), pa.array(np.diff(first)[once], pa.int64()), pa.array([h[first[k]:first[k + 1]].tobytes() for k in once], pa.binary())],
                                      names=["hi", "lo", "n_shingles", "tokens"])
    return run


def _distinct(sets) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of all sets, sorted, and how many sets hold each.  Sorted in place: np.unique would copy them twice."""
    token = np.concatenate([np.frombuffer(x, _U64) for x in sets])
    token.sort()
    runs = splits(token)
    return token[runs[:-1]], np.diff(runs)


def _ask(buckets: int):
    """Distinct tokens of a part's classes to their buckets, each with the number of classes in the part that hold it."""
    def run(table: pa.Table) -> pa.Table:
        token, count = _distinct(blobs(table.column("tokens")))
        bucket = bucket_of(token, buckets)             # rises with the token
        runs = splits(bucket)
        spans = list(zip(runs[:-1], runs[1:]))
        return pa.table([pa.array(bucket[runs[:-1]], pa.int64()), pa.array([table.column("part")[0].as_py()] * len(spans), pa.int64()),
                         pa.array([pack48(token[s:e]) for s, e in spans], pa.binary()), pa.array([count[s:e].astype("<u4").tobytes() for s, e in spans], pa.binary())],
                        names=["bucket", "part", "tokens", "counts"])
    return run


def _answer(table: pa.Table) -> pa.Table:
    """To each part the number of classes that hold its tokens, in the order asked: a token is one entry a part, however many classes hold it."""
    asked = blobs(table.column("tokens"))
    ends = np.cumsum([len(x) // 6 for x in asked])
    token = np.concatenate([unpack48(x) for x in asked])
    order = np.argsort(token)
    token = token[order]
    runs = splits(token)
    del token
    sums = np.add.reduceat(np.concatenate([np.frombuffer(x, "<u4") for x in blobs(table.column("counts"))])[order], runs[:-1], dtype=np.uint32)
    df = np.empty(len(order), "<u4")
    df[order] = np.repeat(sums, np.diff(runs))
    return pa.table([table.column("part"), table.column("bucket"), pa.array([x.tobytes() for x in np.split(df, ends[:-1])], pa.binary())], names=["part", "bucket", "df"])


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Size band: sets that can match are in the same or in neighbouring bands."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100) + 1e-9).astype(np.int64)


def signatures_of(n: int, token: np.ndarray, df: np.ndarray, percent: int, classes=CLASSES, small: int = SMALL) -> np.ndarray:
    """Signatures of one set of n tokens of which `token` (with `df`) are those in other classes too."""
    need = n - -(-n * percent // 100) + 1
    alone = n - len(token)                       # tokens of this class only: they come first and match nothing
    if alone >= need:
        return np.zeros(0, _U64)
    order = np.lexsort((token, df))
    token, df = token[order], df[order]
    out = []
    band = int(band_of(np.array([n]), percent)[0])
    for name in (band, band - 1):
        top = (percent / 100) ** -(name + 2)       # no smaller than any size that uses this name
        most = max(1.0, top * (1 - percent / 100))     # about the prefix there; both sides derive the parts from it
        kind = np.zeros(len(token), np.int64)
        part = np.zeros(len(token), _U64)
        loss = np.ones(len(token), np.int64)
        salted = T.mix(token ^ _U64((name + 7) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        if (percent / 100) ** -name >= small:
            for c, (above, _, per) in enumerate(classes):
                kind[df > above] = c
                if per:
                    parts = max(1, round(most / per))
                    part = np.where(df > above, T.mix(token) % _U64(parts), part)
            # a token forces a loss unless it is among the first k - 1 of its part
            group = kind.astype(_U64) << _U64(40) | part
            by = np.argsort(group, kind="stable")
            runs = splits(group[by])
            seen = np.arange(len(token)) - np.repeat(runs[:-1], np.diff(runs))
            rank = np.empty(len(token), np.int64)
            rank[by] = seen
            k_of = np.array([k for _, k, _ in classes])[kind]
            loss = np.where(kind == 0, 1, rank >= k_of - 1).astype(np.int64)
        end = int(np.searchsorted(np.cumsum(loss), need - alone)) + 1
        if end > len(token):
            raise AssertionError("a prefix can't force enough losses")
        singles = kind[:end] == 0
        out.append(salted[:end][singles])
        if not singles.all():
            rows = np.flatnonzero(~singles)
            rows = rows[np.lexsort((token[rows], part[rows], kind[rows]))]
            label = kind[rows].astype(_U64) << _U64(40) | part[rows]
            runs = splits(label)
            for s, e in zip(runs[:-1], runs[1:]):
                k = classes[kind[rows[s]]][1]
                if e - s >= k:
                    pick = np.array(list(itertools.combinations(range(s, e), k)))
                    code = np.full(len(pick), label[s] + _U64(1), _U64)
                    for column in pick.T:
                        code = T.mix(code * _U64(0x9E3779B97F4A7C15) ^ salted[rows[column]])
                    out.append(code)
    return np.concatenate(out)


def _prefixes(percent: int, classes, small: int):
    def run(answers: pa.Table, sets: pa.Table) -> pa.Table:
        empty = pa.table({"sig": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
        if not answers.num_rows or not sets.num_rows:
            return empty
        tokens = [np.frombuffer(x, _U64) for x in blobs(sets.column("tokens"))]
        known, _ = _distinct(tokens)                   # as asked: buckets rise with the token
        df = np.concatenate([np.frombuffer(x, "<u4") for x in blobs(answers.sort_by("bucket").column("df"))])
        sig, who = [], []
        for node, n, token in zip(sets.column("hi").to_pylist(), sets.column("n_shingles").to_pylist(), tokens):
            held = df[np.searchsorted(known, token)].astype(np.int64)
            got = np.unique(signatures_of(n, token[held > 1], held[held > 1], percent, classes, small))
            sig.append(got.view(np.int64))
            who.append(np.full(len(got), node))
        return pa.table({"sig": pa.array(np.concatenate(sig)), "node": pa.array(np.concatenate(who))})
    return run


def _verify(width: int, percent: int):
    """Exact test of each pair on the whole texts' distinct shingles."""
    def sets(column):
        """Shingles of each text, one at a time; equal texts one after another are worked once."""
        last, value = None, None
        for text in column:
            if last is None or not text.equals(last):
                value, _, _ = _tokens(pa.record_batch([pa.array([text.as_py()], pa.string())], names=["text"]), width)
                last = text
            yield value

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column("a").filter(pa.array(keep, pa.bool_())), batch.column("b").filter(pa.array(keep, pa.bool_()))], names=["a", "b"])
    return run


def jaccard_join(docs: DataFrame, width: int = 4, percent: int = 85, classes=CLASSES, small: int = SMALL, with_links: bool = True) -> DataFrame:
    """Per row of docs(doc_id, text): doc_id, n_shingles (distinct), component_id (smallest doc_id reachable
    over links, its own included) and, unless with_links is false, n_links (classes that its class is linked to;
    copies not counted).  Links are counted in a pass of their own that tests every candidate pair, so k near
    copies of each other cost k * (k - 1) / 2 tests; components do not need it.

    Words are lower-cased in A-Z only.  Null or empty texts have no shingles and no links; rows with
    a null doc_id share the component of documents with an equal set, else link with nothing (null component_id); rows with equal
    doc_id are rows of their own.  Columns other than doc_id and text are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = group_count(docs)
    rows = saved(docs.mapInArrow(_classes(width), "doc_id long, n_shingles long, hi long, lo long, " + ", ".join(f"{b} long" for b in _BITS)), "classes")
    filled = rows.where("n_shingles > 0")
    classes_of = saved(filled.groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
                                                       *(F.first(b).alias(b) for b in _BITS)), "sets")
    # counts, prefixes, signatures
    sets = docs.mapInArrow(_sets(width), "hi long, lo long, n_shingles long, tokens binary").withColumn("part", F.pmod("hi", F.lit(n)).cast("long"))
    # copies leave here: a class is one row of its part, so that counts below are of classes
    sets = sets.repartition("part").dropDuplicates(["part", "hi", "lo"])
    answers = (sets.groupBy("part").applyInArrow(_ask(n), "bucket long, part long, tokens binary, counts binary")
               .groupBy("bucket").applyInArrow(_answer, "part long, bucket long, df binary"))
    found = answers.groupBy("part").cogroup(sets.groupBy("part")).applyInArrow(_prefixes(percent, classes, small), "sig long, node long")
    sigs = saved(found, "signatures")
    # parity bits by node; two classes whose 64-bit node is equal can't be told apart here, so they pass any bound
    bits = classes_of.groupBy(F.col("hi").alias("node")).agg(F.max("n_shingles").alias("n"), F.count("*").alias("k"), *(F.first(b).alias(b) for b in _BITS))
    bits = bits.select("node", F.when(F.col("k") > 1, F.lit(1 << 40)).otherwise(F.col("n")).alias("n"), *_BITS)
    sigs = saved(_several(sigs), "signatures")
    nodes = saved(sigs.groupBy("node").agg(*_leads()).join(bits, "node"), "nodes")
    # texts of the classes that share a signature with another
    wanted = classes_of.join(nodes.select("node"), classes_of.hi == nodes.node, "left_semi").where("least is not null").select("hi", "lo", "least")
    texts = saved(docs.join(wanted, docs.doc_id == wanted.least).select("hi", "lo", "text")
                  .mapInArrow(_own(width), "hi long, lo long, text string"), "texts").dropDuplicates(["hi", "lo"])
    texts = saved(texts, "texts")
    roots = _link(sigs, nodes, texts, width, percent)
    found = classes_of.join(roots, classes_of.hi == roots.node, "left").select(
        "hi", "lo", "least", F.coalesce("root", "hi").alias("root"))
    lowest = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(lowest, "root").select("hi", "lo", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = ["doc_id", "n_shingles", "component_id"]
    if with_links:
        links = _links(sigs, nodes, texts, width, percent)
        degree = links.select(F.col("a").alias("hi")).unionAll(links.select(F.col("b").alias("hi"))).groupBy("hi").agg(F.count("*").alias("n_links"))
        named = named.join(degree, "hi", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
        alone = alone.withColumn("n_links", F.lit(0).cast("long"))
        out.append("n_links")
    return filled.join(named, ["hi", "lo"]).select(out).unionByName(alone)


def _several(sigs: DataFrame) -> DataFrame:
    """Rows of signatures that more than one node holds, one signature for each distinct group of members."""
    members = sigs.groupBy("sig").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    chosen = members.where("n > 1").groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
    return sigs.join(chosen, "sig", "left_semi")


def _own(width: int):
    """Keeps a row if its text has the class it was joined for (rows may share a doc_id)."""
    def run(batches):
        for batch in batches:
            for i, j in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
                part = batch.slice(i, j - i)
                h, _, first = _tokens(part, width)
                hi, lo = _fingerprints(h, first)
                same = (hi == int64s(part.column("hi"))) & (lo == int64s(part.column("lo")))
                yield part.filter(pa.array(same))
    return run


def _sides(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (texts.select(F.col("hi").alias("a"), F.col("lo").alias("lo_a"), F.col("text").alias("text_a")),
            texts.select(F.col("hi").alias("b"), F.col("lo").alias("lo_b"), F.col("text").alias("text_b")))


def _links(sigs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """All links (a, b), a < b: each pair of nodes that shares a signature and may match is tested once."""
    a, b = _sides(texts)
    sigs = sigs.join(nodes.select("node", "n", *_BITS), "node")
    x, y = sigs.alias("x"), sigs.alias("y")
    pairs = (x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") < F.col("y.node")) & _may_match(percent))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    pairs = saved(pairs, "pairs")
    return saved(pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, percent), "a long, b long"), "links")


def _link(sigs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Components over nodes: (node, root), by rounds of growing numbers of centres: groups of the first min-hash
    (one round), of all min-hashes, of the signatures."""
    spark = sigs.sparkSession
    tested = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    a, b = _sides(texts)
    near = nodes.select("node", F.posexplode(F.array(*map(_lead, range(LEADS)))).alias("lead", "sig"))
    turn = 0
    for left, centres, once in ((near.where("lead = 0"), FEW, True), (near, FEW, False), (sigs.withColumn("lead", F.lit(LEADS)), CENTRES, False)):
        while True:
            # a group whose members are one component has nothing left to find
            named = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            open_ = named.groupBy("lead", "sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("lead", "sig")
            rows = saved(named.join(open_, ["lead", "sig"], "left_semi").join(nodes, "node"), "signatures")
            if rows.isEmpty():
                break
            slot = F.pmod(F.xxhash64("node", F.lit(2 * turn)), F.lit(centres))
            held = F.struct("node", "root", "n", *_LEADS, *_BITS)
            centre = rows.groupBy("lead", "sig", slot.alias("slot")).agg(F.min_by(held, F.xxhash64("node", F.lit(2 * turn + 1))).alias("c"))
            centre = saved(centre.select("lead", "sig", "c.*"), "centres")
            x, y = rows.alias("x"), centre.alias("y")
            together = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.lead") == F.col("y.lead"))
            pairs = (x.join(y, together & (F.col("x.root") != F.col("y.root")) & _first_met() & _may_match(percent))
                     .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
            pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested = tested.unionByName(pairs)
            new = saved(pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
                        .mapInArrow(_verify(width, percent), "a long, b long"), "links")
            if not new.isEmpty():
                ends = new.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").select(
                    F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
                merged = connected_components(ends)
                old = roots.join(merged.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
                roots = saved(old.unionByName(merged.join(old, "node", "left_anti")), "roots")
            turn += 1
            if once:
                break
            left = saved(rows.select("lead", "sig", "node").join(centre.select("lead", "sig", "node"), ["lead", "sig", "node"], "left_anti"), "signatures")
            centres *= GROWTH
    return roots
