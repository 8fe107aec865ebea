"""Line dedup, fill-in-the-middle and vector codes against brute force, on odd and on empty tables."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import common, fill_middle, line_dedup, vector_codes
from propensity.llm.cuckoo import CuckooFilter

SF = "/root/testdata/sf0.001"
C = collections.Counter


@pytest.fixture(scope="module")
def docs(spark):
    return common.documents(spark, SF)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def hashes(n, seed=1):
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


def test_cuckoo_filter_inserts_deletes_and_grows():
    a, b = hashes(3000), hashes(20_000, 2)
    f = CuckooFilter()
    f.insert(a[:1000])
    f.insert(a[1000:])
    f.insert(b)
    assert len(f) == 23_000 and f.contains(a).all() and f.contains(b).all()
    assert f.contains(hashes(100_000, 3)).mean() < 0.002
    f = CuckooFilter.load(f.dump())
    f.delete(a)
    assert f.contains(b).all() and f.contains(a).mean() < 0.01 and len(f) == 20_000
    f.delete(b)
    assert len(f) == 0 and not f.contains(b).any()


def test_cuckoo_filter_keeps_equal_fingerprints_apart():
    same = np.full(7, 5, np.uint64) + (np.arange(7, dtype=np.uint64) << np.uint64(30))   # one fingerprint, one bucket when small
    f = CuckooFilter()
    f.insert(same)
    f.delete(same[:6])
    assert len(f) == 1 and f.contains(same[6:]).all()
    with pytest.raises(KeyError):
        f.delete(hashes(4))


def brute_lines(rows, index, least=10):
    first = {}
    for i, t in index:
        for line in (t or "").encode().split(b"\n") if i is not None else ():
            k = line.strip().lower()
            first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if i is None or len((k := x.strip().lower()).decode()) < least or first.get(k, i) >= i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return C(out)


LINES = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


@pytest.fixture(scope="module")
def lined(spark):
    """Lines shared by many documents, short keys, code points against bytes, white space, null and repeated ids."""
    hot = "A licence line of all documents"
    rows = [(i, f"{hot}\nline of its own {i}\n \thot two {i % 3} hot hot\x0b\r\nshort") for i in range(30)]
    rows += [(5, "another row of five\n" + hot), (5, hot), (31, hot.upper() + "\n" + hot), (32, None), (33, ""), (34, "\n\n"), (35, "éééééééééé\nééééééééé"),
             (36, "éééééééééé\nééééééééé"), (None, hot), (None, hot), (37, "x" * 300_000 + "\n" + hot), (38, "x" * 300_000), (-4, "line of its own 7")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS chunk", "text AS key", "1 AS shard", "2 AS first", "3 AS n")


@pytest.mark.parametrize("table", ["docs", "odd", "empty", "lined"])
def test_line_dedup(request, table, monkeypatch):
    monkeypatch.setattr(line_dedup, "group_count", lambda d, per_group: 5)
    df = request.getfixturevalue(table)
    got = line_dedup.line_dedup(df).collect()
    assert C(tuple(r[c] for c in LINES) for r in got) == brute_lines(texts_of(df), texts_of(df))
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def state(index):
    counts = {(bytes(r["key"])): (r["n"], r["first"]) for r in index.counts().collect()}
    assert len(counts) == index.counts().count()
    held = {r["shard"]: (CuckooFilter.load(r["held"]), CuckooFilter.load(r["shared"])) for r in index._filters().collect()}
    shards = {bytes(r["key"]): r["shard"] for r in index.counts().collect()}
    for which, least in ((0, 1), (1, 2)):
        keys = [k for k, (n, _) in counts.items() if n >= least]
        assert sum(len(f[which]) for f in held.values()) == len(keys)
        for k in keys:
            assert held[shards[k]][which].contains(np.frombuffer(k, "<u8")[1:]).all()
    return counts


def test_line_index_is_reversible(spark, lined):
    """Batches in any order and deletions leave the index that the documents left would have given."""
    rows = texts_of(lined)
    some = lined.where("doc_id % 2 = 0 OR doc_id IS NULL")
    rest = lined.where("doc_id % 2 <> 0")
    once = line_dedup.LineIndex.create(spark, shards=3)
    once.insert(lined)
    index = line_dedup.LineIndex.create(spark, shards=3)
    index.insert(rest)
    index.insert(some)
    assert state(index) == state(once)
    assert C(tuple(r[c] for c in LINES) for r in index.apply(lined, chunks=4).collect()) == brute_lines(rows, rows)

    index = line_dedup.LineIndex.open(spark, index.path)
    gone = {-4, 0, 1, 5, 31, 777}
    index.delete(spark.createDataFrame([(g,) for g in gone] + [(None,), (0,)], "doc_id long"))
    left = [(i, t) for i, t in rows if i not in gone]
    fresh = line_dedup.LineIndex.create(spark, shards=3)
    fresh.insert(lined.where(~F.coalesce(F.col("doc_id").isin(list(gone)), F.lit(False))))
    assert state(index) == state(fresh)
    assert C(tuple(r[c] for c in LINES) for r in index.apply(lined, chunks=4).collect()) == brute_lines(rows, left)

    index.compact(shards=5)
    assert state(line_dedup.LineIndex.open(spark, index.path)) == state(fresh)
    index.insert(lined.where("doc_id IN (-4, 0, 1, 5, 31)"))
    assert state(index) == state(once)


def test_line_index_ignores_an_uncommitted_generation(spark, lined):
    index = line_dedup.LineIndex.create(spark, shards=2)
    index.insert(lined.where("doc_id < 10"))
    before = state(index)
    index._write(index._read("refs").drop("gen"), "refs", 2)    # as if the job ended here
    again = line_dedup.LineIndex.open(spark, index.path)
    assert state(again) == before
    again.insert(lined.where("doc_id >= 10"))
    whole = line_dedup.LineIndex.create(spark, shards=2)
    whole.insert(lined.where("doc_id IS NOT NULL"))
    assert state(again) == state(whole)


def brute_fim(rows, rate=100, spm=50):
    out = []
    for i, t in rows:
        t = t or ""
        u = re.findall(r"[^\n]*\n|[^\n]+", t)
        h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
        n = len(u)
        sha = hashlib.sha256(t.encode()).hexdigest()
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
            out.append((i, n, "plain", None, None, sha, sha))
            continue
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
        form = "spm" if h4 % 100 < spm else "psm"
        y = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
        out.append((i, n, form, len(p), len(m), hashlib.sha256(y.encode()).hexdigest(), sha))
    return C(out)


FIM = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@pytest.fixture(scope="module")
def marked(spark):
    """Sentinels, halves of sentinels next to cuts, no last newline, long lines, code points, null and repeated ids."""
    rows = [(i, "".join(f"é line {j} <\n" if j % 3 else f"<P\n>S><M {j}\n" for j in range(i))) for i in range(40)]
    rows += [(50, "a<P>b"), (51, "x\n<S>"), (52, "<M>\n"), (53, None), (54, ""), (55, "\n"), (56, "\n\n\n"), (57, "one line"), (None, "null id\ntwo\n"),
             (None, "null id\ntwo\n"), (58, "é" * 70_000 + "\n<"), (59, "z\n" * 50_000), (57, "one line"), (57, "other\ntext <\n<"), (2**62, "<\n<\n<\n<")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS place", "text AS data", "1 AS n", "'a' AS sha", "2 AS copies")


@pytest.mark.parametrize("table", ["docs", "odd", "empty", "marked"])
@pytest.mark.parametrize("piece", [7, fill_middle.PIECE])
def test_fill_in_middle(request, table, piece):
    df = request.getfixturevalue(table)
    if piece == 7:
        df = df.where("text IS NULL OR length(text) < 5000")
    got = fill_middle.fill_in_middle(df, piece=piece).select(*FIM).collect()
    assert C(map(tuple, got)) == brute_fim(texts_of(df))


def test_fill_in_middle_rates_and_texts(marked):
    got = fill_middle.fill_in_middle(marked, fill_middle.Layout(rate=60, suffix_first=20)).select(*FIM).collect()
    assert C(map(tuple, got)) == brute_fim(texts_of(marked), 60, 20)
    texts = fill_middle.fill_in_middle_texts(marked).collect()
    digests = {(r["doc_id"], r["output_sha256"]) for r in fill_middle.fill_in_middle(marked).collect()}
    assert {(r["doc_id"], hashlib.sha256(r["output"].encode()).hexdigest()) for r in texts} == digests


def test_fill_in_middle_has_one_exchange(marked):
    plan = fill_middle.fill_in_middle(marked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


def brute_codes(rows, parts=8, k=16, rounds=6):
    """Plain Python k-means over integer parts."""
    good = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(good[0][1]) // parts
    good.sort(key=lambda r: (r[0] is None, r[0] or 0))
    cut = [[q[w * p:w * p + w] for p in range(parts)] for _, q, _ in good]
    books = [[list(cut[e][p]) for e in range(min(k, len(cut)))] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for q in cut:
                groups[near(q[p], books[p])[1]].append(q[p])
            for e, g in groups.items():
                books[p][e] = [sum(c) // len(g) for c in zip(*g)]
    got = [[near(q[p], books[p]) for p in range(parts)] for q in cut]
    errors, total = [sum(d for d, _ in g) for g in got], collections.defaultdict(int)
    for (_, _, lab), e in zip(good, errors):
        total[lab] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return C((i, "".join(f"{e:02x}" for _, e in g), err, total[lab], sha) for (i, _, lab), g, err in zip(good, got, errors))


CODES = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("n", [300, 9, 16])
def test_vector_codes_match_plain_k_means(spark, n):
    rng = np.random.default_rng(n)
    v = (rng.integers(-6, 7, (n, 16)) / 8).astype(np.float32)     # many ties
    v[n // 3:n // 2] = v[0]
    rows = [(int(i) * 3 - 50, [float(x) for x in v[i]], int(i % 4) if i % 5 else None) for i in range(n)]
    rows += [(1000, None, 1), (1001, [float("nan")] + [0.0] * 15, 1), (1002, [None] + [0.0] * 15, 1), (1003, [float("-inf")] + [0.0] * 15, None), (-900, None, 2)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<float>, label int").repartition(3).selectExpr("*", "1 AS part", "2 AS entry", "label AS code", "vec_id AS of")
    got = vector_codes.compress_vectors(df).select(*CODES).collect()
    assert C(map(tuple, got)) == brute_codes(rows)


def test_vectors_that_cannot_be_coded_stay(spark):
    rows = [(1, [0.5] * 16, 1), (2, [1.5] * 16, None), (3, [0.5] * 8, 1), (4, [], None), (5, [1e30] + [0.0] * 15, 1), (None, [0.25] * 16, 7), (2, [1.5] * 16, 7)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>, label int")
    got = {(r["vec_id"], r["label"]): r for r in vector_codes.compress_vectors(df).collect()}
    assert len(got) == 7 and [k for k, r in got.items() if r["code"] is None] and got[3, 1]["code"] is None and got[5, 1]["error"] is None
    assert got[1, 1]["label_error"] == 0 and got[1, 1]["code"] != got[2, None]["code"] == got[2, 7]["code"]
    none = vector_codes.compress_vectors(df.where("vec_id = 4"))
    assert [(r["code"], r["codebooks_sha256"]) for r in none.collect()] == [(None, hashlib.sha256(b"").hexdigest())]
    assert vector_codes.compress_vectors(df.where("vec_id = 9")).count() == 0


def test_pivot_bounds_prune_and_change_nothing():
    rng = np.random.default_rng(5)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    x = centres[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 8))
    pivots = vector_codes.farthest_first(centres, 4)
    far = np.sqrt(vector_codes._squared(x[:, None], pivots[None]))
    index, best, evaluated = vector_codes.nearest_entry(x, far, centres, pivots)
    full = vector_codes._squared(x[:, None], centres[None])
    assert (index == full.argmin(1)).all() and (best == full.min(1)).all()
    assert evaluated < 0.3 * full.size
