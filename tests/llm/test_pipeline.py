"""The pipeline's stages against brute force, on odd, small and empty tables."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from propensity.llm import common, jaccard_join, language, mix_sources, quality, textnp, tokens

SF = "/root/testdata/sf0.001"
UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fold(text):
    return (text or "").encode().translate(UPPER)


def pairs(rows):
    return collections.Counter((r["doc_id"], r["text"]) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    return common.documents(spark, SF)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, empty, name):
    got = dict(corpus_pipeline.STAGES)[name](spark, empty, SF)
    assert got.count() == 0 and (name == "packing" or got.columns == empty.columns)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_quality_stage(request, spark, table):
    df = request.getfixturevalue(table).withColumn("quality", F.lit("x")).withColumn("__score", F.lit(1))
    got = corpus_pipeline.quality(spark, df, SF)
    model = quality.fit_quality(df, spark.read.parquet(f"{SF}/labels.parquet"))
    weight, bias = model.output[:, 1] - model.output[:, 0], model.bias[1] - model.bias[0]
    want = []
    for r in df.collect():
        idx, _ = quality.features(*textnp.buffer_of(pa.array([r["text"] or ""])))
        mean = sum((model.vectors[i].astype(float) for i in idx), np.zeros(quality.DIM)) / max(1, len(idx))
        if (1 / (1 + np.exp(-(mean @ weight + bias))) if len(idx) else model.prior) >= corpus_pipeline.LEAST_QUALITY:
            want.append(r)
    assert got.columns == df.columns and pairs(got.collect()) == pairs(want)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_exact_stage(request, spark, table):
    df = request.getfixturevalue(table)
    again = df.unionByName(df.where("doc_id IS NULL OR doc_id % 3 = 0").withColumn("lang", F.lit("zz")))
    rows = again.collect()
    last = {}
    for r in rows:
        key = fold(r["text"])
        last[key] = max(last.get(key, -1), -1 if r["doc_id"] is None else r["doc_id"])
    want = collections.Counter({(None if i < 0 else i, key): 1 for key, i in last.items()})
    got = corpus_pipeline.exact_duplicates(spark, again, SF).collect()
    assert collections.Counter((r["doc_id"], fold(r["text"])) for r in got) == want
    assert set(got) <= set(rows) and set(corpus_pipeline.exact_duplicates(spark, again.repartition(5), SF).collect()) == set(got)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_near_stage(request, spark, table):
    df = request.getfixturevalue(table)
    rows = df.collect()
    sets = []
    for r in rows:
        words = fold(r["text"]).split()
        sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    holders, root = collections.defaultdict(list), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, r in enumerate(rows):
        if r["doc_id"] is not None:
            for s in sets[n]:
                holders[s].append(n)
    near = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in near:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[top(a)] = top(b)
    least = {}
    for n, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[top(n)] = min(least.get(top(n), r["doc_id"]), r["doc_id"])
    stay = {r["doc_id"] for n, r in enumerate(rows) if r["doc_id"] is not None and least[top(n)] == r["doc_id"]}
    assert pairs(corpus_pipeline.near_duplicates(spark, df, SF).collect()) == pairs(r for r in rows if r["doc_id"] is None or r["doc_id"] in stay)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_mix_stage(request, spark, table):
    df = request.getfixturevalue(table).withColumn("copies", F.lit(9))
    before, after = df.collect(), corpus_pipeline.source_mix(spark, df, SF).collect()
    had, has = collections.Counter(before), collections.Counter(after)
    assert set(has) <= set(had) and all(n in (had[r], 2 * had[r]) for r, n in has.items())
    target = {r["source"]: r["target"] for r in mix_sources.mix_sources(df, with_source=True).collect()}
    for source, aim in target.items():
        size = sum(len(fold(r["text"]).split()) for r in after if r["source"] == source)
        most = max(sum(len(fold(x["text"]).split()) for x in before if (x["doc_id"], x["source"]) == (r["doc_id"], source)) for r in before if r["source"] == source)
        assert abs(size - aim) <= most


def test_empty_texts_are_copied_at_most_twice(spark):
    df = spark.createDataFrame([(i, "a b c" if i % 4 else "", "s") for i in range(200)] + [(500, "w " * 9000, "t")], "doc_id long, text string, source string")
    got = mix_sources.mix_sources(df, weights=(9, 1)).collect()
    assert max(r["copies"] for r in got) == 2


def test_run(spark):
    docs = common.documents(spark, SF)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, SF), "stage")
    enc = tokens.Encoder(tokens.tokenizer_path("word_bpe_49k.json"))
    want = collections.Counter((r["doc_id"], len(enc.encode([r["text"]])[0])) for r in docs.collect())
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert got == {k: n * k[1] for k, n in want.items()}


def test_long_words_built_to_collide():
    a, b = b"a", b"b"
    for _ in range(10):
        a, b = a + b, b + a
    for lower, texts in ((False, [a, b]), (True, [a, b, a.upper()])):
        buf, off = textnp.buffer_of(pa.array([t.decode() for t in texts]))
        starts, ends, _ = textnp.word_spans(buf, off)
        assert len(set(textnp.word_hashes(buf, starts, ends, lower).tolist())) == 2


def test_two_hundred_languages(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(200)]
    df = spark.createDataFrame([(n * 10 + k, f"{w} " * 20, f"l{n:03}") for n, w in enumerate(words) for k in range(8)], "doc_id long, text string, lang string")
    model = language.fit_language(df)
    got = language.identify_language(df, model, with_spans=False).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(model.languages) == 200 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.99


def test_a_training_step_follows_the_gradient():
    """One step from the start moves the output rows against the numerical gradient of the mean log loss."""
    rng = np.random.default_rng(11)
    bags = [(np.sort(rng.choice(500, 12, replace=False)).astype("<i4"), np.full(12, 1 / 12, "<f4")) for _ in range(8)]
    labels = np.array([0, 1] * 4)
    start = quality.train(bags, labels, rate=0.0)

    def loss(output, bias):
        out = 0.0
        for (idx, share), label in zip(bags, labels):
            z = (start.vectors[idx].astype(float) * share[:, None]).sum(0) @ output + bias
            out += np.log(np.exp(z - z.max()).sum()) + z.max() - z[label]
        return out / len(bags)

    import unittest.mock
    with unittest.mock.patch.object(quality, "STEPS", 1):
        moved = quality.train(bags, labels, epochs=1, rate=1e-3)
    step, at, e = 1e-3 * 10, start.output.astype(float), 1e-5
    for d in range(quality.DIM):
        for k in range(2):
            up, down = at.copy(), at.copy()
            up[d, k] += e
            down[d, k] -= e
            slope = (loss(up, start.bias) - loss(down, start.bias)) / (2 * e)
            assert (start.output[d, k] - moved.output[d, k]) / step == pytest.approx(slope, abs=1e-4)


def test_short_documents_take_a_worker_little_memory():
    """A worker's arrays follow the slice, not the Arrow batch: 10,000 short rows, and near pairs of long texts."""
    import tracemalloc
    rng = np.random.default_rng(2)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 60)]) for _ in range(10_000)]
    rows = pa.record_batch([pa.array(range(10_000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    long = [" ".join(words[rng.integers(0, 5000, 4000)]) for _ in range(300)]
    near = pa.record_batch([pa.array(range(300), pa.int64())] * 2 + [pa.array(long), pa.array([x + " tail" for x in long])], names=["a", "b", "text_a", "text_b"])
    for step, batch, most in ((jaccard_join._classes(5), rows, 40), (jaccard_join._sets(5), rows, 40), (jaccard_join._verify(5, 80), near, 12)):
        list(step(iter([batch.slice(0, 50)])))
        tracemalloc.start()
        got = sum(len(out) for out in step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert got == len(batch) and peak < most


def test_a_part_of_the_tokens_takes_a_worker_little_memory(spark, monkeypatch):
    """Asking, answering and hashing words hold a few arrays of a part's tokens; a part is 4 MB of text."""
    import tracemalloc

    def peak(step, *args):
        tracemalloc.start()
        out = step(*args)
        most = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        return out, most

    rng = np.random.default_rng(4)
    tokens = [np.sort(rng.integers(0, 2**63, 2000).astype(np.uint64)) for _ in range(300)]
    tokens.append(tokens[0][:700])
    sets = pa.table([pa.array([0] * 301, pa.int64()), pa.array([x.tobytes() for x in tokens], pa.binary())], names=["part", "tokens"])
    ask, most = peak(jaccard_join._ask(60), sets)
    assert most < 23 and sum(len(x) for x in ask.column("counts").to_pylist()) == 4 * 600_000
    shares = ask.slice(0, 30).set_column(0, "bucket", pa.array([0] * 30, pa.int64())).set_column(1, "part", pa.array(range(30), pa.int64()))
    answer, most = peak(jaccard_join._answer, pa.concat_tables([shares, shares]))
    twice = [np.frombuffer(x, "<u4") * 2 for x in shares.column("counts").to_pylist()]
    assert most < 40 and [x.tobytes() for x in twice] * 2 == answer.column("df").to_pylist()
    buf, off = textnp.buffer_of(pa.array([" ".join(f"word{i}" for i in range(110_000)) + " " + "x" * 300_000]))
    starts, ends, _ = textnp.word_spans(buf, off)
    got, most = peak(textnp.word_hashes, buf, starts, ends)
    monkeypatch.setattr(textnp, "_SEGMENT", 1 << 20)
    assert most < 16 and (got == textnp.word_hashes(buf, starts, ends)).all()
    assert jaccard_join.group_count(spark.range(12).selectExpr("repeat('x', 1048576) AS text")) == 3
