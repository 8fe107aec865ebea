"""The training-data operators against brute force on small inputs, and on odd and empty tables."""

import collections
import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propensity.llm import chat_format, common, exact_dedup, fingerprints, jaccard_join, language, mix_sources, packing, quality, substring_dedup, textnp, token_files, tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return common.documents(spark, SF)


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_words_and_hashes():
    texts = ["a b  a", "", None, "\x0bé\x1cx y", "a b"]
    buf, off = textnp.buffer_of(pa.array(texts))
    starts, ends, first = textnp.word_spans(buf, off)
    assert [bytes(buf[s:e]) for s, e in zip(starts, ends)] == [w for t in texts for w in (t or "").encode().split()]
    h = textnp.word_hashes(buf, starts, ends)
    assert h[0] == h[2] == h[5] and h[0] != h[1] and first.tolist() == [0, 3, 3, 3, 5, 7]


def brute_substrings(rows, window=13):
    first = {}
    for i, t in rows:
        w = t.encode().split()
        for k in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = t.encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_substring_dedup(request, table, monkeypatch):
    df = request.getfixturevalue(table)
    monkeypatch.setattr(substring_dedup, "group_count", lambda d: 5)
    got = substring_dedup.substring_dedup(df, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert collections.Counter(map(tuple, got)) == brute_substrings(texts_of(df))


def shingles(text, k):
    w = text.encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            known = sets[a] == sets[b] or None not in (rows[a][0], rows[b][0])
            if known and sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    low = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            low[find(n)] = min(low.get(find(n), i), i)
    return collections.Counter((i, len(sets[n]), low.get(find(n)) if sets[n] else i) for n, (i, _) in enumerate(rows))


@pytest.mark.parametrize("table,classes,small", [("docs", ((0, 1, 0), (2, 2, 4), (6, 3, 4)), 12), ("odd", jaccard_join.CLASSES, jaccard_join.SMALL), ("empty", jaccard_join.CLASSES, 64)])
def test_jaccard_join(request, table, classes, small):
    df = request.getfixturevalue(table)
    got = jaccard_join.jaccard_join(df, classes=classes, small=small).select("doc_id", "n_shingles", "component_id").collect()
    assert collections.Counter(map(tuple, got)) == brute_components(texts_of(df))


def test_jaccard_join_counts_every_link(spark):
    """A clique of near copies with exact copies among them, a chain whose ends are not linked, and texts without links."""
    base = [f"w{i}" for i in range(120)]
    clique = [" ".join(base[:115] + [f"c{k}"]) for k in range(12)]
    chain = [" ".join(f"v{i}" for i in range(6 * k, 100 + 6 * k)) for k in range(5)]
    texts = clique + clique[:2] + chain + ["nothing like it at all", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sets = {}
    for t in texts:
        w = (t or "").split()
        sets[t] = frozenset(tuple(w[k:k + 4]) for k in range(max(len(w) - 3, min(len(w), 1))))
    distinct = set(sets.values()) - {frozenset()}
    want = {i: sum(o != sets[t] and 100 * len(o & sets[t]) >= 85 * len(o | sets[t]) for o in distinct) for i, t in enumerate(texts)}
    assert want[0] == 11 and {want[i] for i in range(14, 19)} == {1, 2}
    got = jaccard_join.jaccard_join(df).collect()
    assert len(got) == len(texts) and {r["doc_id"]: r["n_links"] for r in got} == want
    bare = jaccard_join.jaccard_join(df, with_links=False)
    assert bare.columns == ["doc_id", "n_shingles", "component_id"] and sorted(map(tuple, bare.collect())) == sorted(tuple(r)[:3] for r in got)


def test_jaccard_join_meets_a_pair_seldom(spark, monkeypatch):
    """Texts just below the threshold of each other share many signatures: their pairs aren't met in each of them."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:8 * k] + [f"x{k}_{i}" for i in range(5)] + base[8 * k + 5:]) for k in range(1, 24)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kind, rows, tested = type(df), [], []
    distinct, saved = kind.distinct, jaccard_join.saved

    def counted(self):
        if self.columns == ["a", "b"]:
            rows.append(self.count())
        return distinct(self)

    def kept(df, name):
        got = saved(df, name)
        if name == "pairs":
            tested.append(got.count())
        return got

    monkeypatch.setattr(kind, "distinct", counted)
    monkeypatch.setattr(jaccard_join, "saved", kept)
    got = jaccard_join.jaccard_join(df, with_links=False).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got)
    assert sum(tested) >= 50 and sum(rows) <= 3 * sum(tested)


def test_jaccard_join_no_group_holds_a_hot_token(spark, monkeypatch, tmp_path):
    """Half of all tokens are one shingle: its bucket gets about what the others get."""
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('one shared licence line u', id) AS text").repartition(4)
    kind = type(df.groupBy("doc_id"))
    real, folder = kind.applyInArrow, str(tmp_path)

    def watched(self, func, schema):
        def run(table):
            if "bucket" in table.column_names:
                with open(os.path.join(folder, str(table.column("bucket")[0].as_py())), "w") as f:
                    f.write(str(table.nbytes))
            return func(table)
        return real(self, run, schema)

    monkeypatch.setattr(kind, "applyInArrow", watched)
    monkeypatch.setattr(jaccard_join, "group_count", lambda docs: 16)
    got = jaccard_join.jaccard_join(df).collect()
    assert len(got) == 4000 and all(r["component_id"] == r["doc_id"] and r["n_shingles"] == 2 for r in got)
    sizes = sorted(int(p.read_text()) for p in tmp_path.iterdir())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]


@pytest.mark.parametrize("table,block,digest", [("docs", 64, 16), ("docs", 64, 1), ("odd", 32, 16), ("empty", 64, 16)])
def test_exact_dedup(request, table, block, digest):
    df = request.getfixturevalue(table)
    got = exact_dedup.exact_dedup(df, block, digest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    groups = collections.defaultdict(list)
    for i, t in texts_of(df):
        groups[t.encode().lower()].append(i)
    want = [(i, max((x for x in ids if x is not None), default=None), len(ids), i == max((x for x in ids if x is not None), default=None), hashlib.sha256(t).hexdigest())
            for t, ids in groups.items() for i in ids]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_mix_sources(request, table):
    df = request.getfixturevalue(table)
    got = mix_sources.mix_sources(df, with_source=True).collect()
    sizes, names = collections.Counter(), {r["source"] for r in df.select("source").collect()}
    for r in df.select("source", "text").collect():
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    order = sorted(names, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(order)}
    target, left = {}, 1.5 * sum(sizes.values())
    live = list(order)
    while live:                                      # share by weight; stop the ones above twice their size; again
        w = sum(weight[s] for s in live)
        over = [s for s in live if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / w for s in live}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        live = [s for s in live if s not in over]
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == df.count()
    if table == "docs":
        assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    from tokenizers import Tokenizer
    rng = np.random.default_rng(5)
    bits = ["a", "B", "é", " ", "  ", "\n", "\t", "!", "'s", "12", "'", "\x1c", "\x85", "é", "中", "<|endoftext|>", "The", "ß."]
    texts = ["".join(rng.choice(bits, rng.integers(0, 25))) for _ in range(3000)]
    whole = Tokenizer.from_file(tokens.tokenizer_path(name))
    assert [x.tolist() for x in tokens.Encoder(tokens.tokenizer_path(name)).encode(texts)] == [e.ids + [2] for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_a_run_is_looked_up_once_a_batch():
    enc = tokens.Encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    seen, found = collections.Counter(), enc.runs

    class Counted:
        def __getitem__(self, run):
            seen[run] += 1
            return found[run]
    enc.runs = Counted()
    texts = ["The house, the garden.\nThe end", None, " the garden, the house."] * 50
    got = enc.encode(texts)
    assert set(seen.values()) == {1} and {" the", ",", "\n", " garden"} <= set(seen)
    assert [x.tolist() for x in got] == [found.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_coding_round_trip():
    for n in (0, 1, 3, 4, 1000):
        v = np.random.default_rng(n).choice([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], n).astype("<u4")
        assert token_files.decode_values(*token_files.encode_values(v), n).tolist() == v.tolist()


def ids_of(df, name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokens.tokenizer_path(name))
    return [(i, np.array(t.encode(x, add_special_tokens=False).ids + [2], "<u4")) for i, x in texts_of(df)]


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_token_files(request, table, monkeypatch):
    df = request.getfixturevalue(table)
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 5000)
    files = token_files.write_token_files(df, tokens.tokenizer_path("byte_bpe_50k.json"))
    got = token_files.read_token_files(files).collect()
    want = collections.Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in ids_of(df, "byte_bpe_50k.json"))
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and (r["doc_id"] if r["doc_id"] is not None else -1) >= last and len(r["ids"]) == r["n_tokens"]
        at, last = at + r["n_tokens"], r["doc_id"] if r["doc_id"] is not None else -1


def test_packing_plan_never_asks_for_more():
    rng = np.random.default_rng(3)
    for _ in range(5):
        h = rng.integers(0, 50, 32)
        used = np.zeros(32, int)
        for parts, n in packing.plan(h):
            assert sum(parts) == 32
            for p in parts:
                used[p - 1] += n
        assert (used <= h).all()


@pytest.mark.parametrize("table", ["docs", "odd", "empty"])
def test_packing(request, table):
    df = request.getfixturevalue(table)
    rows = packing.pack(df, tokens.tokenizer_path("word_bpe_49k.json")).collect()
    want = collections.Counter()
    for i, x in ids_of(df, "word_bpe_49k.json"):
        want[i] += len(x)
    per, seq = collections.Counter(), collections.defaultdict(list)
    ids = collections.defaultdict(list)
    for i, x in ids_of(df, "word_bpe_49k.json"):
        ids[i].append(x)
    for r in rows:
        per[r["doc_id"]] += r["length"]
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    assert per == want
    for places in seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_quality_held_out(spark):
    d = common.documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_quality(d, labels)
    got = quality.score_quality(d, model).where(common.held_out(F.col("doc_id"))).join(labels, "doc_id").select("score", "quality").collect()
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in got)
    assert right / len(got) > 0.9 and all(0 <= r["score"] <= 1 for r in got)


def test_quality_odd(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(odd, none)
    assert {r["score"] for r in quality.score_quality(odd, model).collect()} == {0.5}
    assert quality.score_quality(empty, model).count() == 0 and quality.score_quality(odd, model).columns == [*odd.columns, "score"]


def test_viterbi_is_the_best_path():
    import itertools
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 9, 10])
    score = rng.normal(size=(10, 3))
    path = language.viterbi(score, first, 0.7, cells=8)
    for s, e in zip(first[:-1], first[1:]):
        def value(p):
            return sum(score[s + t, k] for t, k in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
        if e > s:
            assert value(path[s:e]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=int(e - s)))))


def test_language(spark, odd, empty):
    d = common.documents(spark, "/root/testdata/sf0.01")
    model = language.fit_language(d)
    got = language.identify_language(d, model).join(d.select("doc_id", "lang"), "doc_id").where(common.held_out(F.col("doc_id"))).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.95
    en, de = (next(r["text"] for r in d.where(f"lang = '{x}' AND n_chars > 800").limit(1).collect()) for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, en[:600] + " " + de[:600])], "doc_id long, text string")
    assert {s["lang"] for s in language.identify_language(mixed, model).first()["spans"]} == {"en", "de"}
    by = {r["doc_id"]: r for r in language.identify_language(odd, model).collect()}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (4, 5, 6, 12))
    assert language.identify_language(empty, language.fit_language(empty)).count() == 0


def test_fingerprints(spark, docs, odd, empty):
    rows = sorted(texts_of(docs))
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs).collect()}
    seen = {}
    for n, (i, t) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][1]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(fingerprints.edited_text(t, nxt).encode()).hexdigest()
        assert seen.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in got.values()]) > np.mean([r["near_next"] for r in got.values()]) + 0.2
    assert fingerprints.fingerprint_documents(odd).count() == odd.count() and fingerprints.fingerprint_documents(empty).count() == 0


def test_chat_levels_give_the_viterbi_path(spark, monkeypatch):
    """Small segments, several levels: the same roles as one segment."""
    turns = spark.read.parquet(os.path.join(SF, "conversations.parquet"))
    lines = chat_format.as_transcripts(turns.withColumn("conv_id", F.lit(1).cast("long")).withColumn("turn", F.monotonically_increasing_id() % 100000))
    model = chat_format.fit_chat(lines)
    whole = {r["turn"]: (r["role_pred"], r["rendered"]) for r in chat_format.format_chat(lines, model).collect()}
    monkeypatch.setattr(chat_format, "SEGMENT", 3)
    assert {r["turn"]: (r["role_pred"], r["rendered"]) for r in chat_format.format_chat(lines, model).collect()} == whole


def test_chat_markers_and_odd_rows(spark):
    rows = [(1, 0, "user", "User: hello?"), (1, 1, "assistant", "Assistant: yes\nsecond line"), (1, 1, "assistant", "Assistant: yes\nsecond line"), (2, 0, None, None), (None, None, "user", "Human: x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    train = chat_format.as_transcripts(spark.read.parquet(os.path.join(SF, "conversations.parquet")))
    got = {(r["conv_id"], r["turn"]): r for r in chat_format.format_chat(df, chat_format.fit_chat(train)).collect()}
    assert len(got) == 4 and got[1, 0]["role_pred"] == "user" and got[1, 1]["role_pred"] == "assistant"
    assert got[1, 0]["rendered"] + got[1, 1]["rendered"] == "<|user|>\nhello?<|end|>\n<|assistant|>\nyes\nsecond line"
    assert chat_format.format_chat(df.limit(0), chat_format.fit_chat(df.limit(0))).count() == 0


def test_chat_segments_are_bounded_whatever_turn_holds(spark, monkeypatch):
    """Null, negative, repeated and far-off turns, and rows without conv_id: at most SEGMENT rows a segment, in order, none lost."""
    monkeypatch.setattr(chat_format, "SEGMENT", 3)
    rows = [(c, t, "user", f"line {i}") for i, (c, t) in enumerate([(1, None)] * 10 + [(1, -5), (1, -1), (1, 10**12)] + [(None, None)] * 8 + [(None, 4)] * 5 + [(2, -7)])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = collections.defaultdict(dict)
    for r in chat_format.segments(df).collect():
        assert len(r["turns"]) <= 3
        found[r["conv_id"]][r["node"]] = [(t["turn"], t["text"]) for t in r["turns"]]
    for conv, nodes in found.items():
        want = sorted((t or 0, x) for c, t, _, x in rows if c == conv)
        assert sorted(nodes) == list(range(-(-len(want) // 3))) and [x for k in sorted(nodes) for x in nodes[k]] == want
    got = chat_format.format_chat(df, chat_format.fit_chat(df)).collect()
    assert collections.Counter((r["conv_id"], r["turn"]) for r in got) == collections.Counter((c, t or 0) for c, t, _, _ in rows)
