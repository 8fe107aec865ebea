"""Registered queries of the training-data operators and their DuckDB SQL.

Each query reads a whole table, applies one operator with its production parameters and derives
the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.chat_format import as_transcripts, fit_chat, format_chat
from propensity.llm.common import documents, held_out
from propensity.llm.exact_dedup import exact_dedup
from propensity.llm.fill_middle import fill_in_middle
from propensity.llm.fingerprints import fingerprint_documents
from propensity.llm.jaccard_join import jaccard_join
from propensity.llm.language import fit_language, identify_language
from propensity.llm.line_dedup import line_dedup
from propensity.llm.mix_sources import mix_sources
from propensity.llm.packing import pack
from propensity.llm.quality import fit_quality, score_quality
from propensity.llm.substring_dedup import substring_dedup
from propensity.llm.token_files import read_token_files, write_token_files
from propensity.llm.tokens import tokenizer_path
from propensity.llm.vector_codes import compress_vectors
from propensity.session import table_path


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts made from conversations; the model learns from those whose conv_id is not held out."""
    lines = as_transcripts(spark.read.parquet(table_path(sf_dir, "conversations")))
    model = fit_chat(lines.where(~held_out(F.col("conv_id"))))
    return format_chat(lines, model).withColumn("held_out", held_out(F.col("conv_id")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup(documents(spark, sf_dir), window=13, with_text=False)
    return got.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end=2)
    return read_token_files(files, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit_quality(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir), width=4, percent=85, with_links=False).select("doc_id", "n_shingles", "component_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end=2)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify_language(docs, fit_language(docs), with_spans=False)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir), with_text=False)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(table_path(sf_dir, "embeddings")).select("vec_id", F.col("embedding").alias("vector"), "label")
    return compress_vectors(vectors).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_mix_sources": op6_mix_sources,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_language_id": op10_language_id,
    "op11_line_dedup": op11_line_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_vector_codes": op13_vector_codes,
}


def _codebook_rounds(rounds: int) -> str:
    """Common table expressions of the rounds: nearest entries a<k> and the entries c<k+1> made of them."""
    near = """
a{k} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min(struct_pack(d := d, e := entry)) AS m FROM (
        SELECT p.r, p.part, p.x, c.entry, CAST(list_sum([(p.x[j] - c.c[j]) * (p.x[j] - c.c[j]) for j in range(1, len(p.x) + 1)]) AS BIGINT) AS d
        FROM p JOIN c{k} c USING (part)) GROUP BY r, part)"""
    mean = """
c{n} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(u.c, o.c) AS c FROM c{k} o LEFT JOIN (
        SELECT part, entry, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS c FROM (
          SELECT part, m.e AS entry, j, sum(x[j]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM a{k}) GROUP BY ALL)
        GROUP BY part, entry) u USING (part, entry))"""
    return ",".join(near.format(k=k) + "," + mean.format(k=k, n=k + 1) for k in range(rounds)) + "," + near.format(k=rounds)


ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, w[s:s + 12] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d)),
least AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
hit AS (SELECT win.doc_id, win.s FROM win JOIN least USING (g) WHERE m < win.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM hit),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT each.doc_id, count(gone.i) AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY each.i) FILTER (WHERE gone.i IS NULL), '') AS k
         FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.i = gone.i GROUP BY each.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
tok AS (SELECT DISTINCT doc_id, g FROM (
          SELECT doc_id, w[s:s + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS s FROM d)
          UNION ALL SELECT doc_id, w FROM d WHERE len(w) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tok a JOIN tok b ON a.g = b.g AND a.doc_id <> b.doc_id
         JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
         GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id""",
    "op6_mix_sources": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][sid % 3 + 1] AS DOUBLE) AS w, source_size * CAST(2.0 AS DOUBLE) AS cap FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total, row_number() OVER (ORDER BY cap / w, sid) AS nth,
             coalesce(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
f AS (SELECT *, (total - before) / rest AS level FROM l),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, nth) FROM f WHERE level < cap / w) * w, cap)) AS target FROM f),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS reps
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, target - reps * source_size AS left_over, CAST(sum(size) OVER (PARTITION BY source ORDER BY key) AS BIGINT) AS upto,
             CAST(sum(size) OVER (PARTITION BY source, key) AS BIGINT) AS tied FROM r),
e AS (SELECT *, CASE WHEN upto <= left_over THEN 1
                     WHEN upto - tied <= left_over AND (left_over - (upto - tied)) * 2 >= tied THEN 1 ELSE 0 END AS extra FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * (reps + extra) AS BIGINT) AS taken FROM e""",
    "op7_exact_dedup": r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op11_line_dedup": r"""
WITH l AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM (
             SELECT doc_id, unnest(u) AS line, unnest(range(len(u))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS u FROM documents))),
f AS (SELECT k, min(doc_id) AS m FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
x AS (SELECT l.*, coalesce(f.m < l.doc_id, false) AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM x GROUP BY doc_id""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, len(u) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS r FROM d),
c AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
                     WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
             least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b FROM e),
s AS (SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS x FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m ELSE '<S>' || x || '<P>' || p || '<M>' || m END AS y FROM s),
k AS (SELECT *, strpos(y, '<P>') AS kp, strpos(y, '<S>') AS ks, strpos(y, '<M>') AS km FROM o)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(y) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN y WHEN 'psm' THEN substr(y, 4, ks - 4) || substr(y, km + 3) || substr(y, ks + 3, km - ks - 3)
                        ELSE substr(y, kp + 3, km - kp - 3) || substr(y, km + 3) || substr(y, 4, kp - 4) END) AS restored_sha256 FROM k""",
    "op13_vector_codes": r"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
                  [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
p AS MATERIALIZED (SELECT r, part, q[len(q) // 8 * part + 1:len(q) // 8 * (part + 1)] AS x FROM (SELECT *, unnest(range(8)) AS part FROM v)),
c0 AS (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 16),""" + _codebook_rounds(6) + r""",
g AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a6 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS s FROM c6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h.s AS codebooks_sha256
FROM v JOIN g USING (r), h""",
}
