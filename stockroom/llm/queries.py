"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm import (alignment, byte_bpe, fingerprints, forest_search, infill, language_crf,
                           minhash_dedup, mixing_lm, packing, pii, secret_scan, substring_dedup, toxicity)
from stockroom.llm.kernels import stash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                    public_tokenizers.path("word_bpe_49k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter(id_crc(4) != 2))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(id_crc(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "evidence")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest_search.nearest(rows, rows.filter("vec_id % 50 = 0"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = secret_scan.spans_text(F.col("spans"))

    def count(rank: int):
        return F.size(F.filter("spans", lambda p: p["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("spans", "linked")).alias("spans"))


# A fixed key, so that results can be compared; a real run passes its own.
PII_KEY = b"public demonstration key"


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("doc_id", F.size("pii_spans").cast("long").alias("n_found"),
                      F.array_join(F.transform("pii_spans", lambda p: F.concat_ws(
                          ":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",").alias("spans"), "text")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, ["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = mixing_lm.score(docs, id_crc(10) != 0)
    return out.select("doc_id", F.coalesce(id_crc(10) == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score", "bits_per_byte")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(infill.restore("output", "form"), 256).alias("restored_sha256"))


def op12_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_crf.fit(docs.filter(F.coalesce(id_crc(4) != 2, F.lit(True))))
    spans = F.array_join(F.transform("spans", lambda p: F.concat_ws(
        ":", p["lang"], p["start"].cast("string"), p["end"].cast("string"))), ",")
    return language_crf.label(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(id_crc(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", spans.alias("spans"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    kept = stash(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return kept.join(alignment.score_links(kept), "rid").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run
    return run(spark, sf_dir)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_secret_scan": op5_secret_scan,
    "op6_pii": op6_pii,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_fingerprints": op9_fingerprints,
    "op10_mixing_lm": op10_mixing_lm,
    "op11_infill": op11_infill,
    "op12_language_crf": op12_language_crf,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

# Words of the contracts, and lower case of A-Z alone.
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    # all pairs of documents that share a shingle, and the closure of the links
    "op3_minhash_dedup": f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, {WORDS.format(LOW)} AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), z AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
                        FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN z za ON za.doc_id = p.a JOIN z zb ON zb.doc_id = p.b
  WHERE 100 * p.both >= 85 * (za.n + zb.n - p.both)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a
)
SELECT c.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM c LEFT JOIN z USING (doc_id)
""",
    # windows of 50 words compared as text
    "op7_substring_dedup": f"""
WITH w AS MATERIALIZED (
  SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents
), win AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)
), f AS (
  SELECT k, min(doc_id) AS m FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos
  FROM (SELECT win.doc_id, win.i FROM win JOIN f USING (k) WHERE f.m < win.doc_id)
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w
), kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.pos) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY words.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    # the units of a text are its parts between line feeds, with their line feed
    "op11_infill": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, string_split(t, chr(10)) AS parts,
         CAST(length(t) - length(replace(t, chr(10), ''))
              + CASE WHEN t = '' OR right(t, 1) = chr(10) THEN 0 ELSE 1 END AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 AS plain
  FROM u
), l AS (
  SELECT *,
         length(array_to_string(parts[1:a], chr(10))) + CASE WHEN a > 0 AND a < len(parts) THEN 1 ELSE 0 END AS x,
         length(array_to_string(parts[1:b], chr(10))) + CASE WHEN b > 0 AND b < len(parts) THEN 1 ELSE 0 END AS y
  FROM c
), f AS (
  SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         substr(t, 1, x) AS p, substr(t, x + 1, y - x) AS m, substr(t, y + 1) AS s
  FROM l
)
SELECT doc_id, n, form,
       CASE WHEN plain THEN NULL ELSE CAST(x AS BIGINT) END AS prefix_chars,
       CASE WHEN plain THEN NULL ELSE CAST(y - x AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM f
""",
}
