"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.llm import bpe, licenses, line_dedup, metric_join, neighbours, ngram_join, packing, pii, quality, secrets


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op2_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.range_join(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "score", "keep")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(table(spark, sf_dir, "documents")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
rows_ AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM rows_),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT keyed.*, coalesce(owner <> doc_id, false) AS lost FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, cast(sum(lost::INT) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents have no file names, so licence files are known by their texts; without a source there is no directory
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    path = F.when(F.trim("source") != "", F.concat_ws("/", "source", "lang", name))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    return licenses.scan(docs, "doc_id", "path", by_text=True)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id, vec_id <= coalesce(low.b, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

OP10_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\\x09-\\x0D ]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 10 * m >= 8 * (x.n + y.n - m)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_links, least(doc_id, coalesce(low.b, doc_id)) AS class_id FROM documents LEFT JOIN n ON n.a = doc_id LEFT JOIN low ON low.a = doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_metric_join": op2_metric_join,
        "op3_quality": op3_quality,
        "op4_pii": op4_pii,
        "op5_bpe": op5_bpe,
        "op6_line_dedup": op6_line_dedup,
        "op7_neighbours": op7_neighbours,
        "op8_licenses": op8_licenses,
        "op9_packing": op9_packing,
        "op10_ngram_join": op10_ngram_join,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_metric_join": OP2_SQL, "op6_line_dedup": OP6_SQL, "op10_ngram_join": OP10_SQL}
