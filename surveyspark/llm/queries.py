"""The operators over whole tables, by query name."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surveyspark.llm.chat import format_conversations, read_back
from surveyspark.llm.decontaminate import contaminated
from surveyspark.llm.divergence import divergences
from surveyspark.llm.fingerprint import fingerprint_documents
from surveyspark.llm.gru_lm import score_documents
from surveyspark.llm.html_text import extract_text
from surveyspark.llm.jaccard_join import jaccard_join
from surveyspark.llm.language import identify_language
from surveyspark.llm.merkle import verified_manifest
from surveyspark.llm.oracle import divergence_sql, merkle_sql
from surveyspark.llm.packing import pack_documents
from surveyspark.llm.personal import personal_data
from surveyspark.llm.sentence_dedup import dedup_sentences
from surveyspark.llm.url_filter import judge_urls, labelled_urls

Query = Callable[[SparkSession, str], DataFrame]


#: The rules that URLs are judged by (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def on_workers(spark: SparkSession) -> None:
    """Python workers of the session find this package, and get long texts in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment
    have = paths.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        paths["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(turns.unionByName(extra)))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules, labelled_urls(spark))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_sentences(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", "n_chars", "n_removed")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(_table(spark, sf_dir, "documents"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (op1_ngram_jaccard_join, op2_document_fingerprints, op3_best_fit_packing, op4_chat_formatting,
                  op5_url_filters, op6_html_extraction, op7_language_id, op8_substring_dedup,
                  op9_benchmark_decontamination, op10_lm_scoring, op11_merkle_manifest,
                  op12_source_divergence, op13_personal_data)
}

#: The letters that op1 lower-cases.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs that share a shingle, for tables of the size that SQL is compared on.
ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE
      WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS overlap FROM shingle x JOIN shingle y
    ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
  WHERE 100 * overlap >= 85 * (x.n + y.n - overlap)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, step.b FROM reach
    JOIN (SELECT a, b FROM link UNION ALL SELECT b, a FROM link) step ON reach.b = step.a)
SELECT d.doc_id, cast(coalesce(n, 0) AS bigint) AS n_shingles, component_id
FROM documents d LEFT JOIN size USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON d.doc_id = a""",
    "op11_merkle_manifest": merkle_sql(),
    "op12_source_divergence": divergence_sql(),
}
