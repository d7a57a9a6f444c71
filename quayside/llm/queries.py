"""Registered queries of the `llm` operators (and DuckDB SQL where it can say it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import (blob_ledger, bm25_decontam, edit_counts, id_coder, jaccard_join,
                          language_id, line_crf, lp_packing, piece_codec, qd_whitening,
                          repeat_spans, slot_shards, spelling_variants)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard (0 to 7) and position in it."""
    return slot_shards.shard_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified leaks of test items in documents."""
    return bm25_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                               answers=False)


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to coded files and read back."""
    return id_coder.round_trip(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line labelling's verdict on every document."""
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 35-word windows that occur elsewhere too."""
    return repeat_spans.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after edits."""
    return edit_counts.revised(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return jaccard_join.near_classes(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return piece_codec.digests(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt on the folds not held out."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    return blob_ledger.digests(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's whitened components."""
    return qd_whitening.components(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word's form, root and number of near words."""
    return spelling_variants.document_variants(table(spark, sf_dir, "documents"))


def op13_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1,024 tokens."""
    return lp_packing.packed(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_slot_shards": op1_slot_shards,
    "op2_decontamination": op2_decontamination,
    "op3_token_ids": op3_token_ids,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_secret_scan": op10_secret_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_lp_packing": op13_lp_packing,
}


def _spans_sql(rule: blob_ledger.Rule, order: int) -> str:
    """Spans of one rule: pieces between matches and matches, lengths added up."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
      SELECT doc_id, '{rule.kind}' AS kind, {order} AS ord, a AS start, a + len(m) AS stop
      FROM (SELECT doc_id, m, v,
                   sum(len(p) + coalesce(len(m), 0)) OVER (PARTITION BY r ORDER BY i)
                   - coalesce(len(m), 0) AS a
            FROM (SELECT doc_id, r, unnest(p) AS p, unnest(list_resize(m, len(p))) AS m,
                         unnest(list_resize(v, len(p))) AS v, unnest(range(len(p))) AS i
                  FROM (SELECT doc_id, r, string_split_regex(t, '{pattern}') AS p,
                               regexp_extract_all(t, '{pattern}') AS m,
                               regexp_extract_all(t, '{pattern}', {rule.group}) AS v FROM d)))
      WHERE len(v) >= {rule.least}"""


SECRETS_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS (""" + " UNION ALL ".join(_spans_sql(r, i) for i, r in enumerate(blob_ledger.RULES)) + """),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
             count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
      FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""

ORACLES: dict[str, str] = {
    "op10_secret_scan": SECRETS_SQL,
}
