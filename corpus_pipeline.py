"""A training-data pipeline over `documents` from five of the `llm` operators.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``docs``:

1. ``language_id``: documents without a determinable language go (no letter,
   or none of the n-grams of any learnt language).
2. ``jaccard_join``: one document of each near-duplicate class stays, the one
   with the smallest id (rows without an id come last).
3. ``decontamination``: documents with a verified benchmark item go.
4. ``secret_scan``: secrets are replaced by a mask; no document goes.
5. ``sentencepiece``: the ids of every document and the text they decode to.

Rows with a null or repeated id are documents of their own, told apart by their
text; of copies one stays, whatever their ids. Empty tables
give empty results with the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bm25_decontam, jaccard_join, language_id, piece_codec
from quayside.llm import blob_ledger
from quayside.session import checkpoint_root

ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def keep_one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return bm25_decontam.clean(docs, items, answers=False)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return blob_ledger.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = piece_codec.decode_documents(piece_codec.encode_documents(docs))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("jaccard_join", keep_one_per_class),
    ("decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
