"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage gets ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept: toxic documents go, one document of each group of near copies (five-word shingles,
similarity of 0.8 or more) stays,
documents that hold benchmark passages go, secrets are masked, and the rest is
encoded and decoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mapweave.llm import bpe, decontam, jaccard, secrets, toxicity
from mapweave.llm.common import read
from mapweave.llm.queries import vocabulary
from mapweave.session import materialize


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def _ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, least=80, shingle=5)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def _secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, secrets.train(docs))


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", _toxicity),
    ("ngram_jaccard", _ngram_jaccard),
    ("decontamination", _decontamination),
    ("secret_scan", _secret_scan),
    ("bpe", _bpe),
]

# models and tokenizer are no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. Each stage's table is staged in the shared checkpoint folder.

    The tables go with the innermost open ``session.staging`` block, or else with the application.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
