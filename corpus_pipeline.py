"""The corpus pipeline: ``documents`` filtered, deduplicated, decontaminated, mixed and encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from greenwave.llm import mixing, ngram_join, quality, token_files, winnowing
from greenwave.llm.common import stored, table
from greenwave.llm.queries import tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, trained on all rated documents, does not reject."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality")
    return quality.good_documents(docs, model)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near duplicates."""
    return ngram_join.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, read back from the token files."""
    return token_files.encode_and_read(docs, tokenizer_file())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]

#: Classifier, hash order and tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("/", "-"))
    return docs
