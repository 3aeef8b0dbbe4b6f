"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm import bag_minhash, cross_parsing, mixing, packing, pii
from surveylake.llm.common import column, saved
from surveylake.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame, *names: str) -> DataFrame:
    """The whole rows in one column beside those that a stage reads, so its own columns replace none of theirs."""
    return docs.select(F.struct(*map(column, docs.columns)).alias("carried"), *map(column, names))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised; those without a letter go."""
    model = cross_parsing.fit(docs, ~cross_parsing.held_out())
    found = cross_parsing.identify(_carried(docs, "text"), model)
    return found.where(F.col("lang_pred") != cross_parsing.UNKNOWN).select("carried.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return bag_minhash.deduplicated(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; ``n_chars`` follows the new text."""
    return pii.redact(docs, n_chars="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come closer to equal shares, in random order."""
    return mixing.mixed(_carried(docs, "doc_id", "source")).select("carried.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the tokens of all documents in sequences of 1024."""
    pieces = packing.token_pieces(docs, tokenizer_path(), forget=True)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))).placed


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models, signatures and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
