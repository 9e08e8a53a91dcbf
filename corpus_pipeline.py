"""A corpus pipeline: quality, language, near duplicates, source mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import jaccard, language, mixing, packing, repetition
from ebbflow.llm.queries import PACK_END, PACK_VOCABULARY
from ebbflow.llm.registry import table
from ebbflow.llm.store import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text passes the repetition rules, as they were."""
    return repetition.keep_good(docs)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the evidence supports; lang holds it."""
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as much of them, as the target weights ask for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids."""
    return packing.pack(docs, PACK_VOCABULARY, PACK_END)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", pack),
]

# tokenizer ids and a trained model have no SQL; tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
