"""The stages of the corpus pipeline, each one operator as a filter or rewrite of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..workspace import Workspace
from . import langid, pii
from .common import table
from .decontaminate import drop_contaminated
from .packing import pack
from .queries import tokenizer_path
from .simhash import keep_one_per_group


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.drop_rejected(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_one_per_group(docs, Workspace(spark, "stage4"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), Workspace(spark, "stage6"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, Workspace(spark, "stage9"), tokenizer_path())
