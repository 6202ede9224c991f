"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import Workspace
from . import langid, lexical, passages, pii, pivots, quality, runs, secrets, suffixes, wrappers
from .common import table
from .decontaminate import decontaminate
from .oracles import ORACLES as ORACLES
from .packing import pack
from .simhash import simhash_groups

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """Place of the public vocabulary that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"), Workspace(spark, "op1"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), Workspace(spark, "op4"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), Workspace(spark, "op5"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark, "op6")
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"), Workspace(spark, "op8"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Workspace(spark, "op9"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), Workspace(spark, "op10"))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.ranked(docs, items, Workspace(spark, "op11"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return pivots.nearest(vectors, F.col("vec_id") % 50 == 0, 5, Workspace(spark, "op12"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs of every text; of a tenth of the texts the tails repeat (see there)."""
    found = runs.periodic_runs(runs.with_repeated_tails(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", runs.strongest())
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_passages,
        op2_pii,
        op3_secrets,
        op4_simhash,
        op5_suffixes,
        op6_decontaminate,
        op7_language,
        op8_extraction,
        op9_packing,
        op10_quality,
        op11_ranked,
        op12_nearest,
        op13_runs,
    )
}
