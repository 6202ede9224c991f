"""From raw documents to packed training sequences, in stages that are written and reread."""

from __future__ import annotations

from civitally.llm import stages
from civitally.workspace import Workspace

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("benchmark", stages.benchmark),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]

#: Several stages (learned models, 64-bit fingerprints, token ids) cannot be put in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages in order to the documents below ``sf_dir``."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
    return docs
