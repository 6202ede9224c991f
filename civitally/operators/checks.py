"""Table constraints as data checks, and result contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CONTRACTS
from .dimensions import DIMENSIONS


def key_violations(facts: DataFrame, label: str) -> DataFrame:
    """One row: null keys, keys held by more than one row, null mandatory columns."""
    per_key = facts.groupBy("unique_key").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("created_date").isNull()).alias("no_created"),
        F.count_if(F.col("is_closed").isNull()).alias("no_flag"),
    )
    known = F.col("unique_key").isNotNull()
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), zero).alias("null_keys"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum("no_created"), zero).alias("null_created_date"),
        F.coalesce(F.sum("no_flag"), zero).alias("null_is_closed"),
    ).select(F.lit(label).alias("table_name"), "*")


def fk_violations(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key: rows pointing nowhere, and rows without a reference."""

    def one(dim) -> DataFrame:
        fk = dim.id_column
        # one row per id before the join, so a popular id is joined once
        used = facts.groupBy(fk).agg(F.count("*").alias("n"))
        ids = dims[dim.name].select(F.col(fk).alias("_id"))
        zero = F.lit(0).cast("bigint")
        dangling = F.col(fk).isNotNull() & F.col("_id").isNull()
        return (
            used.join(ids, F.col(fk) == F.col("_id"), "left")
            .agg(
                F.coalesce(F.sum(F.when(dangling, F.col("n"))), zero).alias("dangling_rows"),
                F.coalesce(F.sum(F.when(F.col(fk).isNull(), F.col("n"))), zero).alias("null_rows"),
            )
            .select(F.lit(fk).alias("foreign_key"), "dangling_rows", "null_rows")
        )

    return reduce(DataFrame.unionByName, [one(d) for d in DIMENSIONS])


def dim_key_violations(dims: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: members, natural keys used twice, ids used twice."""

    def one(dim) -> DataFrame:
        df = dims[dim.name]

        def repeated(cols: list[str]) -> DataFrame:
            return df.groupBy(*cols).agg(F.count("*").alias("n"))

        natural = repeated(dim.key).agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("members"),
            F.count_if(F.col("n") > 1).alias("duplicate_natural_keys"),
        )
        ids = repeated([dim.id_column]).agg(F.count_if(F.col("n") > 1).alias("duplicate_ids"))
        return natural.crossJoin(ids).select(F.lit(dim.name).alias("table_name"), "*")

    return reduce(DataFrame.unionByName, [one(d) for d in DIMENSIONS])


def contract_problems(name: str, df: DataFrame) -> list[str]:
    """Differences between a result's schema and its published contract."""
    wanted = [(f.name, f.dataType.simpleString()) for f in CONTRACTS[name]["schema"]]
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return [f"expected {w}, found {a}" for w, a in zip(wanted, actual) if w != a] + (
        [] if len(wanted) == len(actual) else [f"{len(actual)} columns, expected {len(wanted)}"]
    )


def contract_nulls(name: str, df: DataFrame) -> DataFrame:
    """Rows that break the contract's not-null columns."""
    broken = [F.col(c).isNull() for c in CONTRACTS[name]["required"]]
    return df.where(reduce(lambda a, b: a | b, broken))
