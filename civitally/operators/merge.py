"""Upsert rule of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace
from .dedup import same_key, without

# On a key conflict: take the new value when it is known, else keep the old one.
NEW_IF_KNOWN = ["closed_date", "resolution_time_in_hours"]
# On a key conflict: always take the new value.
ALWAYS_NEW = ["status", "is_closed"]


def merge_by_key(old: DataFrame, new: DataFrame, key: str = "unique_key") -> DataFrame:
    """Full outer merge: unmatched rows whole, matched rows column by column.

    Columns outside the two lists keep their stored value, nulls included.
    """
    o = old.withColumn("_stored", F.lit(True)).alias("o")
    n = new.withColumn("_incoming", F.lit(True)).alias("n")
    both = F.col("o._stored") & F.col("n._incoming")
    stored = F.col("o._stored").isNotNull()

    def merged(c: str):
        mine, theirs = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c == key:
            return F.coalesce(mine, theirs)
        if c in NEW_IF_KNOWN:
            return F.coalesce(theirs, mine)
        if c in ALWAYS_NEW:
            return F.when(F.coalesce(both, F.lit(False)) | ~stored, theirs).otherwise(mine)
        return F.when(stored, mine).otherwise(theirs)

    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[merged(c).alias(c) for c in old.columns])


def fold_by_key(rows: DataFrame, order: str, key: str = "unique_key") -> DataFrame:
    """What upserting the rows of a key one after the other would store; ``order`` goes.

    One map-side combined aggregation, so a hot key leaves each task as one row.
    """
    names = [c for c in rows.columns if c not in (key, order)]
    latest = [c for c in ALWAYS_NEW if c in names]
    known = [c for c in NEW_IF_KNOWN if c in names]
    frozen = [c for c in names if c not in latest + known]
    aggregates = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in known]
    if frozen:
        aggregates.append(F.min_by(F.struct(*frozen), order).alias("_first"))
    if latest:
        aggregates.append(F.max_by(F.struct(*latest), order).alias("_last"))
    folded = rows.groupBy(key).agg(*aggregates)
    place = {c: f"_last.{c}" for c in latest} | {c: f"_first.{c}" for c in frozen}
    return folded.select(*[F.col(place.get(c, c)).alias(c) for c in rows.columns if c != order])


#: Beyond this share of rows with repeated keys all rows are folded, rather than met twice.
MOSTLY = 0.25


def fold_repeats(rows: DataFrame, order: str, ws: Workspace, key: str = "unique_key") -> DataFrame:
    """``fold_by_key`` of the staged ``rows``; rows whose key has no other row pass as they are.

    Folding keeps whole rows in its buffers, so it sorts and shuffles them. Keys are counted first,
    in a hash aggregation of the key alone, and as a rule few or none are held twice.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    repeated = ws.stage(counts, "repeated-keys")
    several = repeated.agg(F.sum("_n")).first()[0]
    if not several:
        return rows.drop(order)
    if several > MOSTLY * rows.count():
        return fold_by_key(rows, order, key)
    again = repeated.select(F.col(key).alias(f"_of_{key}"))
    folded = ws.stage(fold_by_key(rows.join(again, same_key([key], "_of_"), "left_semi"), order, key), "refolded")
    return without(rows, repeated, [key]).drop(order).unionByName(folded)
