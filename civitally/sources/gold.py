"""Gold tables on Parquet: four append-only dimensions and a fact by month.

The fact table is laid out as ``facts/created_month=<yyyy-MM>/load_id=<load>``.
A load writes new folders only for the months it touches; which folder of a
month is current stands in a manifest named by its version; the load is published
by appending its version and id to the log of loads as the very last step.
Readers open exactly the current folders, so an unfinished load is never seen
and repeating it is harmless.

Two small tables are kept beside the facts, folder for folder. ``key_filters`` holds a Bloom
filter of a month's keys; with the month's key range in the manifest it tells a load which
stored months its keys may lie in. ``counts`` holds the requests counted by day, place, type
and agency together with their state and hours, from which views are computed without facts.
Hours are so fine that counts by one dimension have nearly as many rows as the facts, and
one table per dimension would be several times their size.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import month_of, ntz
from ..operators.dimensions import DIMENSIONS, Dimension, met_by, new_members, with_ids
from ..operators.key_filter import blocks_for, build_filters, may_hold
from ..operators.keys import resolve_keys
from ..operators.merge import fold_repeats, merge_by_key
from ..operators.metrics import COUNT, HOURS
from ..schemas import FACT, HOURS_TYPE
from ..workspace import Workspace, concurrently, empty_table, local_table


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


LONG, TEXT = T.LongType(), T.StringType()
FOLDER = [("created_month", TEXT), ("load_id", TEXT)]
LOADS = _schema(("version", LONG), ("load_id", TEXT))
MONTH = _schema(("load_id", TEXT), ("keys", LONG), ("low", LONG), ("high", LONG), ("blocks", LONG))
MANIFEST = _schema(("months", T.MapType(TEXT, MONTH)))
STORED_FACT = T.StructType([*FACT.fields, *_schema(*FOLDER)])
FILTERS = _schema(("block", LONG), *[(f"w{i}", LONG) for i in range(8)], *FOLDER)

#: What views count by: the kind of a count, and its columns.
KINDS = {
    "day": ["request_date", "date_id"],
    "location": ["location_id"],
    "complaint_type": ["complaint_type_id"],
    "agency": ["agency_id"],
}
COUNTS = _schema(
    ("request_date", T.DateType()), ("date_id", LONG), ("location_id", LONG), ("complaint_type_id", LONG), ("agency_id", LONG),
    ("is_closed", T.BooleanType()), (HOURS, HOURS_TYPE), (COUNT, LONG), *FOLDER,
)


class BrokenConstraint(ValueError):
    """A load would break a constraint of the fact table; nothing of it was published."""


def _read_or_none(spark: SparkSession, schema: T.StructType, fmt: str, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class Gold:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- dimensions ----

    def dimension(self, dim: Dimension) -> DataFrame:
        found = _read_or_none(self.spark, dim.schema, "parquet", f"{self.root}/{dim.name}")
        return found if found is not None else empty_table(self.spark, dim.schema)

    def dimensions(self) -> dict[str, DataFrame]:
        return {d.name: self.dimension(d) for d in DIMENSIONS}

    def dimensions_of(self, batch: DataFrame, ws: Workspace) -> dict[str, DataFrame]:
        """Insert the members that a batch brings, and return the members that it refers to.

        The batch's members are listed once, for both.
        """

        def one(dim: Dimension) -> DataFrame:
            members = ws.stage(dim.members(batch), f"members-{dim.name}")
            self._append_members(dim, members)
            return met_by(self.dimension(dim), members, dim.key)

        found = concurrently(self.spark, *[partial(one, dim) for dim in DIMENSIONS])
        return {dim.name: df for dim, df in zip(DIMENSIONS, found)}

    def append_new_members(self, dim: Dimension, batch: DataFrame) -> None:
        self._append_members(dim, dim.members(batch))

    def _append_members(self, dim: Dimension, members: DataFrame) -> None:
        stored = self.dimension(dim)
        fresh = new_members(members, stored, dim.key)
        highest = stored.agg(F.max(dim.id_column)).first()[0] or 0
        with_ids(fresh, dim, highest).write.mode("append").parquet(f"{self.root}/{dim.name}")

    # ---- facts ----

    def _loads(self) -> DataFrame:
        found = _read_or_none(self.spark, LOADS, "json", f"{self.root}/loads")
        return found if found is not None else empty_table(self.spark, LOADS)

    def manifest(self) -> tuple[int, dict[str, Row]]:
        """Version and month -> its folder and keys, of the newest manifest (one entry per month)."""
        version = self._loads().agg(F.max("version")).first()[0] or 0
        if not version:
            return 0, {}
        newest = self.spark.read.schema(MANIFEST).json(self._manifest(version))
        return version, dict(newest.first()["months"])

    def current_folders(self) -> tuple[int, dict[str, str]]:
        """Version and month -> load of the newest manifest."""
        version, months = self.manifest()
        return version, {m: state["load_id"] for m, state in months.items()}

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}"

    def _folders(self, table: str, schema: T.StructType, months: dict[str, str]) -> DataFrame:
        """Exactly the folders of these months."""
        if not months:
            return empty_table(self.spark, schema)
        base = f"{self.root}/{table}"
        folders = [f"{base}/created_month={m}/load_id={v}" for m, v in sorted(months.items())]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    def _months(self, months: dict[str, str]) -> DataFrame:
        return self._folders("facts", STORED_FACT, months)

    def facts(self, folders: dict[str, str] | None = None) -> DataFrame:
        """All facts, or those of some months of one manifest."""
        return self._months(self.current_folders()[1] if folders is None else folders).drop("load_id")

    def counted(self, kind: str, folders: dict[str, str] | None = None) -> DataFrame:
        """Requests counted by day, place, type or agency, with their state and hours."""
        folders = self.current_folders()[1] if folders is None else folders
        found = self._folders("counts", COUNTS, folders)
        return found.select(*KINDS[kind], "is_closed", HOURS, COUNT, "created_month")

    def _located(self, keyed: DataFrame, months: dict[str, Row], low: int, high: int, size: int, ws: Workspace) -> DataFrame:
        """``unique_key, created_month`` of the batch's keys that are stored.

        Key ranges first, then the filters of the months in range, and only months whose
        filter holds a key of the batch have their key column read. A batch so large that its keys
        would ask the filters of these months more often than the months have keys meets the
        key columns outright: that costs the stored keys once, not the batch once per month.
        """
        near = {m: s for m, s in months.items() if s["low"] <= high and s["high"] >= low}
        if size * len(near) > sum(s["keys"] for s in near.values()):
            stored = self._months({m: s["load_id"] for m, s in near.items()}).select("unique_key", "created_month")
            return stored.join(keyed.select("unique_key"), "unique_key", "left_semi")
        ranges = local_table(
            self.spark,
            _schema(("created_month", TEXT), ("low", LONG), ("high", LONG), ("blocks", LONG)),
            [list(near), *[[s[c] for s in near.values()] for c in ("low", "high", "blocks")]],
        )  # a row per month, so the range join sends it to every task
        keys = keyed.select("unique_key")
        asked = keys.join(F.broadcast(ranges), F.col("unique_key").between(F.col("low"), F.col("high")))
        filters = self._folders("key_filters", FILTERS, {m: s["load_id"] for m, s in near.items()})
        asked = asked.select("unique_key", "created_month", "blocks")
        maybe = ws.stage(may_hold(asked, "unique_key", filters, "created_month", "blocks"), "maybe")
        open_ = [r[0] for r in maybe.select("created_month").distinct().collect()]  # months
        stored = self._months({m: months[m]["load_id"] for m in open_}).select("unique_key", "created_month")
        return maybe.select("unique_key", "created_month").join(stored, ["unique_key", "created_month"], "left_semi")

    def _home_months(self, keyed: DataFrame, months: dict[str, Row], low: int, high: int, size: int, ws: Workspace) -> list[str]:
        """Months the batch belongs to: the stored month of known keys, else its own.

        A stored request stays in the month it was first seen in.
        """
        own = month_of(F.col("created_date"))
        if not months:
            return [r[0] for r in keyed.select(own).distinct().collect()]
        located = self._located(keyed, months, low, high, size, ws)
        arriving = keyed.select("unique_key", own.alias("own_month")).join(located, "unique_key", "left")
        home = F.coalesce("created_month", "own_month")
        return [r[0] for r in arriving.select(home).distinct().collect()]

    def loaded(self, load_id: str) -> bool:
        return not self._loads().where(F.col("load_id") == load_id).isEmpty()

    def upsert_facts(self, keyed: DataFrame, load_id: str, loaded_at: datetime) -> int:
        """Merge staged fact rows by key and switch the touched months; returns the batch size.

        The constraints of the table are checked on the months as written. If one is broken the
        load is not published, and the version before stays current.
        """
        broken = F.col("unique_key").isNull() | F.col("created_date").isNull()
        size = keyed.agg(
            F.count("*").alias("n"),
            F.count_if(broken).alias("bad"),
            F.min("unique_key").alias("low"),
            F.max("unique_key").alias("high"),
        ).first()
        if size["bad"]:
            raise ValueError(f"{size['bad']} rows lack unique_key or created_date")
        if size["n"] == 0:
            return 0
        version, months = self.manifest()
        with Workspace(self.spark, "locate") as ws:
            homes = self._home_months(keyed, months, size["low"], size["high"], size["n"], ws)
        batch = keyed.withColumn("created_at", ntz(loaded_at)).select(*[f.name for f in FACT])
        old_months = {m: months[m]["load_id"] for m in homes if m in months}
        if old_months:
            old = self._months(old_months).select(*[f.name for f in FACT])
            batch = merge_by_key(old, batch)
        out = batch.withColumns(
            {"created_month": month_of(F.col("created_date")), "load_id": F.lit(load_id)}
        )
        seen = Observation()
        # AQE sizes the files: large months are split, small ones share a task. Within a
        # file rows lie by creation time, so row groups answer time windows.
        laid = out.hint("rebalance", F.col("created_month")).sortWithinPartitions(
            "created_month", "load_id", "created_date"
        )
        mandatory = ["unique_key", "created_date", "is_closed"]
        laid = laid.observe(seen, *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in mandatory])
        self._write(laid, "facts", "created_month", "load_id")
        written = {m: load_id for m in homes}
        states, dangling = concurrently(
            self.spark, partial(self._write_filters, written), partial(self._write_counts, written)
        )
        repeated = {"duplicate_keys": sum(s.pop("repeated") for s in states.values())}
        problems = {name: n for name, n in (seen.get | repeated | dangling).items() if n}
        if problems:
            raise BrokenConstraint(f"load {load_id} breaks the fact table: {problems}")
        self._publish(version + 1, load_id, months | {m: Row(**{c: s[c] for c in MONTH.names}) for m, s in states.items()})
        return size["n"]

    def _write(self, rows: DataFrame, table: str, *folders: str) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(f"{self.root}/{table}")
        )

    def _write_filters(self, written: dict[str, str]) -> dict[str, dict]:
        """Filters of the months as written; returns the months' manifest entries.

        Keys are counted too (``repeated``: how many rows of keys held before). Only the key column is read.
        """
        keys = self._months(written).groupBy("created_month", "load_id", "unique_key").agg(F.count("*").alias("n"))
        per_month = keys.groupBy("created_month", "load_id").agg(
            F.count("*").alias("keys"),
            F.min("unique_key").alias("low"),
            F.max("unique_key").alias("high"),
            (F.sum("n") - F.count("*")).alias("repeated"),
        )
        states = {r["created_month"]: r.asDict() for r in per_month.collect()}  # a row per month
        for state in states.values():
            state["blocks"] = blocks_for(state["keys"])
            del state["created_month"]
        sizes = local_table(
            self.spark,
            _schema(("created_month", TEXT), ("blocks", LONG)),
            [list(states), [s["blocks"] for s in states.values()]],
        )
        groups = ["created_month", "load_id"]
        sized = self._months(written).select(*groups, "unique_key").join(F.broadcast(sizes), "created_month")
        built = build_filters(sized, "unique_key", groups, "blocks")
        self._write(built.hint("rebalance", F.col("created_month")), "key_filters", *groups)
        return states

    def _write_counts(self, written: dict[str, str]) -> dict[str, int]:
        """Counts of the months as written, in one scan; returns the rows whose ids point nowhere."""
        facts = self._months(written).withColumn("request_date", F.to_date("created_date"))
        groups = ["created_month", "load_id"]
        by = [c for columns in KINDS.values() for c in columns]
        counts = facts.groupBy(*groups, *by, "is_closed", HOURS).agg(F.count("*").alias(COUNT))
        self._write(counts.hint("rebalance", "created_month"), "counts", *groups)
        return self._dangling(self._folders("counts", COUNTS, written))

    def _dangling(self, counts: DataFrame) -> dict[str, int]:
        """Counted requests with an id that its dimension lacks; null ids are none."""
        found = {}
        for dim in DIMENSIONS:
            ids = self.dimension(dim).select(dim.id_column)
            used = counts.where(F.col(dim.id_column).isNotNull()).groupBy(dim.id_column).agg(F.sum(COUNT).alias("n"))
            lost = used.join(ids, dim.id_column, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)))
            found[f"dangling_{dim.id_column}"] = lost
        one = reduce(DataFrame.union, [df.select(F.lit(k).alias("k"), "*") for k, df in found.items()])
        return {r[0]: r[1] for r in one.collect()}  # a row per dimension

    def _publish(self, version: int, load_id: str, months: dict[str, Row]) -> None:
        manifest = self.spark.createDataFrame([(months,)], MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").json(self._manifest(version))
        load = self.spark.createDataFrame([(version, load_id)], LOADS).coalesce(1)
        load.write.mode("append").json(f"{self.root}/loads")


def upsert(
    gold: Gold,
    silver: DataFrame,
    ws: Workspace,
    load_id: str,
    loaded_at: datetime,
    order: str | None = None,
) -> int:
    """Fold rows of one key, then dimensions, keys, facts; returns the rows loaded.

    Rows of a key are folded as if each were upserted in turn, by the column ``order`` or
    else as they come. A load already published is skipped.
    """
    if gold.loaded(load_id):
        return 0
    if order is None:
        order = "_order"
        silver = silver.withColumn(order, F.monotonically_increasing_id())
    silver = fold_repeats(ws.stage(silver, "arrived"), order, ws)
    keyed = ws.stage(resolve_keys(silver, gold.dimensions_of(silver, ws)), "keyed")
    return gold.upsert_facts(keyed, load_id, loaded_at)
