"""Fill zip, categories, council district and coordinates from related rows.

Each fill may use values filled by the one before it. Chaining row-level self
joins would double the plan at every step, so the chain runs on summaries (one
row per distinct combination, with the first row order and a count) and the
wide rows are then touched once, by joins with small lookup tables.

Fills within pages have as many lookups as pages, which are no small tables: there the
rows of a page are brought together once, and windows inside of that give every fill.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import UNKNOWN
from ..workspace import Workspace, concurrently
from .fill import all_present

ZIP_FLAG = "_incident_zip_imputed"

#: Tasks that may share the rows of one key of a summary.
SALTS = 8

PLACE = [
    "latitude",
    "longitude",
    "borough",
    "incident_zip",
    "community_board",
    "council_district",
]

# column: (first group, second group)
CATEGORICAL = {
    "address_type": ("complaint_type", "agency"),
    "city": ("borough", None),
    "location_type": ("complaint_type", "descriptor"),
}


def _first_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return (
        df.where(all_present([*keys, value]))
        .groupBy(*keys)
        .agg(F.min_by(value, "first_row").alias(name))
    )


# ---- places: zip, district and centroids ------------------------------------


def _first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``keys, first_row, n``: the least ``order`` of each combination of keys, and its rows.

    An order of several fields ends on a number. That is combined first, under the few values of
    the fields before it, since only numbers are kept in a hash aggregation: the least structure
    outright would sort all rows before combining any.
    """
    kind = df.schema[order].dataType
    if not isinstance(kind, T.StructType):
        return df.groupBy(*keys).agg(F.min(order).alias("first_row"), F.count("*").alias("n"))
    *outer, number = [f"{order}.{name}" for name in kind.names]
    fields = {f"_part{i}": F.col(c) for i, c in enumerate(outer)}
    nulls = {"_known": F.col(order).isNotNull(), "_blank": F.col(number).isNull()}  # a null is less than any number
    fine = df.withColumns(fields | nulls | {"_number": F.col(number)})
    fine = fine.groupBy(*keys, *fields, *nulls).agg(F.min("_number").alias("_number"), F.count("*").alias("n"))
    whole = F.struct(*[F.col(c).alias(name) for c, name in zip([*fields, "_number"], kind.names)])
    return fine.groupBy(*keys).agg(F.min(F.when(F.col("_known"), whole)).alias("first_row"), F.sum("n").alias("n"))


def place_summary(df: DataFrame, order: str, scope: list[str]) -> DataFrame:
    return _first_rows(df, [*scope, *PLACE], order)


def places_with_point_zip(places: DataFrame, scope: list[str]) -> DataFrame:
    """Zip filled from the exact coordinates, as ``zip1``.

    A window over the summary rather than a self join: the wide rows are read once.
    """
    same_point = Window.partitionBy(*scope, "latitude", "longitude")
    known = F.when(F.col("incident_zip").isNotNull(), F.col("first_row"))
    given = F.when(
        all_present(["latitude", "longitude"]), F.min_by("incident_zip", known).over(same_point)
    )
    return places.withColumn("zip1", F.coalesce("incident_zip", given))


def point_zip_lookup(places: DataFrame, scope: list[str]) -> DataFrame:
    """Coordinates that give a zip to rows lacking one."""
    found = F.col("incident_zip").isNull() & F.col("zip1").isNotNull()
    return (
        places.where(found)
        .select(*scope, "latitude", "longitude", F.col("zip1").alias("_point_zip"))
        .distinct()
    )


def borough_zip_lookup(places: DataFrame, scope: list[str]) -> DataFrame:
    return _first_value(places, [*scope, "borough"], "zip1", "_borough_zip")


def places_with_final_zip(places: DataFrame, by_borough: DataFrame, scope: list[str]) -> DataFrame:
    """``zip2``, from the staged lookup, so that its size decides how it is joined."""
    spread = F.xxhash64("latitude", "longitude", "incident_zip", "community_board")
    return spread_left_join(places, by_borough, [*scope, "borough"], spread).withColumn(
        "zip2", F.coalesce("zip1", "_borough_zip")
    ).drop("_borough_zip")


def spread_left_join(rows: DataFrame, lookup: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """Left join with a small staged lookup; a key that very many rows share goes to ``SALTS`` tasks.

    The lookup is repeated per salt. Where its written size allows a broadcast that costs nothing,
    beyond that no task gets all rows of a hot key.
    """
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return salted.join(lookup.select("*", salts), [*keys, "_salt"], "left").drop("_salt")


def district_by_zip(places2: DataFrame, scope: list[str]) -> DataFrame:
    return _first_value(places2, [*scope, "zip2"], "council_district", "_zip_district")


def district_by_board(places2: DataFrame, by_zip: DataFrame, scope: list[str]) -> DataFrame:
    """District by community board over zip-filled districts; ``by_zip`` is a staged lookup."""
    spread = F.xxhash64("latitude", "longitude", "community_board")
    filled = spread_left_join(places2, by_zip, [*scope, "zip2"], spread).withColumn(
        "district1", F.coalesce("council_district", "_zip_district")
    )
    return _first_value(filled, [*scope, "community_board"], "district1", "_board_district")


def centroids(places2: DataFrame, scope: list[str], key: str) -> DataFrame:
    """Mean coordinates per group, over rows that have both."""
    group = [*scope, key]
    n = F.col("n")
    return (
        places2.where(all_present([*group, "latitude", "longitude"]))
        .groupBy(*group)
        .agg(
            (F.sum(F.col("latitude") * n) / F.sum(n)).alias("lat"),
            (F.sum(F.col("longitude") * n) / F.sum(n)).alias("lon"),
        )
    )


# ---- categories --------------------------------------------------------------


def category_summary(df: DataFrame, order: str, scope: list[str]) -> DataFrame:
    """(field, k1, k2, value) with the first row order, for all three fields."""

    def one(field: str, k1: str, k2: str | None) -> Column:
        second = F.col(k2) if k2 else F.lit(None).cast("string")
        return F.struct(
            F.lit(field).alias("field"), F.col(k1).alias("k1"), second.alias("k2"), F.col(field).alias("value")
        )

    fields = F.inline(F.array(*[one(f, *ks) for f, ks in CATEGORICAL.items()]))  # one scan for all three
    keys = [*scope, "field", "k1", "k2", "value"]
    return _first_rows(df.select(*scope, F.col(order).alias("_at"), fields), keys, "_at").drop("n")


def category_lookups(summary: DataFrame, ws: Workspace, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """First-step and second-step fills; the second sees what the first filled."""
    group1 = [*scope, "field", "k1"]
    step1 = ws.stage(_first_value(summary, group1, "value", "fill1"), "category-fills")
    spread = F.xxhash64("k2", "value")
    filled = spread_left_join(summary, step1, group1, spread).withColumn("value1", F.coalesce("value", "fill1"))
    step2 = _first_value(filled, [*scope, "field", "k2"], "value1", "fill2")
    return step1, step2


# ---- all small lookups as one table --------------------------------------------

# Columns of the lookup table; a row holds what one value of one key column gives.
VALUES = {
    "zip": "string",
    "address_type": "string",
    "city": "string",
    "location_type": "string",
    "district": "string",
    "lat": "double",
    "lon": "double",
}


def _gives(df: DataFrame, scope: list[str], key_column, key: str, **values: str | Column) -> DataFrame:
    """Lookup rows: which column is matched, by what text, and the values it gives."""
    wide = {
        v: (F.col(values[v]) if isinstance(values.get(v), str) else values.get(v, F.lit(None)))
        for v in VALUES
    }
    return df.select(
        *scope,
        (F.lit(key_column) if isinstance(key_column, str) else key_column).alias("key_column"),
        F.col(key).cast("string").alias("key"),
        *[c.cast(VALUES[v]).alias(v) for v, c in wide.items()],
    )


def _place_fills(places: DataFrame, ws: Workspace, scope: list[str]) -> list[DataFrame]:
    by_borough = ws.stage(borough_zip_lookup(places, scope), "borough-zips")
    places2 = ws.stage(places_with_final_zip(places, by_borough, scope), "places-final")
    by_zip = ws.stage(district_by_zip(places2, scope), "zip-districts")
    by_board = district_by_board(places2, by_zip, scope)
    zips = centroids(places2, scope, "zip2")
    boards = centroids(places2, scope, "community_board")
    return [
        _gives(by_borough, scope, "borough", "borough", zip="_borough_zip"),
        _gives(by_zip, scope, "incident_zip", "zip2", district="_zip_district"),
        _gives(by_board, scope, "community_board", "community_board", district="_board_district"),
        _gives(zips, scope, "incident_zip", "zip2", lat="lat", lon="lon"),
        _gives(boards, scope, "community_board", "community_board", lat="lat", lon="lon"),
    ]


def _category_fills(summary: DataFrame, ws: Workspace, scope: list[str]) -> list[DataFrame]:
    def rows(lookup: DataFrame, step: int, key: str, value: str) -> DataFrame:
        column = F.coalesce(
            *[F.when(F.col("field") == f, F.lit(ks[step])) for f, ks in CATEGORICAL.items()]
        )
        gives = {f: F.when(F.col("field") == f, F.col(value)) for f in CATEGORICAL}
        return _gives(lookup, scope, column, key, **gives)

    step1, step2 = category_lookups(summary, ws, scope)
    return [rows(step1, 0, "k1", "fill1"), rows(step2, 1, "k2", "fill2")]


def prepare_fills(
    df: DataFrame, ws: Workspace, order: str, scope: list[str], places: bool, categories: bool
) -> tuple[DataFrame | None, DataFrame]:
    """Stage the summaries, then one table with every small lookup.

    Reading the lookups back from Parquet gives Catalyst their real size, which
    is what decides between a broadcast and a shuffled join.
    """
    parts: list[DataFrame] = []
    summaries = {}
    if places:
        summaries["places"] = places_with_point_zip(place_summary(df, order, scope), scope)
    if categories:
        summaries["categories"] = category_summary(df, order, scope)
    staged = dict(
        zip(summaries, concurrently(ws.spark, *[partial(ws.stage, s, n) for n, s in summaries.items()]))
    )
    if places:
        parts += _place_fills(staged["places"], ws, scope)
    if categories:
        parts += _category_fills(staged["categories"], ws, scope)
    # at most one row gives each value, so max() merely merges rows of one key
    merged = (
        reduce(DataFrame.unionByName, parts)
        .groupBy(*scope, "key_column", "key")
        .agg(*[F.max(v).alias(v) for v in VALUES])
    )
    return staged.get("places"), ws.stage(merged, "fills")


# ---- the pass over the wide rows -------------------------------------------------


def _attach(
    df: DataFrame, fills: DataFrame, scope: list[str], column: str, values: list[str]
) -> DataFrame:
    """Left join what ``column`` gives, as ``_<column>_<value>``; null keys never match."""
    lookup = fills.where(F.col("key_column") == column).select(
        *[F.col(s).alias(f"_scope{i}") for i, s in enumerate(scope)],
        F.col("key").alias("_key"),
        *[F.col(v).alias(f"_{column}_{v}") for v in values],
    )
    on = [F.col(s).eqNullSafe(F.col(f"_scope{i}")) for i, s in enumerate(scope)]
    on.append(F.col(column).cast("string") == F.col("_key"))
    joined = df.join(lookup, reduce(lambda a, b: a & b, on), "left")
    return joined.drop("_key", *[f"_scope{i}" for i in range(len(scope))])


def _with_point_zip(df: DataFrame, lookup: DataFrame, scope: list[str]) -> DataFrame:
    """Zip by exact coordinates, for rows that lack one.

    Other rows ask with null coordinates, which match nothing. A left join may split the
    rows that share the null, so they do not gather where the lookup is too large to send.
    """
    need = F.col("incident_zip").isNull() & all_present(["latitude", "longitude"])
    asked = {f"_ask_{c}": F.when(need, F.col(c)) for c in ("latitude", "longitude")}
    known = lookup.select(
        *[F.col(s).alias(f"_scope{i}") for i, s in enumerate(scope)],
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), "_point_zip",
    )
    on = [F.col(s).eqNullSafe(F.col(f"_scope{i}")) for i, s in enumerate(scope)]
    on += [F.col("_ask_latitude") == F.col("_lat"), F.col("_ask_longitude") == F.col("_lon")]
    filled = df.withColumns(asked).join(known, reduce(lambda a, b: a & b, on), "left")
    filled = filled.withColumns(
        {ZIP_FLAG: F.col("_point_zip").isNotNull(), "incident_zip": F.coalesce("incident_zip", "_point_zip")}
    )
    return filled.select(*df.columns, ZIP_FLAG)


# ---- fills within a scope ----------------------------------------------------------


def _first_in(group: list[str], value: str, order: str) -> Column:
    """The first known ``value`` of the row's group, in row order; none if a group column is null."""
    known = F.when(F.col(value).isNotNull(), F.col(order))
    return F.when(all_present(group), F.min_by(value, known).over(Window.partitionBy(*group)))


def _impute_within(df: DataFrame, order: str, scope: list[str], by_place: bool, by_category: bool, fills: tuple[str, ...]) -> DataFrame:
    """``impute`` for a scope: what the lookups would give, by windows.

    The rows are shuffled once, by their scope; the windows below cluster by the scope and a
    column, which that shuffle already does, so each costs a sort within the task. Nothing is
    sent to the driver however many scopes there are, and no summary is written.
    """
    columns = df.columns
    df = df.repartition(*scope)
    with_point = F.when(all_present(["latitude", "longitude"]), F.lit(True))
    steps: list[dict[str, Column]] = []  # the windows of a step share their groups, so each sorts once
    if by_place:
        point = Window.partitionBy(*scope, "latitude", "longitude")
        known = F.when(F.col("incident_zip").isNotNull(), F.col(order))
        at_point = F.when(with_point, F.min_by("incident_zip", known).over(point))
        steps.append({"_zip1": F.coalesce("incident_zip", at_point)})
    in_borough: dict[str, Column] = {}
    if by_place:
        in_borough["_zip2"] = F.coalesce("_zip1", _first_in([*scope, "borough"], "_zip1", order))
    if by_category:
        in_borough |= {
            f"_{field}1": F.coalesce(field, _first_in([*scope, first], field, order))
            for field, (first, _) in CATEGORICAL.items()
        }
    steps.append(in_borough)
    if by_category:
        steps.append(
            {
                f"_{field}2": F.coalesce(f"_{field}1", _first_in([*scope, second], f"_{field}1", order))
                for field, (_, second) in CATEGORICAL.items()
                if second
            }
        )
    found = {axis: axis for axis in ("latitude", "longitude")} | {"district": "council_district"}
    for number, key in enumerate(("_zip2", "community_board")):
        group, step = [*scope, key], {}
        if "district" in fills:
            step[f"_district{number}"] = F.coalesce(found["district"], _first_in(group, found["district"], order))
        if "coordinates" in fills:
            for axis in ("latitude", "longitude"):
                mean = F.avg(F.when(with_point, F.col(axis))).over(Window.partitionBy(*group))
                step[f"_{axis}{number}"] = F.coalesce(found[axis], F.when(all_present(group), mean))
        if step:
            steps.append(step)
            found |= {name[1:-1]: name for name in step}
    for step in steps:
        df = df.withColumns(step)
    result: dict[str, Column] = {}
    if by_place:
        result[ZIP_FLAG] = F.col("incident_zip").isNull() & F.col("_zip2").isNotNull()
        result["incident_zip"] = F.coalesce("incident_zip", F.col("_zip2").cast("bigint"))
    if "district" in fills:
        result["council_district"] = F.coalesce("council_district", F.col(found["district"]).cast("bigint"))
    if "coordinates" in fills:
        result |= {axis: F.col(found[axis]) for axis in ("latitude", "longitude")}
    if by_category:
        last = {field: f"_{field}2" if second else f"_{field}1" for field, (_, second) in CATEGORICAL.items()}
        result |= {field: F.coalesce(c, F.lit(UNKNOWN)) for field, c in last.items()}
    flag = [ZIP_FLAG] if by_place else []
    return df.withColumns(result).select(*columns, *flag)


ALL_FILLS = ("zip", "categories", "district", "coordinates")


def impute(
    df: DataFrame,
    ws: Workspace,
    order: str = "row_order",
    scope: tuple[str, ...] = (),
    fills: tuple[str, ...] = ALL_FILLS,
) -> DataFrame:
    """Fill zip, categories, district and coordinates, in that order.

    Each key column is joined once and gives everything it can: the borough a zip
    and a city, the zip a district and a centroid, and so on. With a scope the rows of one
    scope are brought together instead.
    """
    by_place = any(f in fills for f in ("zip", "district", "coordinates"))
    by_category = "categories" in fills
    scope = list(scope)
    if scope:
        return _impute_within(df, order, scope, by_place, by_category, fills)
    places, lookups = prepare_fills(df, ws, order, scope, by_place, by_category)

    def wanted(**values: str) -> list[str]:
        return [v for v, part in values.items() if part in fills]

    if by_place:
        df = _with_point_zip(df, point_zip_lookup(places, scope), scope)
    df = _attach(
        df, lookups, scope, "borough",
        (["zip"] if by_place else []) + (["city"] if by_category else []),
    )
    if by_place:
        by_borough = F.col("incident_zip").isNull() & F.col("_borough_zip").isNotNull()
        df = df.withColumns(
            {
                ZIP_FLAG: F.col(ZIP_FLAG) | by_borough,
                "incident_zip": F.coalesce("incident_zip", F.col("_borough_zip").cast("bigint")),
            }
        )
    by_location = wanted(district="district", lat="coordinates", lon="coordinates")
    if by_location:
        df = _attach(df, lookups, scope, "incident_zip", by_location)
        df = _attach(df, lookups, scope, "community_board", by_location)
    result: dict[str, Column] = {}
    if "district" in by_location:
        given = [F.col(f"_{k}_district").cast("bigint") for k in ("incident_zip", "community_board")]
        result["council_district"] = F.coalesce("council_district", *given)
    if "lat" in by_location:  # each axis on its own
        for axis, short in (("latitude", "lat"), ("longitude", "lon")):
            result[axis] = F.coalesce(axis, f"_incident_zip_{short}", f"_community_board_{short}")
    if by_category:
        for column in ("complaint_type", "agency", "descriptor"):
            gives = [f for f, keys in CATEGORICAL.items() if column in keys]
            df = _attach(df, lookups, scope, column, gives)
        for field, keys in CATEGORICAL.items():
            given = [F.col(f"_{k}_{field}") for k in keys if k]
            result[field] = F.coalesce(field, *given, F.lit(UNKNOWN))
    temporary = [c for c in df.columns if c.startswith("_") and c != ZIP_FLAG]
    return df.withColumns(result).drop(*temporary)
