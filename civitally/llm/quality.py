"""Quality rules and robust multivariate outliers, in DataFrame operations only.

Every text becomes a vector of transformed statistics. For each language and source the
centre and scatter of the bulk are estimated by minimum covariance determinant: from a
robust start, concentration steps keep the share ``SUPPORT`` of documents with the
smallest Mahalanobis distances and re-estimate from them, which never raises the
determinant. Documents far from their group's bulk are rejected.

Statistics are kept as whole multiples of 1/``UNIT``, so that sums, and with them every
estimate, do not depend on the order of adding. Distances are counted in ``BINS`` narrow
bins per doubling; the concentration step keeps whole bins, which needs a map-side combined
count per group and bin instead of a sort of a group. A group that holds a third of all
documents is therefore no larger for any task than a small one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import Workspace
from .common import row_key

MIN_WORDS = 50
SUPPORT = 0.6
STEPS = 4
MIN_GROUP = 100
SENT_GROUPS = 10_000  # about a megabyte of estimates
UNIT = 1024
BINS = 64

# Chi-square with four degrees of freedom, median and upper 1e-5 point.
CHI_MEDIAN, CHI_CUT = 3.357, 28.42

#: Name, and the spread below which differences mean nothing (in the transformed scale).
FEATURES = {"x_length": 0.10, "x_symbols": 0.15, "x_lines": 0.20, "x_repeats": 0.20}
_D = len(FEATURES)
_X = list(FEATURES)

BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


def text_statistics(docs: DataFrame) -> DataFrame:
    """The counts of every row of ``docs``, beside its other columns; text is dropped."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, _BLANKS, "")) > 0)
    rows = docs.withColumns({"__w": F.array_remove(F.split(text, BLANK), ""), "__l": lines})
    n = F.size("__w")
    # windows as (hash, place), sorted: equal windows are neighbours
    window = lambda x, i: F.struct(
        F.xxhash64(x, F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("i")
    )
    windows = F.when(n >= 3, F.sort_array(F.transform(F.slice("__w", 1, n - 2), window))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")
    )
    rows = rows.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.translate(text, _BLANKS, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__s": windows,
        }
    )
    same = lambda x, j: F.coalesce(x["h"] == F.get("__s", j)["h"], F.lit(False))
    twice = F.filter("__s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    rows = rows.withColumn("__p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        "__p",
        start,
        lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + F.least(F.lit(3), p + 3 - a["end"])).alias("n")),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", covered).drop("__w", "__l", "__s", "__p", "text")


def _features() -> dict[str, Column]:
    """Transformed statistics as whole multiples of 1/UNIT."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    real = {
        "x_length": F.log(F.greatest(F.col("word_chars") / words, F.lit(1.0))),
        "x_symbols": F.sqrt(F.col("n_symbols") / words),
        "x_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / words),
    }
    return {k: F.round(v * UNIT).cast("long") for k, v in real.items()}


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the factor columns l_i_j."""
    y: list[Column] = []
    for i in range(_D):
        rest = (F.col(_X[i]) - F.col(f"m_{i}")) / UNIT
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * y[j]
        y.append(rest / F.col(f"l_{i}_{i}"))
    return reduce(lambda a, b: a + b, (v * v for v in y))


def _factor(moments: DataFrame) -> DataFrame:
    """Centre m_i and lower Cholesky factor l_i_j from integer moments n, s_i, q_i_j."""
    out = moments.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("n") for i in range(_D)})
    for i in range(_D):
        for j in range(i + 1):
            v = (F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}")) / (UNIT * UNIT)
            if i == j:
                v = v + FEATURES[_X[i]] ** 2
            for k in range(j):
                v = v - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            v = F.sqrt(F.greatest(v, F.lit(1e-12))) if i == j else v / F.col(f"l_{j}_{j}")
            out = out.withColumn(f"l_{i}_{j}", v)
    return out.select("group", *_parameters())


def _parameters() -> list[str]:
    return [f"m_{i}" for i in range(_D)] + [f"l_{i}_{j}" for i in range(_D) for j in range(i + 1)]


def _start(stats: DataFrame) -> DataFrame:
    """Medians and interquartile spreads of each group, as a diagonal factor."""
    found = stats.groupBy("group").agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(f"p_{i}") for i, x in enumerate(_X)]
    )
    columns = {f"m_{i}": F.col(f"p_{i}")[1].cast("double") for i in range(_D)}
    for i in range(_D):
        spread = (F.col(f"p_{i}")[2] - F.col(f"p_{i}")[0]) / (1.349 * UNIT)
        for j in range(i + 1):
            zero = F.lit(0.0)
            columns[f"l_{i}_{j}"] = F.sqrt(spread * spread + FEATURES[_X[i]] ** 2) if i == j else zero
    return found.select("group", *[v.alias(k) for k, v in columns.items()])


def _sent(small: DataFrame) -> DataFrame:
    """A staged table of one row per group, sent to all tasks if it has few rows.

    Otherwise it is joined by Spark's own choice.
    """
    return F.broadcast(small) if small.limit(SENT_GROUPS + 1).count() <= SENT_GROUPS else small


def _binned(stats: DataFrame, parameters: DataFrame) -> DataFrame:
    return stats.join(_sent(parameters), "group").withColumn(
        "bin", F.floor(BINS * F.log2(1 + _distance())).cast("int")
    )


def _bin_at(binned: DataFrame, share: float) -> DataFrame:
    """The first bin of each group up to which the share of its documents lies."""
    counts = binned.groupBy("group", "bin").count()
    w = Window.partitionBy("group")
    upto = F.sum("count").over(w.orderBy("bin"))
    reached = counts.withColumn("upto", upto).withColumn("all", F.sum("count").over(w))
    return reached.where(F.col("upto") >= F.ceil(share * F.col("all"))).groupBy("group").agg(F.min("bin").alias("cut"))


def _concentrate(stats: DataFrame, parameters: DataFrame) -> DataFrame:
    """One concentration step: estimates from the closest share of each group."""
    binned = _binned(stats, parameters)
    kept = binned.join(_bin_at(binned, SUPPORT), "group").where("bin <= cut")
    sums = [F.count("*").alias("n")]
    for i in range(_D):
        sums.append(F.sum(_X[i]).alias(f"s_{i}"))
        sums += [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"q_{i}_{j}") for j in range(i + 1)]
    return _factor(kept.groupBy("group").agg(*sums))


def quality(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Counts, base rules, distance and verdict per row of ``docs``.

    A null text has no words and fails the base rules. Null languages and sources are
    values of their own; groups of fewer than ``MIN_GROUP`` long enough documents are
    pooled, by language and then altogether, and what is left is judged by the base rules
    alone. Repeated rows count each. An empty table gives no rows; columns other than
    doc_id, text, lang and source are ignored.
    """
    rows = text_statistics(docs.select("doc_id", "text", "lang", "source"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumns(_features())
    stats = ws.stage(rows, "stats")
    good = stats.where("not base_failed")

    by_both = good.groupBy("lang", "source").count()
    own = F.col("count") >= MIN_GROUP
    pooled = by_both.withColumn("pool", F.sum(F.when(own, 0).otherwise(F.col("count"))).over(Window.partitionBy("lang")))
    named = pooled.select(
        "lang",
        "source",
        F.when(own, F.to_json(F.struct("lang", "source")))
        .when(F.col("pool") >= MIN_GROUP, F.to_json(F.struct("lang")))
        .otherwise("*")
        .alias("group"),
    )
    groups = ws.stage(named.withColumnRenamed("lang", "g_lang").withColumnRenamed("source", "g_source"), "groups")
    here = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    stats = ws.stage(stats.join(groups, here, "left").drop("g_lang", "g_source"), "grouped")
    good = stats.where("not base_failed")

    parameters = ws.stage(_start(good), "start")
    for step in range(STEPS):
        parameters = ws.stage(_concentrate(good, parameters), f"step-{step}")
    middle = _bin_at(_binned(good, parameters), 0.5).withColumn(
        "scale", F.greatest((F.pow(F.lit(2.0), (F.col("cut") + 1) / BINS) - 1) / CHI_MEDIAN, F.lit(1.0))
    )
    sizes = good.groupBy("group").agg((F.count("*") >= MIN_GROUP).alias("large"))
    judged = ws.stage(
        parameters.join(middle.select("group", "scale"), "group").join(sizes, "group"), "judged"
    )
    distance = _distance() / F.col("scale")
    return stats.join(judged, "group", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(~F.col("large") | (distance <= CHI_CUT), F.lit(True))).alias("kept"),
        distance.alias("distance"),
    )
