"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

Everything here is a DataFrame expression. Patterns are found with ``split`` (what lies
between matches) and ``regexp_extract_all`` (the matches), whose lengths give positions.
Base spans are fixed formats with fixed checks. Further generators propose spans of
formats that need judgement; they may overlap each other and the base spans.

Every candidate is described by a few coarse format and context features, packed into one
number, its cell. Candidates whose structure can be checked (digit checksums, number
ranges, number plans) give weak labels, but no feature looks at that check. The corpus is
thereby summed into a table of cells with label counts, bounded by the number of cells
whatever the corpus. Gradient-boosted trees (MLlib) are fitted to it, the threshold is
calibrated on documents of a kept-back fold, and the cells that pass form a short list
against which candidates are filtered in place, without a join.

Patterns are possessive and anchored at the start of a run, so that a long run of word or
digit characters is read once; ``\\G`` lets a match start where the last one ended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole_rows

# Base formats, in the order of kinds.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9]){11,}+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: A cheap test that a text can hold the kind at all.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

#: Formats that need judgement, in the order of kinds after the base ones.
EXTRA = {
    "email_masked": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++\\x20?+(?:\\[at\\]|\\(at\\)|\\{{at\\}})\\x20?+[A-Za-z0-9-]++"
    "(?:(?:\\x20?+(?:\\[dot\\]|\\(dot\\)|\\{dot\\})\\x20?+|\\.)[A-Za-z0-9-]++)++",
    "phone_local": "(?<![0-9+.-])\\(?+[0-9]{3}\\)?+[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9])",
    "national_id": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){3,7}+(?:\\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
}
KINDS = [*BASE, *EXTRA]
N_BASE = len(BASE)

#: Words that announce personal data, looked for just before a candidate.
CONTEXT = "(?i)(mail|contact|write|reach|tel|phone|call|mobile|fax|card|visa|credit|pay|ssn|social|iban|account|ip|host|from)"
CONTEXT_CHARS = 24

# Features and their numbers of levels; a cell is their mixed-radix number.
LEVELS = {"digits": 4, "letters": 3, "marks": 4, "length": 4, "context": 2, "before": 3, "after": 3}
CELLS = reduce(lambda a, b: a * b, LEVELS.values())

TREES, DEPTH = 12, 3
CHECK_FOLDS = 5
PRECISION = 0.95

_SPAN = "array<struct<start:int,kind:int,end:int,valid:boolean,cell:int>>"


# ---- spans of one text ---------------------------------------------------------------


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.split(F.reverse(_digits(m)), "")
    d = F.filter(d, lambda x: x != "")

    def value(x: Column, i: Column) -> Column:
        v = x.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(d, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    """The structural check of a kind."""
    n = F.length(_digits(m))
    if kind == "ip":
        return F.forall(F.split(m, "\\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        return n.between(12, 19) & _luhn(m)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "email_masked":
        return m.rlike("[A-Za-z]{2,}$")
    if kind == "phone_local":
        return _digits(m).rlike("^[2-9][0-9]{2}[2-9]")
    if kind == "national_id":
        return ~m.rlike("^(000|666|9)|-00-|-0000$")
    if kind == "iban":
        compact = F.translate(m, " ", "")
        turned = F.split(F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4)), "")
        value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        step = lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
        return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1
    return F.lit(True)


def _level(value: Column, *cuts: int) -> Column:
    return reduce(lambda a, c: a + (value >= c).cast("int"), cuts, F.lit(0))


def _cell(m: Column, before: Column, after: Column) -> Column:
    """Format features of the match and context features of what stands around it."""
    side = lambda c: F.when(c.rlike("^[A-Za-z0-9]$"), 2).when(c.rlike("^[\\s(:]?$"), 0).otherwise(1)
    digits, size = F.length(_digits(m)), F.length(m)
    letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    marks = size - digits - letters
    values = [
        _level(digits, 8, 11, 15),
        _level(letters, 1, 6),
        _level(marks, 1, 3, 5),
        _level(size, 12, 16, 20),
        before.rlike(CONTEXT).cast("int"),
        side(F.right(before, F.lit(1))),
        side(F.substring(after, 1, 1)),
    ]
    out = F.lit(0)
    for v, n in zip(values, LEVELS.values()):
        out = out * n + v
    return out.cast("int")


def _pattern_spans(text: str, kind: str, pattern: str) -> Column:
    """All matches of a pattern as spans; null where the text cannot hold one."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    number = KINDS.index(kind)
    pairs = F.arrays_zip(gaps.alias("g"), found.alias("m"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("a"))
    # names given by arrays_zip to expressions differ, so they are set by a cast
    pairs = pairs.cast("array<struct<g:string,m:string,a:string>>")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(
            start.cast("int").alias("start"),
            F.lit(number).alias("kind"),
            end.cast("int").alias("end"),
            _valid(kind, x["m"]).alias("valid"),
            _cell(x["m"], F.right(x["g"], F.lit(CONTEXT_CHARS)), x["a"]).alias("cell"),
        )
        out = F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span)))
        return F.struct(end.cast("int").alias("at"), out.cast(_SPAN).alias("out"))

    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__spans``: all spans of all generators, checked and described."""
    none = F.array().cast(_SPAN)
    text = "__text"
    docs = docs.withColumn(text, F.coalesce("text", F.lit("")))
    digit = F.col(text).rlike("[0-9]")
    parts = []
    for kind, pattern in {**BASE, **EXTRA}.items():
        needed = digit & F.col(text).rlike(pattern) if kind not in ("email", "email_masked") else F.col(text).rlike(pattern)
        if need := _NEEDS.get(kind):
            needed = F.contains(F.col(text), F.lit(need)) & needed
        if kind == "email_masked":
            needed = F.col(text).rlike("[\\[({](?:at)[\\])}]") & needed
        parts.append(F.when(needed, _pattern_spans(text, kind, pattern)).otherwise(none))
    return docs.withColumn("__spans", F.concat(*parts)).drop(text)


# ---- learning ----------------------------------------------------------------------


def _cells(spans: DataFrame) -> DataFrame:
    """Label counts of every cell, by whether the document is kept back."""
    one = spans.select("__check", F.explode("__spans").alias("s"))
    kinds = [i for i, k in enumerate(KINDS) if k != "email"]  # its format is its check
    return (
        one.where(F.col("s.kind").isin(kinds))
        .groupBy("__check", F.col("s.cell").alias("cell"))
        .agg(
            F.sum(F.col("s.valid").cast("long")).alias("yes"),
            F.sum((~F.col("s.valid")).cast("long")).alias("no"),
        )
    )


def _with_features(cells: DataFrame) -> DataFrame:
    rest, columns = F.col("cell"), {}
    for name, n in reversed(LEVELS.items()):
        columns[name] = (rest % n).cast("double")
        rest = F.floor(rest / n)
    return cells.withColumns(columns)


def accepted_cells(docs: DataFrame) -> list[int]:
    """Cells whose candidates are taken, learned from all rows of ``docs``.

    At most ``CELLS`` numbers reach the driver. Without both labels nothing is learned
    and nothing beyond the base spans is taken.
    """
    check = F.pmod(F.xxhash64("doc_id"), F.lit(CHECK_FOLDS)) == 0
    rows = candidates(docs.select("text", F.coalesce(check, F.lit(False)).alias("__check")))
    counted = _cells(rows.where(F.size("__spans") > 0)).collect()
    spark = docs.sparkSession
    learn = [(r["cell"], y, float(n)) for r in counted if not r["__check"] for y, n in ((1.0, r["yes"]), (0.0, r["no"])) if n]
    if len({y for _, y, _ in learn}) < 2:
        return []
    score = _scores(spark, learn, sorted({r["cell"] for r in counted}))
    return _calibrated(score, [r for r in counted if r["__check"]] or counted)


def _scores(spark: SparkSession, learn: list[tuple], cells: list[int]) -> dict[int, float]:
    rows = _with_features(spark.createDataFrame(sorted(learn), "cell int, label double, weight double").coalesce(1))
    wanted = _with_features(spark.createDataFrame([(c,) for c in cells], "cell int").coalesce(1))
    vector = VectorAssembler(inputCols=list(LEVELS), outputCol="features")
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, maxBins=8, stepSize=0.3, weightCol="weight", seed=11, labelCol="label"
    ).fit(vector.transform(rows))
    scored = trees.transform(vector.transform(wanted))
    return {r["cell"]: r["p"] for r in scored.select("cell", vector_to_array("probability")[1].alias("p")).collect()}


def _calibrated(score: dict[int, float], counted: list) -> list[int]:
    """Cells from the best score down to where the precision over all of them still holds."""
    totals: dict[int, list[int]] = {}
    for r in counted:
        t = totals.setdefault(r["cell"], [0, 0])
        t[0] += r["yes"]
        t[1] += r["no"]
    yes = no = 0
    threshold = 2.0
    for cell in sorted(totals, key=lambda c: (-score[c], c)):
        yes, no = yes + totals[cell][0], no + totals[cell][1]
        if yes >= PRECISION * (yes + no):
            threshold = score[cell]
    return sorted(c for c, s in score.items() if s >= threshold)


# ---- results -----------------------------------------------------------------------


def spans(docs: DataFrame, accepted: list[int]) -> DataFrame:
    """``docs`` with ``pii_base`` and ``pii``: spans (start, kind, end) in order.

    Added spans are those of accepted cells that pass their check and meet no base span,
    the earlier and then the longer one first.
    """
    rows = candidates(docs)
    base = F.filter("__spans", lambda s: (s["kind"] < N_BASE) & s["valid"])
    taken = F.array(*map(F.lit, accepted)).cast("array<int>")
    more = F.filter(
        "__spans", lambda s: (s["kind"] >= N_BASE) & s["valid"] & F.array_contains(taken, s["cell"])
    )
    rows = rows.withColumns({"__base": F.array_sort(base), "__more": F.array_sort(more)})
    clear = lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    apart = F.aggregate(
        F.filter("__more", clear),
        zero,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(s)).cast(_SPAN).alias("out")),
        ).otherwise(a),
        lambda a: a["out"],
    )
    plain = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    rows = rows.withColumns(
        {"pii_base": plain(F.col("__base")), "pii": F.array_sort(plain(F.concat("__base", apart)))}
    )
    return rows.drop("__spans", "__base", "__more")


def _written(column: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(column, one), ",")


def find(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of personal data per row of ``docs``.

    A null text is empty and has none; positions are code points. Repeated rows are
    searched each, an empty table gives no rows, further columns are ignored.
    """
    rows = spans(docs.select("doc_id", "text"), accepted_cells(docs))

    def count(kind: str) -> Column:
        of_kind = F.filter("pii_base", lambda s: s["kind"] == KINDS.index(kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(_written("pii_base"), 256).alias("base_sha256"), _written("pii").alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, ``n_chars`` to match.

    Spans that overlap are replaced together, under the first one's name. Columns and
    rows stay as they are; a null text stays null.
    """
    rows = spans(whole_rows(docs, "text"), accepted_cells(docs))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        kept = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        new = F.struct(s["end"].alias("at"), F.concat(a["out"], kept, F.get(names, s["kind"])).alias("out"))
        wider = F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))
        return F.when(s["start"] >= a["at"], new).otherwise(wider)

    done = F.aggregate(
        "pii", zero, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text")))
    )
    changed = F.size("pii") > 0
    rows = rows.withColumns({"new": F.when(changed, done).otherwise(F.col("text")), "changed": changed})

    def column(name: str) -> Column:
        old = F.col("row")[name]
        if name == "text":
            return F.col("new").alias(name)
        if name == "n_chars":
            return F.when(F.col("changed"), F.length("new").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return rows.select(*[column(c) for c in docs.columns])
