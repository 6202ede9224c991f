"""Exact nearest vectors by inner product through a pivot table.

Components become the integers floor(SCALE * x). The inner product of q and x is
(|q|^2 + |x|^2 - d(q, x)^2) / 2, and by the triangle inequality d(q, x) is at least
|d(q, p) - d(x, p)| for every pivot p. The table holds the distances of all vectors to
``PIVOTS`` pivots; the greatest of these lower bounds of the distance gives an upper bound
of the score.

Rows are laid out by their nearest pivot and their distance to it, and packed into blocks,
which carry the range of their distances to every pivot. So the same bound rules out whole
blocks first. In the blocks left every row gets its bound, and rows are evaluated in the order
of bounds until the next bound is below the lowest of the best scores found: a row of an equal
bound is still evaluated, since it may win by its id. Scores are integers and exact.

Pivots are chosen far apart among ``SAMPLE`` rows at most. They decide how much is ruled out and
never a result; vectors without any structure (independent directions in many dimensions) have
nearly equal distances, and then most rows are evaluated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import Workspace
from .common import batches, record_batch
from .slots import Best, Search, search_slots, slot_count

SCALE = 256
PIVOTS = 32
SAMPLE = 2048
BLOCK_ROWS = 2048
SLOT_ROWS = 262_144

#: Rows evaluated in the first step of a query in a block; every step takes four times more.
FIRST_STEP = 32

#: Sums of products below it are exact in doubles.
EXACT = 2**53

#: Stands for a missing id, which comes last among equal scores.
NO_ID = 2**63 - 1


def whole(vector: str) -> Column:
    """The integer components; null where the vector is null or one of its components not finite."""
    number = F.transform(vector, lambda x: F.floor(SCALE * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~bad, number.cast("array<long>"))


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` rows of the sample, each the farthest from those before."""
    if not len(sample):
        return sample
    picked = [0]
    distance = np.full(len(sample), np.inf)
    while len(picked) < min(count, len(sample)):
        distance = np.minimum(distance, distances(sample, sample[picked[-1:]])[:, 0])
        if not distance.max():
            break
        picked.append(int(distance.argmax()))
    return sample[picked]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances, a column per pivot."""
    x = vectors.astype(np.float64)
    out = np.empty((len(x), len(pivots)))
    for k, p in enumerate(pivots.astype(np.float64)):
        out[:, k] = np.sqrt(((x - p) ** 2).sum(axis=1))
    return out


# ---- searching a slot ------------------------------------------------------------------


class Rows:
    """The blocks of a slot, read back."""

    def __init__(self, blocks: list[dict], width: int, kind: str):
        self.uid = [np.frombuffer(b["uids"], np.int64) for b in blocks]
        self.ids = [np.frombuffer(b["ids"], np.int64) for b in blocks]
        self.vectors = [np.frombuffer(b["vectors"], kind).reshape(-1, width) for b in blocks]
        self.table = [np.frombuffer(b["distances"], np.float32).reshape(len(u), -1) for b, u in zip(blocks, self.uid)]
        self.norms = [(v.astype(np.float64) ** 2).sum(axis=1) for v in self.vectors]
        self.low = np.array([t.min(axis=0) for t in self.table], np.float64)
        self.high = np.array([t.max(axis=0) for t in self.table], np.float64)
        self.longest = np.array([n.max() for n in self.norms])


def _bound(own: np.ndarray, others: np.ndarray, apart: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Upper bounds of scores from squared lengths and lower bounds of distances.

    Stored distances are single precision; ``reach`` is the greatest of those compared, and
    what rounding can have added to a bound is taken off again.
    """
    apart = np.maximum(apart - 4e-7 * reach, 0)
    total = own + others
    return (total - apart**2) / 2 + 1e-9 * total + 1


def _searcher(blocks: list[dict], pivots: np.ndarray, width: int, kind: str, exact: bool, size: int) -> Search:
    rows = Rows(blocks, width, kind)
    number = np.float64 if exact else np.int64

    def evaluate(best: Best, b: int, vectors: np.ndarray, q: np.ndarray, bound: np.ndarray) -> int:
        """Rows of block ``b`` in the order of bounds; returns how many were evaluated."""
        chosen = np.flatnonzero(bound >= best.floor)
        chosen = chosen[np.argsort(-bound[chosen], kind="stable")]
        at, step = 0, FIRST_STEP
        while at < len(chosen) and bound[chosen[at]] >= best.floor:
            some = chosen[at : at + step]
            best.add((vectors[some] @ q).astype(np.int64), rows.ids[b][some])
            at, step = at + len(some), step * 4
        return at

    def search(queries: list[dict]) -> pa.RecordBatch:
        q = np.array([np.frombuffer(x["vector"], kind) for x in queries]).reshape(len(queries), width)
        own = (q.astype(np.float64) ** 2).sum(axis=1)
        to_pivots = distances(q, pivots)
        uid = np.array([x["uid"] for x in queries], np.int64)
        best = [Best(size) for _ in queries]
        beyond = np.maximum(rows.low[None] - to_pivots[:, None], to_pivots[:, None] - rows.high[None]).max(axis=2)
        reach = max(to_pivots.max(initial=0), rows.high.max(initial=0))
        coarse = _bound(own[:, None], rows.longest[None], beyond, reach)
        for b in np.argsort(-coarse.max(axis=0), kind="stable"):
            floors = np.array([x.floor for x in best], np.float64)
            active = np.flatnonzero(coarse[:, b] >= floors)
            if not len(active):
                continue
            apart = np.zeros((len(active), len(rows.uid[b])))
            for p in range(len(pivots)):
                np.maximum(apart, np.abs(to_pivots[active, p, None] - rows.table[b][:, p][None]), out=apart)
            fine = _bound(own[active, None], rows.norms[b][None], apart, reach)
            fine[uid[active, None] == rows.uid[b][None]] = np.nan  # the query's own row reaches nothing
            vectors = rows.vectors[b].astype(number)
            for k, i in enumerate(active):
                evaluate(best[i], b, vectors, q[i].astype(number), fine[k])
        return record_batch(
            _FOUND,
            pa.array(np.repeat(uid, [len(x.doc) for x in best])),
            pa.array(np.concatenate([x.doc for x in best])),
            pa.array(np.concatenate([x.score for x in best])),
        )

    return search


# ---- Spark ---------------------------------------------------------------------------------

_FOUND = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "uid long, vec_id long, score long"
_PLACED = pa.schema(
    [("uid", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.binary()), ("cell", pa.int32()), ("near", pa.float32()),
     ("distances", pa.binary())]
)
_PLACED_DDL = "uid long, vec_id long, vector binary, cell int, near float, distances binary"
_PACKED = pa.schema(
    [("block", pa.int64()), ("n", pa.int64()), ("uids", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary()),
     ("distances", pa.binary())]
)
_PACKED_DDL = "block long, n long, uids binary, ids binary, vectors binary, distances binary"


def _padded(vectors: list[np.ndarray], width: int, kind: str) -> np.ndarray:
    out = np.zeros((len(vectors), width), kind)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _table(parts: Iterator[pa.RecordBatch], pivots: np.ndarray, width: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes with their pivot distances, their nearest pivot and how near it is."""
    for part in parts:
        for at in range(0, len(part), BLOCK_ROWS):
            some = part.slice(at, BLOCK_ROWS)
            vectors = _padded([v.values.to_numpy() for v in some["v"]], width, kind)
            apart = distances(vectors, pivots).astype(np.float32)
            cell = apart.argmin(axis=1)
            yield record_batch(
                _PLACED, some["uid"], some["vec_id"], [v.tobytes() for v in vectors], cell.astype(np.int32),
                apart[np.arange(len(cell)), cell], [d.tobytes() for d in apart],
            )


def _packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that lie in order and share their nearest pivot."""
    first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32

    def rows() -> Iterator[tuple]:
        made = 0
        for part in parts:
            cell = part["cell"].to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(cell)) + 1, len(cell)] if len(cell) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                for at in range(a, b, BLOCK_ROWS):
                    some = part.slice(at, min(BLOCK_ROWS, b - at))
                    ids = some["vec_id"].fill_null(NO_ID)
                    yield (
                        first + made, len(some), some["uid"].to_numpy().tobytes(), ids.to_numpy().tobytes(),
                        b"".join(some["vector"].to_pylist()), b"".join(some["distances"].to_pylist()),
                    )
                    made += 1

    yield from batches(_PACKED, rows(), 16)


def nearest(vectors: DataFrame, queries: Column, best: int, ws: Workspace, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``best`` highest inner products per row that ``queries`` selects.

    Candidates are all rows but the query's own. Scores are inner products of the integers
    floor(256 * x); equal ones go by ascending vec_id, rows without an id last. Vectors that
    are null or hold null or non-finite components take no part; of vectors of unequal
    length the missing components count as 0. Scores that exceed 64 bits are undefined. Repeated
    rows and ids are answered each, an empty table gives no rows, further columns are
    ignored.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"), "vec_id", whole(vector).alias("v"), queries.alias("asked")
    )
    rows = ws.stage(rows.where("v is not null"), "whole")
    largest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    shape = rows.agg(F.max(F.size("v")).alias("width"), largest.alias("largest")).first()
    width, most = shape["width"] or 0, shape["largest"] or 0
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    drawn = rows.orderBy(F.xxhash64("v", "uid")).limit(SAMPLE).select("v").collect()
    pivots = far_apart(_padded([np.array(r["v"], np.int64) for r in drawn], width, kind), PIVOTS)
    table = rows.select("uid", "vec_id", "v").mapInArrow(
        partial(_table, pivots=pivots, width=width, kind=kind), _PLACED_DDL
    )
    table = ws.stage(table, "table")
    laid = table.repartitionByRange("cell", "near", "uid").sortWithinPartitions("cell", "near", "uid")
    blocks = ws.stage(laid.mapInArrow(_packed, _PACKED_DDL), "blocks")
    asked = ws.stage(
        table.join(rows.where("asked").select("uid"), "uid", "left_semi").select("uid", "vector"), "asked"
    )
    exact = most * most * max(width, 1) < EXACT
    found = search_slots(
        blocks,
        asked,
        slot_count(blocks, "n", SLOT_ROWS),
        lambda held: _searcher(held, pivots, width, kind, exact, best),
        _FOUND_DDL,
    )
    order = Window.partitionBy("uid").orderBy(F.col("score").desc(), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    names = rows.where("asked").select("uid", F.col("vec_id").alias("query_id"))
    return top.join(names, "uid").select(
        "query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score"
    )
