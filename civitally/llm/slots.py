"""Blocks of an index resident in slots, and queries that stream past every slot.

A slot is a bounded set of packed blocks that one task holds. Every query is sent to every
slot once and meets the blocks there, so queries need not fit a task or the driver, no rows
are paired by a join, and what a slot returns for a query is bounded by the search itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries handed to the search of a slot at once.
CHUNK = 64

Search = Callable[[list[dict]], pa.RecordBatch]


def slot_count(blocks: DataFrame, rows: str, slot_rows: int) -> int:
    """So many slots that each holds about ``slot_rows`` rows and that small jobs use all cores."""
    found = blocks.agg(F.count("*").alias("n"), F.sum(rows).alias("rows")).first()
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return max(1, min(found["n"], 2 * cores), -(-(found["rows"] or 0) // slot_rows))


def views(rows: pa.StructArray) -> Iterator[dict]:
    """Each row as a dict whose bytes and lists are views of the Arrow buffers, not Python objects."""
    columns = {f.name: c for f, c in zip(rows.type, rows.flatten())}
    for i in range(len(rows)):
        cells = {name: c[i] for name, c in columns.items()}
        yield {
            name: x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.values if isinstance(x, pa.ListScalar) else x.as_py()
            for name, x in cells.items()
        }


def search_slots(
    blocks: DataFrame,
    queries: DataFrame,
    slots: int,
    made: Callable[[list[dict]], Search],
    result: str,
    place: Column | None = None,
) -> DataFrame:
    """The rows that ``made(blocks of a slot)`` returns for all queries, a chunk at a time.

    ``blocks`` and ``queries`` are written tables; ``blocks`` has a column ``block``, a number by
    whose hash it finds its slot, unless ``place`` numbers the blocks one by one. Rows reach the search as dicts, those of blocks as ``views``.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        waiting: list[dict] = []
        search: Search | None = None
        for part in parts:
            first = int(np.searchsorted(part["kind"].to_numpy(), 1))
            held += views(part["held"].slice(0, first))
            if first == len(part):
                continue
            if not held:
                return  # blocks come first; a slot that drew none has no answers
            if search is None:
                search, held = made(held), [{}]  # only what the search keeps of the blocks stays
            for at in range(first, len(part), CHUNK):
                waiting += part["query"].slice(at, CHUNK).to_pylist()
                while len(waiting) >= CHUNK:
                    yield search(waiting[:CHUNK])
                    waiting = waiting[CHUNK:]
        if search and waiting:
            yield search(waiting)

    resident = blocks.select(
        F.pmod(F.xxhash64("block") if place is None else place, F.lit(slots)).cast("int").alias("slot"),
        F.lit(0).alias("kind"),
        F.struct(*blocks.columns).alias("held"),
        F.lit(None).cast(queries.schema).alias("query"),
    )
    streamed = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(blocks.schema).alias("held"),
        F.struct(*queries.columns).alias("query"),
    )
    both = resident.union(streamed).repartitionById(slots, "slot").sortWithinPartitions("kind")
    return both.mapInArrow(run, result)


class Best:
    """The best (score, id) a query has found so far.

    A row must reach ``floor`` to get in: the least score wanted, if any, and once there are
    ``size`` rows the lowest of theirs, since an equal score may win by its id.
    """

    def __init__(self, size: int, least: float = -np.inf):
        self.size, self.floor = size, least
        self.score, self.doc = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        enough = score >= self.floor
        score, doc = np.r_[self.score, score[enough]], np.r_[self.doc, doc[enough]]
        order = np.lexsort((doc, -score))[: self.size]
        self.score, self.doc = score[order], doc[order]
        if len(order) == self.size:
            self.floor = int(self.score[-1])
