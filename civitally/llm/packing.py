"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``CAPACITY`` tokens; only longer documents are cut.
Pieces are dealt into blocks of bounded size. In each block several islands evolve
packings on their own: a solution is a list of bins, crossover injects whole well-filled
bins of one parent into the other, drops the bins that now hold a document twice, and
best-fits the documents this displaced. After an epoch the elite of every island migrates
to the next island of its block; the last epoch evolves the elites of all islands of a block
together, and its best solution is the block's packing.

Every block leaves a few badly filled bins. Their pieces go on to the next level, where
fewer blocks pack what all blocks of the level before could not place well, until one
block is left. So the tail costs a few bins in all, not a few bins per block. The number
of levels is the logarithm of the number of blocks; each level is a written table, and no
task sees more than one block.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace
from .common import batches, row_key, utf8
from .tokens import shared_cache

CAPACITY = 2048
BLOCK = 4000
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 60  # of an epoch; evolution ends earlier only where no packing has fewer bins
WELL_FILLED = 0.998
FAN_IN = 16

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids_crc32", pa.int64()), ("uid", pa.int64())]
)
_PIECES_DDL = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long, uid long"


# ---- one block --------------------------------------------------------------------


def best_fit(bins: list[list[int]], rooms: list[int], items: list[int], size: list[int], capacity: int) -> None:
    """Put ``items``, longest first, each into the fullest bin that still holds it."""
    order = sorted((room, at) for at, room in enumerate(rooms) if room)
    for item in sorted(items, key=lambda i: -size[i]):
        at = bisect_left(order, (size[item], -1))
        if at < len(order):
            room, which = order.pop(at)
            bins[which].append(item)
            rooms[which] = room - size[item]
        else:
            which = len(bins)
            bins.append([item])
            rooms.append(capacity - size[item])
        if rooms[which]:
            insort(order, (rooms[which], which))


def fitness(rooms: list[int], capacity: int) -> float:
    """Mean squared fill of the bins; fewer and more unequal bins are better."""
    return sum((1 - r / capacity) ** 2 for r in rooms) / max(1, len(rooms))


def crossover(one: list, two: list, size: list[int], capacity: int, random: Random) -> list:
    """Inject well-filled bins of ``two`` into ``one``, drop clashing bins, best-fit what fell out."""
    def room(b: list[int]) -> int:
        return capacity - sum(map(size.__getitem__, b))

    good = [b for b in two if room(b) <= (1 - WELL_FILLED) * capacity]
    injected = random.sample(good, -(-len(good) // 4)) if good else []
    taken = {i for b in injected for i in b}
    kept, loose, displaced = [], [], []
    for b in one:
        if not taken.isdisjoint(b):
            displaced.extend(i for i in b if i not in taken)
        elif room(b) <= (1 - WELL_FILLED) * capacity:
            kept.append(b)
        else:
            loose.append(b)
    for b in loose:  # mutation: badly filled bins are taken apart too
        displaced.extend(b)
    bins = [list(b) for b in injected + kept]
    best_fit(bins, [room(b) for b in bins], displaced, size, capacity)
    return bins


def first_solution(size: list[int], capacity: int, random: Random, shuffled: bool) -> list:
    """Best fit, longest first; a shuffled one packs a random half first, so parents differ."""
    items = list(range(len(size)))
    bins: list = []
    rooms: list[int] = []
    if shuffled:
        random.shuffle(items)
        half = len(items) // 2
        best_fit(bins, rooms, items[:half], size, capacity)
        items = items[half:]
    best_fit(bins, rooms, items, size, capacity)
    return bins


def evolve(size: list[int], population: list, capacity: int, random: Random, generations: int) -> list:
    """The population after some generations, best first."""
    def score(bins: list) -> tuple:
        rooms = [capacity - sum(map(size.__getitem__, b)) for b in bins]
        return len(bins), -fitness(rooms, capacity)

    ranked = sorted(((score(b), b) for b in population), key=lambda x: x[0])
    least = -(-sum(size) // capacity)
    for _ in range(generations):
        if len(ranked) < 2 or ranked[0][0][0] <= least:
            break  # no solution has fewer bins
        (_, one), (_, two) = random.sample(ranked, 2)
        child = crossover(one, two, size, capacity, random)
        ranked = sorted([*ranked, (score(child), child)], key=lambda x: x[0])[: len(population)]
    return [b for _, b in ranked]


# ---- Spark: pieces, islands, levels -------------------------------------------------


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every row of ``docs``, numbered by ``uid`` within this evaluation."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache = shared_cache(tokenizer_path)
        uid = TaskContext.get().partitionId() << 36

        def rows(part: pa.RecordBatch):
            nonlocal uid
            for doc, key, text in zip(part["doc_id"].to_pylist(), part["text_key"].to_pylist(), part["text"]):
                ids = memoryview(cache.packed_ids(text.as_py()))
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    yield doc, key, number, at // 4, len(cut) // 4, zlib.crc32(cut), uid
                    uid += 1

        for part in parts:
            yield from batches(_PIECES, rows(part))

    return docs.select(*row_key(), utf8().alias("text")).mapInArrow(run, _PIECES_DDL)


def _rows(frame: pd.DataFrame, bins: list, columns: dict) -> pd.DataFrame:
    """A solution as rows: which bin, where in it, and how full the bin is."""
    members = np.fromiter(chain.from_iterable(bins), np.int64, len(frame))
    counts = np.fromiter(map(len, bins), np.int64, len(bins))
    size, number = frame["length"].to_numpy()[members], np.repeat(np.arange(len(bins)), counts)
    ends = np.cumsum(size)
    last = np.cumsum(counts) - 1  # no bin is empty
    before = np.r_[0, ends[last[:-1]]]
    made = {
        "uid": frame["uid"].to_numpy()[members], "length": size, "bin": number,
        "offset": ends - size - before[number], "fill": (ends[last] - before)[number],
    }
    return pd.DataFrame(made | columns)


_SOLUTION = "uid long, length long, bin long, offset long, fill long, block long, island int, parent int"
_SOLUTION_COLUMNS = ["uid", "length", "bin", "offset", "fill", "block", "island", "parent"]


def _islands(members: DataFrame, capacity: int) -> DataFrame:
    """First epoch: every island of every block starts its own population."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        block, island = (int(k) for k in key)
        size, random = frame["length"].tolist(), Random(block * 1009 + island)
        best = first_solution(size, capacity, random, False)
        population = [best]
        if len(best) > -(-sum(size) // capacity):
            population += [first_solution(size, capacity, random, True) for _ in range(POPULATION - 1)]
            population = evolve(size, population, capacity, random, GENERATIONS)
        elite = _rows(frame, population[0], {"block": block})
        home = elite.assign(island=island, parent=0)
        away = elite.assign(island=(island + 1) % ISLANDS, parent=1)  # migration
        return pd.concat([home, away])[_SOLUTION_COLUMNS]

    spread = members.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    return spread.groupBy("block", "island").applyInPandas(run, _SOLUTION)


def _solutions(frame: pd.DataFrame) -> tuple[pd.DataFrame, list[list]]:
    """The members of a block and the solutions its rows describe."""
    parent = frame["parent"].to_numpy()
    first = frame[parent == parent[0]].sort_values("uid", ignore_index=True)
    uids, found = first["uid"].to_numpy(), []
    for p in np.unique(parent):
        rows = frame[parent == p]
        bins: dict[int, list[int]] = {}
        for i, b in zip(np.searchsorted(uids, rows["uid"].to_numpy()).tolist(), rows["bin"].tolist()):
            bins.setdefault(b, []).append(i)
        found.append(list(bins.values()))
    return first, found


def _next_epoch(solutions: DataFrame, capacity: int, last: bool) -> DataFrame:
    """A later epoch with the migrated elites; in the last one the islands of a block are one population."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        block, island = int(key[0]), int(key[1]) if len(key) > 1 else 0
        members, population = _solutions(frame)
        size, random = members["length"].tolist(), Random(block * 2003 + island)
        best = evolve(size, population, capacity, random, GENERATIONS)[0]
        elite = _rows(members, best, {"block": block})
        home = elite.assign(island=island, parent=island)
        return home[_SOLUTION_COLUMNS]

    keys = ["block"] if last else ["block", "island"]
    return solutions.groupBy(*keys).applyInPandas(run, _SOLUTION)


def pack_blocks(members: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A packing of each block of ``uid, length, block``."""
    found = _islands(members, capacity)
    for _ in range(EPOCHS - 1):
        found = _next_epoch(found, capacity, last=False)
    return _next_epoch(found, capacity, last=True)


def assign(sizes: DataFrame, ws: Workspace, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``uid, sequence_id, offset`` for every row of ``uid, length``."""
    level, left, done = 0, sizes.select("uid", "length"), None
    n = left.count()
    while True:
        blocks = max(1, -(-n // block))
        dealt = left.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)))
        packed = ws.stage(pack_blocks(dealt, capacity), f"level-{level}")
        number = F.lit(level << 56) + F.col("block") * (1 << 24) + F.col("bin")
        badly = F.col("fill") < WELL_FILLED * capacity
        rest = packed.where(badly)
        m = rest.count() if blocks > 1 else 0
        again = 0 < m <= 0.8 * n  # otherwise the pieces themselves do not fill bins
        settled = (packed.where(~badly) if again else packed).select("uid", number.alias("sequence_id"), "offset")
        done = settled if done is None else done.union(settled)
        if not again:
            return done
        level, left, n = level + 1, rest.select("uid", "length"), m


def pack(docs: DataFrame, ws: Workspace, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: what it holds and where it lies.

    Null and empty texts are one piece of the closing id alone. Repeated rows are packed
    each. An empty table gives no rows. Texts are taken whole whatever their length;
    further columns are ignored.
    """
    cut = ws.stage(pieces(docs, tokenizer_path, capacity), "pieces")
    placed = assign(cut, ws, capacity)
    return cut.join(placed, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
