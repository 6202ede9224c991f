"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most three
bits differ in at most three bytes, so they share at least five of the eight positional
bytes: five is the guaranteed minimum count. Postings of single bytes would be long, so
the index keeps postings of ``WIDTH`` positional bytes at once: of five shared bytes at
least ``WIDTH`` lie among the first ``WIDTH + 3`` positions, so indexing every choice of
``WIDTH`` positions out of these loses no pair. Inside a posting the shared positional
bytes of each pair are tallied, pairs below five are dropped, the rest are verified by
their differing bits.

Only distinct fingerprints are indexed; documents with equal ones hang on their class.
A posting longer than ``BLOCK`` is cut into chunks and every pair of chunks is one unit of
work, so no task ever holds a whole hot posting. A unit does not emit its pairs: it walks
them breadth first and emits the edges of a spanning forest, which keeps every connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace
from .common import ASCII_LOWER, record_batch, row_key, unwrapped, utf8, whole_rows
from .components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BYTES = 8
WIDTH = 3
BLOCK = 2048

_PRINTS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of one UTF-8 text, as an unsigned number."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
    rows = np.frombuffer(digests, np.uint8).reshape(-1, BYTES)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 4096):
        ones += np.unpackbits(rows[at : at + 4096], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, fp`` per row of ``docs``; fp is the fingerprint as a signed long."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = np.fromiter((fingerprint(t.as_py()) for t in part["text"]), np.uint64, len(part))
            yield record_batch(_PRINTS, part["doc_id"], part["text_key"], pa.array(fp.view(np.int64)))

    rows = docs.select(*row_key(), utf8().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _postings(fp: Column) -> Column:
    """One key per choice of positions: the choice's number and the bytes found there."""
    byte = [F.shiftrightunsigned(fp, 8 * (BYTES - 1 - i)).bitwiseAND(255) for i in range(BYTES)]
    keys = []
    for number, places in enumerate(combinations(range(WIDTH + MAX_BITS), WIDTH)):
        key = F.lit(number).cast("long")
        for p in places:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    return F.array(*keys)


def close_pairs(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Mask of ``many`` (unsigned longs) within the bit bound of ``one``.

    Tally the shared positional bytes, keep who reaches the minimum, verify the bits.
    """
    differ = np.bitwise_xor(one, many)
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    kept = shared >= BYTES - MAX_BITS
    kept[kept] = np.bitwise_count(differ[kept]) <= MAX_BITS
    return kept


def _forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the closeness graph over distinct fingerprints."""
    waiting = fps
    while len(waiting) > 1:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            at = queue.pop()
            near = close_pairs(at, waiting)
            if near.any():
                found = waiting[near]
                waiting = waiting[~near]
                queue.extend(found)
                yield from zip(repeat(at), found)


def _link(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges inside the units of a partition sorted by unit."""
    unit, fps = np.empty(0, np.int64), np.empty(0, np.int64)

    def edges(unit: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        fps = fps.view(np.uint64)
        cuts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True])
        sizes = np.diff(cuts)
        a, b = [], []
        twos = cuts[:-1][sizes == 2]  # most units are one pair
        if len(twos):
            x, y = fps[twos], fps[twos + 1]
            near = close_pairs(x, y)
            a.append(x[near])
            b.append(y[near])
        for at, size in zip(cuts[:-1][sizes > 2], sizes[sizes > 2]):
            found = list(_forest(fps[at : at + size]))
            if found:
                ends = np.array(found, np.uint64)
                a.append(ends[:, 0])
                b.append(ends[:, 1])
        ends = [np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (a, b)]
        return record_batch(_EDGES, *map(pa.array, ends))

    for part in parts:
        unit = np.r_[unit, part["unit"].to_numpy()]
        fps = np.r_[fps, part["fp"].to_numpy()]
        if len(unit):
            last = int(np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])[-1])
            if last:
                yield edges(unit[:last], fps[:last])
            unit, fps = unit[last:], fps[last:]
    if len(unit):
        yield edges(unit, fps)


def links(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) that keep every connection."""
    posted = classes.select("fp", F.explode(_postings(F.col("fp"))).alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / block).cast("int")
    cut = posted.join(shared, "key").select(
        "fp", "key", chunks.alias("c"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("i")
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("c") - 1))
    units = cut.select("fp", "key", "i", partner.alias("j")).select(
        "fp", F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("unit")
    )
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_link, "a long, b long")


def simhash_groups(docs: DataFrame, ws: Workspace) -> DataFrame:
    """``doc_id, text_key, fp, component, component_id`` per row of ``docs``.

    ``component`` (its least fingerprint) is the key of a component; ``component_id``, its
    least id, is not one where ids repeat or are null.

    Null and wordless texts have fingerprint zero and are linked like any other. Rows
    without an id take part; a component of such rows only has a null id. Repeated rows
    share everything. An empty table gives no rows; further columns are ignored.
    """
    prints = ws.stage(fingerprints(docs), "prints")
    classes = ws.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(ws.stage(links(classes.select("fp")), "links"), ws)
    linked = ws.stage(
        classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        ),
        "linked",
    )
    ids = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = ws.stage(linked.join(ids, "component").select("fp", "component", "component_id"), "of_class")
    return prints.join(of_class, "fp")


def keep_one_per_group(docs: DataFrame, ws: Workspace) -> DataFrame:
    """Rows of ``docs`` that represent their group: the least id of each, one row of it."""
    groups = simhash_groups(docs, ws)
    chosen = groups.groupBy("component").agg(
        F.min_by(F.struct("doc_id", "text_key"), F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k")
    ).select("k.*")
    chosen = ws.stage(chosen.distinct(), "chosen")
    keyed = whole_rows(docs, *row_key())
    same = keyed["doc_id"].eqNullSafe(chosen["doc_id"]) & (keyed["text_key"] == chosen["text_key"])
    return unwrapped(keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "text_key"]))
