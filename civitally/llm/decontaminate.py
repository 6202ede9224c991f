"""Benchmark decontamination by Wu-Manber search over words.

The text is normalised to words and the patterns are windows of benchmark words, so the
alphabet of the search is the word. Patterns of one length share a block shift table: a
block is two neighbouring words, a block that no pattern holds lets the search jump past
it, and a block that ends some pattern names a bucket of patterns (the suffix hash) which
are then compared word by word. Patterns of other lengths (items shorter than a window)
get a table of their own, so that a short one does not shorten everybody's jumps.

Patterns reach the executors with the task. Their number per pass is bounded by
``PASS_WORDS`` benchmark words; a larger benchmark is searched in several passes whose
findings are merged per document, so no bound drops an item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import Workspace
from .common import ASCII_LOWER, unwrapped, utf8, whole_rows

WINDOW = 10
PASS_WORDS = 50_000

#: Bytes that may stand in a word; all others become blanks. A-Z are lower-cased.
_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in ASCII_LOWER
)

_FOUND = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def joined_spans(spans: list[int]) -> list[int]:
    """Flat (start, end, ...) spans as disjoint ones in order."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


class Matcher:
    """Wu-Manber tables for the windows of some items, given as (item id, words)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        owners: dict[tuple, set[str | None]] = defaultdict(set)
        for item, words in items:
            length = min(WINDOW, len(words))
            for at in range(len(words) - length + 1 if words else 0):
                owners[tuple(words[at : at + length])].add(item)
        self.owners = dict(owners)
        self.number = {w: i + 1 for i, w in enumerate({w for p in owners for w in p})}
        self.single: dict[int, tuple] = {}
        self.tables: dict[int, tuple[dict, dict]] = {}
        base = len(self.number) + 1
        for pattern in owners:
            ids, m = [self.number[w] for w in pattern], len(pattern)
            if m == 1:
                self.single[ids[0]] = pattern
                continue
            shift, bucket = self.tables.setdefault(m, ({}, defaultdict(list)))
            for end in range(1, m):
                block = ids[end - 1] * base + ids[end]
                shift[block] = min(shift.get(block, m - 1), m - 1 - end)
            bucket[ids[-2] * base + ids[-1]].append((ids, pattern))
        self.base = base

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(first word, pattern) of every occurrence, overlapping ones included."""
        number = self.number
        ids = [number.get(w, 0) for w in words]
        if self.single:
            for at, i in enumerate(ids):
                if i in self.single:
                    yield at, self.single[i]
        base = self.base
        for m, (shift, bucket) in self.tables.items():
            jump, end, n = m - 1, m - 1, len(ids)
            while end < n:
                block = ids[end - 1] * base + ids[end]
                step = shift.get(block, jump)
                if step:
                    end += step
                    continue
                first = end - m + 1
                for wanted, pattern in bucket[block]:
                    if ids[first : end + 1] == wanted:
                        yield first, pattern
                end += 1

    def hits(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Disjoint word spans that occurrences cover, flat (start, end, ...), and the items."""
        spans: list[int] = []
        items: set[str | None] = set()
        for start, pattern in self.search(words):
            items |= self.owners[pattern]
            spans += [start, start + len(pattern)]
        return joined_spans(spans), sorted(items - {None})


def _slices(benchmark: DataFrame) -> Iterator[Matcher]:
    """Matchers over slices of the benchmark, each of about ``PASS_WORDS`` words."""
    items = (
        benchmark.where("text is not null")
        .select(F.col("item_id").cast("string").alias("item"), utf8().alias("text"))
        .distinct()
    )
    size = F.sum(F.octet_length("text")).alias("size")
    total = items.agg(size).first()["size"] or 0
    slices = -(-total // (6 * PASS_WORDS))
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k) if slices > 1 else items
        yield Matcher([(r["item"], words_of(bytes(r["text"]))) for r in part.collect()])


def _scan(docs: DataFrame, matcher: Matcher) -> DataFrame:
    """``docs`` with ``n_words, spans, items``; findings of an earlier pass are joined in."""
    earlier = "spans" in docs.columns
    carried = [f for f in docs.schema if f.name not in _FOUND.names]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n_words, spans, items = [], [], []
            for at, text in enumerate(part["__utf8"]):
                words = words_of(text.as_py())
                s, i = matcher.hits(words)
                if earlier:
                    s = joined_spans(s + part["spans"][at].as_py())
                    i = sorted({*i, *part["items"][at].as_py()})
                n_words.append(len(words))
                spans.append(s)
                items.append(i)
            more = [pa.array(v, f.type) for v, f in zip((n_words, spans, items), _FOUND)]
            yield pa.RecordBatch.from_arrays(
                [part[f.name] for f in carried] + more, names=[f.name for f in carried] + _FOUND.names
            )

    schema = T.StructType(list(carried)).add("n_words", T.LongType()).add("spans", T.ArrayType(T.LongType()))
    return docs.mapInArrow(run, schema.add("items", T.ArrayType(T.StringType())))


def search(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (flat word positions, disjoint) and ``items``.

    Columns of these names are replaced. Null and wordless texts have no words and no
    hits; null and wordless items match nothing. An item without an id hits like any other,
    but ``items`` has no name for it. Repeated rows are searched each. An empty benchmark leaves every document clean.
    """
    rows = docs.drop(*_FOUND.names).withColumn("__utf8", utf8())
    matcher, more = Matcher([]), _slices(benchmark)
    for step, matcher in enumerate(more):
        if step:  # a benchmark of several slices: one pass each over rows that carry what was found
            rows = ws.stage(_scan(rows, held), f"pass-{step}")
        held = matcher
    return _scan(rows, matcher).drop("__utf8")


def decontaminate(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``."""
    found = search(docs.select("doc_id", "text"), benchmark, ws)
    ends = F.filter("spans", lambda _, i: i % 2 == 1)
    starts = F.filter("spans", lambda _, i: i % 2 == 0)
    zero = F.lit(0).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        (F.aggregate(ends, zero, lambda a, x: a + x) - F.aggregate(starts, zero, lambda a, x: a + x)).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, ws: Workspace) -> DataFrame:
    """Rows of ``docs`` without a benchmark window, whatever columns they have."""
    return unwrapped(search(whole_rows(docs, "text"), benchmark, ws).where(F.size("spans") == 0))
