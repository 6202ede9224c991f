"""Repeated 100-byte strings by a distributed merge sort of sampled suffixes.

A byte goes if a 100-byte string over it also starts earlier. Sorting every suffix would
move many times the corpus, so suffixes are sampled where content says so: every 100-byte
window has an anchor, the leftmost of its 40-byte strings with the smallest hash. Equal
windows have equal anchors at equal places, so a window can only repeat if its anchor
does. Neighbouring windows of one anchor form a span (100 to 160 bytes), a prefix of the
suffix at its first window; spans are what is sorted.

1. Anchors whose hash occurs once in the corpus are sorted out (hashes only, no text).
2. Tasks sort the spans of the other anchors by (anchor, bytes), keep the earliest of equal
   ones, front-code the run against its predecessor and cut it at anchor ranges.
3. A task per range merges the runs with a loser tree. Each contender carries the length
   of its common prefix with the last winner; the longer prefix wins unseen, and only a tie
   compares bytes, from the known prefix on. Equal spans meet as neighbours: all but the
   earliest are removed whole. Different spans of one anchor may still share windows; they
   are compared window by window in order of occurrence.
4. Removed ranges are united per document.

Anchors found in more than ``HOT`` places skip the spans: each of their windows is sorted
under its own hash, so a string that a third of all documents share is spread over all
tasks, and since every run sends one entry per string, over no more entries than runs.
Exact copies are answered without any of this: only the first of equal texts takes part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace
from .common import utf8

LENGTH = 100
GRAM = 40
PLACES = LENGTH - GRAM + 1
HOT = 2000
CHUNK = 1 << 18
PART_BYTES = 8 << 20
RUN_BYTES = 12 << 20
BUCKET_ANCHORS = 250_000
BUCKET_SPANS = 60_000
LAST_ID = 2**63 - 1

np.seterr(over="ignore")
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


# ---- anchors -----------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling a polynomial hash."""
    h = data.astype(np.uint64) + np.uint64(1)
    have, by_size = 1, {1: h}
    while 2 * have <= GRAM:
        h = h[:-have] * np.uint64(pow(_BASE, have, 1 << 64)) + h[have:]
        have *= 2
        by_size[have] = h
    while have < GRAM:
        size = max(s for s in by_size if have + s <= GRAM)
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + by_size[size][have:]
        have += size
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _leftmost_least(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least value of every PLACES neighbours and its leftmost place."""
    at, have = np.arange(len(h), dtype=np.int32), 1
    value = h
    while have < PLACES:
        step = min(have, PLACES - have)
        left = value[:-step] <= value[step:]
        value, at = np.where(left, value[:-step], value[step:]), np.where(left, at[:-step], at[step:])
        have += step
    return value, at


def spans_of(data: bytes, ends: list[int]) -> tuple[np.ndarray, ...]:
    """(document, anchor, start, windows) of the spans of joined documents ending at ``ends``.

    Starts count within the document. Windows never cross documents.
    """
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty.astype(np.uint64), empty, empty
    least, at = _leftmost_least(_gram_hashes(np.frombuffer(data, np.uint8)))
    ends_ = np.array(ends, np.int64)
    doc = np.repeat(np.arange(len(ends_)), np.diff(np.r_[0, ends_]))[: len(least)]
    valid = np.arange(len(least)) + LENGTH <= ends_[doc]
    new = np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(least)])
    keep = valid[first]
    first, size = first[keep], size[keep]
    doc = doc[first]
    # least hashes are small numbers; an odd factor spreads them over the buckets again
    return doc, least[first] * np.uint64(_BASE), first - np.r_[0, ends_[:-1]][doc], size


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes, list[int]]]:
    """Joined pieces of texts: (text numbers, offsets in the texts, bytes, ends)."""
    numbers, offsets, held, ends, size = [], [], [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK):
            part = text[at : at + CHUNK + LENGTH - 1]
            numbers.append(number)
            offsets.append(at)
            held.append(part)
            size += len(part)
            ends.append(size)
            if size >= CHUNK:
                yield numbers, offsets, b"".join(held), ends
                numbers, offsets, held, ends, size = [], [], [], [], 0
    if held:
        yield numbers, offsets, b"".join(held), ends


def text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[bytes, bytes]]:
    """Texts by digest, copies once, about ``PART_BYTES`` at a time."""
    for batch in batches:
        texts: dict[bytes, bytes] = {}
        size = 0
        for digest, text in zip(batch["digest"], batch["text"]):
            text = text.as_py()
            texts[digest.as_py()] = text
            size += len(text)
            if size >= PART_BYTES:
                yield texts
                texts, size = {}, 0
        if texts:
            yield texts


# ---- 1: anchors that occur twice ---------------------------------------------------------

_ANCHORS_DDL = "bucket int, hashes binary, twice binary, docs binary, digests binary"
_ANCHORS = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("hashes", "twice", "docs", "digests")])


def _anchor_rows(docs: DataFrame, buckets: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in text_parts(parts):
            digests, found = list(texts), []
            for numbers, _, data, ends in _chunks(list(texts.values())):
                doc, anchor, _, _ = spans_of(data, ends)
                found.append(np.rec.fromarrays([anchor, np.array(numbers, np.int64)[doc]], names="h,d"))
            both = np.concatenate(found) if found else np.rec.fromarrays([np.empty(0, np.uint64), np.empty(0, np.int64)], names="h,d")
            order = np.lexsort((both["d"], both["h"]))
            h, d = both["h"][order], both["d"][order].astype(np.uint32)
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])][: len(h)])
            twice = np.diff(np.r_[first, len(h)]) > 1
            h, d = h[first], d[first]
            bucket = (h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            table = np.frombuffer(b"".join(digests), "S16") if digests else np.empty(0, "S16")
            rows: list[tuple] = []
            for b in np.flatnonzero(np.diff(cuts)):
                s = slice(cuts[b], cuts[b + 1])
                used, number = np.unique(d[s], return_inverse=True)
                rows.append((b, h[s].tobytes(), twice[s].tobytes(), number.astype(np.uint32).tobytes(), table[used].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ANCHORS)], schema=_ANCHORS
            )

    return docs.mapInArrow(run, _ANCHORS_DDL)


def _repeated(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Anchors of a bucket that occur in several texts or twice in one, by text."""
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in frame["hashes"]])
    twice = np.concatenate([np.frombuffer(x, np.bool_) for x in frame["twice"]])
    digests = [np.frombuffer(x, "V16") for x in frame["digests"]]
    text = np.concatenate([d[np.frombuffer(x, np.uint32)] for d, x in zip(digests, frame["docs"])])
    pair = text.view("<u8").reshape(-1, 2)
    order = np.lexsort((pair[:, 1], pair[:, 0], h))
    h, twice, pair, text = h[order], twice[order], pair[order], text[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[starts, len(h)])
    other = np.r_[False, (h[1:] == h[:-1]) & (pair[1:] != pair[:-1]).any(axis=1)]
    again = np.logical_or.reduceat(other | twice, starts)
    keep = np.repeat(again, size)
    hot = np.repeat(size > HOT, size)
    return pd.DataFrame(
        {"digest": [x.tobytes() for x in text[keep]], "anchor": h[keep].view(np.int64), "hot": hot[keep]}
    )


# ---- 2: sorted, front-coded runs ----------------------------------------------------------

_RUNS_DDL = "bucket int, lcp binary, size binary, tail binary, id binary, doc binary, start binary"
_RUNS = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("lcp", "size", "tail", "id", "doc", "start")])
#: Bucket number of rows that hold ranges already known to be removed.
REMOVED = -1

Entry = tuple[bytes, int, bytes, int]  # anchor and bytes, document id, its digest, start


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that it is at least ``known``."""
    high = min(len(a), len(b))
    if a[known:high] == b[known:high]:
        return high
    low = known
    while high - low > 1:  # a[:low] agrees, a[:high] does not
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _run_rows(entries: list[Entry], buckets: int) -> Iterator[tuple]:
    """Front-coded rows of a sorted run, one per bucket, and a row of what it already removes."""
    entries.sort()
    gone: list[tuple] = []
    part: list[tuple] = []
    bucket, last = -1, b""
    for key, doc_id, doc, start in entries:
        if key == last:  # a later copy: entries are in order of occurrence
            gone.append((0, len(key) - 8, b"", doc_id, doc, start))
            continue
        own = int.from_bytes(key[:4], "big") * buckets >> 32
        if own != bucket:
            if part:
                yield bucket, *_packed(part)
            bucket, part, last = own, [], b""
        lcp = common_prefix(last, key, 0)
        part.append((lcp, len(key) - lcp, key[lcp:], doc_id, doc, start))
        last = key
    if part:
        yield bucket, *_packed(part)
    if gone:
        yield REMOVED, *_packed(gone)


def _packed(rows: list[tuple]) -> tuple:
    lcp, size, tail, ids, docs, start = zip(*rows)
    return (
        np.array(lcp, np.uint16).tobytes(), np.array(size, np.uint16).tobytes(), b"".join(tail),
        np.array(ids, np.int64).tobytes(), b"".join(docs), np.array(start, np.int64).tobytes(),
    )


def _runs(docs: DataFrame, buckets: int) -> DataFrame:
    """Runs of the spans of repeated anchors; ``docs`` has id, digest, text, anchors, hots."""

    def entries_of(part: pa.RecordBatch) -> Iterator[Entry]:
        step = max(1, len(part) * PART_BYTES // max(1, part["text"].nbytes))
        for at in range(0, len(part), step):
            yield from entries_of_slice(part.slice(at, step))

    def entries_of_slice(part: pa.RecordBatch) -> Iterator[Entry]:
        texts = part["text"].to_pylist()
        ids, digests = part["id"].to_pylist(), part["digest"].to_pylist()
        known = []
        for anchors, hots in zip(part["anchors"], part["hots"]):
            h = anchors.values.to_numpy().view(np.uint64)
            order = np.argsort(h)
            known.append((h[order], np.asarray(hots.values.to_pylist(), bool)[order]))
        for numbers, offsets, data, ends in _chunks(texts):
            doc, anchor, start, size = spans_of(data, ends)
            for piece in range(len(ends)):
                a, b = np.searchsorted(doc, [piece, piece + 1])
                number, offset = numbers[piece], offsets[piece]
                h, hots = known[number]
                place = np.minimum(np.searchsorted(h, anchor[a:b]), len(h) - 1)
                text, doc_id, digest = texts[number], ids[number], digests[number]
                for i in np.flatnonzero(h[place] == anchor[a:b]):
                    at, n = offset + int(start[a + i]), int(size[a + i])
                    if hots[place[i]]:
                        for w in range(at, at + n):
                            window = text[w : w + LENGTH]
                            yield xxhash.xxh3_64_digest(window) + window, doc_id, digest, w
                    else:
                        key = int(anchor[a + i]).to_bytes(8, "big")
                        yield key + text[at : at + n - 1 + LENGTH], doc_id, digest, at

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Entry] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            rows = list(_run_rows(held, buckets))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RUNS)], schema=_RUNS
            )

        for part in parts:
            for entry in entries_of(part):
                held.append(entry)
                size += len(entry[0])
                if size >= RUN_BYTES:
                    yield flushed()
                    held, size = [], 0
        if held:
            yield flushed()

    return docs.mapInArrow(run, _RUNS_DDL)


# ---- 3: merging -----------------------------------------------------------------------


class Run:
    """A front-coded run, read forward; ``lcp`` is the prefix shared with the entry before."""

    def __init__(self, row):
        self.lcps = np.frombuffer(row.lcp, np.uint16).tolist()
        self.sizes = np.frombuffer(row.size, np.uint16).tolist()
        self.tail, self.ids = row.tail, np.frombuffer(row.id, np.int64).tolist()
        self.docs, self.starts = row.doc, np.frombuffer(row.start, np.int64).tolist()
        self.number, self.at, self.key, self.lcp = -1, 0, b"", 0

    def advance(self) -> bool:
        self.number += 1
        if self.number == len(self.lcps):
            return False
        self.lcp = self.lcps[self.number]
        end = self.at + self.sizes[self.number]
        self.key = self.key[: self.lcp] + self.tail[self.at : end]
        self.at = end
        return True

    def entry(self) -> Entry:
        i = self.number
        return self.key, self.ids[i], self.docs[16 * i : 16 * i + 16], self.starts[i]


def merged(runs: list[Run]) -> Iterator[Entry]:
    """Entries of all runs in order of their keys, by a loser tree over common prefixes.

    A contender is its run and its common prefix with the last winner. Of two, the longer
    prefix is the smaller key and nothing is compared; on a tie bytes are compared from
    there on, and the loser keeps the prefix it shares with the winner it lost to.
    """
    runs = [r for r in runs if r.advance()]
    if not runs:
        return
    k = 1
    while k < len(runs):
        k *= 2
    none = -1
    lcp = [0] * len(runs)
    loser = [none] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; runs that have ended lose."""
        if a == none or b == none:
            return (b, a) if a == none else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = runs[a].key, runs[b].key
        same = common_prefix(x, y, lcp[a])
        win, lose = (a, b) if x[same:] <= y[same:] else (b, a)
        lcp[lose] = same
        return win, lose

    level = [i if i < len(runs) else none for i in range(k)]
    base = k
    while len(level) > 1:
        base //= 2
        following = []
        for i in range(0, len(level), 2):
            win, lose = play(level[i], level[i + 1])
            loser[base + i // 2] = lose
            following.append(win)
        level = following
    winner = level[0]
    while winner != none:
        run = runs[winner]
        yield run.entry()
        node = (winner + k) // 2
        if run.advance():
            lcp[winner] = run.lcp
            at = winner
        else:
            at = none
        while node:
            at, loser[node] = play(at, loser[node])
            node //= 2
        winner = at


def _removed(entries: Iterator[Entry]) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, bytes) of removed ranges, from entries in order of their keys."""
    anchor, spans = b"", []  # per different span its earliest occurrence: (id, digest, start, bytes)

    def shared() -> Iterator[tuple[bytes, int, int]]:
        """Windows that an earlier span of the anchor has too."""
        if len(spans) < 2:
            return
        seen: set[bytes] = set()
        for _, doc, start, text in sorted(spans):
            begun = None
            for w in range(len(text) - LENGTH + 1):
                window = text[w : w + LENGTH]
                if window in seen:
                    begun = w if begun is None else begun
                else:
                    seen.add(window)
                    if begun is not None:
                        yield doc, start + begun, w - 1 + LENGTH - begun
                        begun = None
            if begun is not None:
                yield doc, start + begun, len(text) - begun

    last = None
    for key, doc_id, doc, start in entries:
        if key == last:
            _, first_doc, first_start, text = spans[-1]
            if (doc_id, doc, start) < spans[-1][:3]:
                spans[-1] = (doc_id, doc, start, text)
                doc, start = first_doc, first_start
            yield doc, start, len(text)
            continue
        if key[:8] != anchor:
            yield from shared()
            anchor, spans = key[:8], []
        spans.append((doc_id, doc, start, key[8:]))
        last = key
    yield from shared()


def _merge_bucket(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    if key[0] == REMOVED:  # nothing to merge
        rows = [(r.doc[16 * i : 16 * i + 16], s, n) for r in frame.itertuples() for i, (s, n) in enumerate(
            zip(np.frombuffer(r.start, np.int64).tolist(), np.frombuffer(r.size, np.uint16).tolist()))]
    else:
        rows = list(_removed(merged([Run(r) for r in frame.itertuples()])))
    return pd.DataFrame(rows, columns=["digest", "start", "size"])


# ---- 4: documents -----------------------------------------------------------------------


def united(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes under any of the ranges."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[first].tolist(), reach[np.r_[first[1:] - 1, len(starts) - 1]].tolist()))


_KEPT = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string())])


def _kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        rows = []
        for digest, text, start, size in zip(part["digest"].to_pylist(), part["text"], part["starts"], part["sizes"]):
            text, s = text.as_py(), start.values.to_numpy()
            cut = united(s, s + size.values.to_numpy())
            hash_, at = sha256(), 0
            for a, b in cut:
                hash_.update(text[at:a])
                at = b
            hash_.update(text[at:])
            rows.append((digest, sum(b - a for a, b in cut), len(cut), hash_.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_KEPT)], schema=_KEPT
        )


def once(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen texts (``digest, id`` and more), one row each though rows may repeat.

    The join has dealt rows by these columns, so that telling them apart moves nothing.
    """
    return rows.select("id", "digest", "text").join(chosen, ["digest", "id"]).dropDuplicates(["digest", "id"])


def remove_repeats(docs: DataFrame, ws: Workspace) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    A null text is empty. Documents are ordered by id, those without one last; texts under
    one id by their digest; rows with the same id and text are one document and share
    their answer. An empty table gives no rows; further columns are ignored.
    """
    digest = F.unhex(F.md5(utf8())).alias("digest")
    order = F.coalesce("doc_id", F.lit(LAST_ID)).alias("id")
    rows = docs.select("doc_id", order, digest, utf8().alias("text"))
    firsts = ws.stage(
        rows.groupBy("digest").agg(F.min("id").alias("id"), F.max(F.octet_length("text")).alias("n_bytes")), "firsts"
    )
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0

    anchor_buckets = max(1, -(-total // (LENGTH // 3 * BUCKET_ANCHORS)))
    anchors = _anchor_rows(rows.select("digest", "text"), anchor_buckets)
    again = ws.stage(
        anchors.groupBy("bucket").applyInPandas(_repeated, "digest binary, anchor long, hot boolean"), "again"
    )
    todo = again.groupBy("digest").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot").alias("hots"))
    todo = ws.stage(todo.join(firsts.select("digest", "id"), "digest"), "todo")

    entries = again.agg(F.sum(F.when(F.col("hot"), LENGTH // 3).otherwise(1))).first()[0] or 0
    span_buckets = max(1, -(-entries // BUCKET_SPANS))
    runs = ws.stage(_runs(once(rows, todo), span_buckets), "runs")
    spread = F.when(F.col("bucket") == REMOVED, F.spark_partition_id()).otherwise(F.lit(-1))
    ranges = runs.groupBy("bucket", spread.alias("spread")).applyInPandas(
        _merge_bucket, "digest binary, start long, size long"
    )
    by_doc = ranges.groupBy("digest").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    cuts = ws.stage(by_doc.join(firsts.select("digest", "id"), "digest"), "cuts")
    found = once(rows, cuts).select("digest", "text", "starts", "sizes")
    answers = ws.stage(found.mapInArrow(_kept, "digest binary, n_removed long, n_spans long, kept string"), "answers")

    plain = docs.select(
        "doc_id", order, digest, F.octet_length(utf8()).cast("long").alias("n_bytes"), F.sha2(utf8(), 256).alias("sha")
    )
    first = firsts.select("digest", F.col("id").alias("first")).join(answers, "digest", "left")
    joined = plain.join(first, "digest")
    copy = (F.col("id") != F.col("first")) & (F.col("n_bytes") >= LENGTH)
    own = F.col("id") == F.col("first")
    none = F.lit(0).cast("long")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).when(own, F.coalesce("n_removed", none)).otherwise(none).alias("n_removed"),
        F.when(copy, 1).when(own, F.coalesce("n_spans", none)).otherwise(0).cast("long").alias("n_spans"),
        F.when(copy, F.lit(sha256().hexdigest())).when(own, F.coalesce("kept", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
