"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

The texts of a batch share one suffix array over word numbers (sorted by text first), made by
prefix doubling in which only suffixes not yet told apart are sorted again. The ranks of every
doubling step are kept: two suffixes agree on 2^k words where their ranks of step k are equal,
which yields the LCP array and, later, exact comparisons of any length in two look-ups.

For each LCP interval of depth l, all children but the largest are visited: a suffix i whose
partner i + l or i - l lies in the interval (ISA), but not in the same child, begins a square
of root length l that does not continue to the right. Intervals and their children come from
the previous and next smaller values of the LCP array; no tree is built. Squares that cannot
be rotated to the left far enough are sorted out, the others are rotated as far as they go,
and squares with one end whose roots are powers of each other merge into the run of the
smallest period.

A text needs two suffixes that agree on ``least * (repeats - 1) / repeats`` words to hold a run
at all, so texts without are done after the LCP array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8

#: A run has at least so many words, and holds its period at least so many times.
LEAST, REPEATS = 24, 3

#: Words that share a suffix array, but for longer texts, which have one of their own.
BATCH_WORDS = 200_000

#: Suffixes tested at once.
TESTED = 1_000_000


class Suffixes:
    """Suffix array, its inverse, LCP values and ranks by step of several sequences.

    ``words`` holds the numbers of the words of all sequences, ``begin`` where each starts.
    ``lcp[k]`` belongs to the suffixes at ``k - 1`` and ``k``; across sequences it is 0.
    """

    def __init__(self, words: np.ndarray, begin: np.ndarray):
        n = len(words)
        length = np.diff(np.r_[begin, n])
        self.words = words
        self.end = np.repeat(np.r_[begin[1:], n], length).astype(np.int64)
        self.start = np.repeat(begin, length).astype(np.int64)
        key = self.start * (int(words.max(initial=0)) + 1) + words
        self.sa = np.argsort(key, kind="stable")
        ordered = key[self.sa]
        new = np.r_[True, ordered[1:] != ordered[:-1]][:n]
        rank = np.empty(n, np.int32)
        rank[self.sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.ranks = [rank]  # a rank is the first place of its group in the suffix array
        self._double(new)
        self.isa = np.empty(n, np.int64)
        self.isa[self.sa] = np.arange(n)
        self.lcp = self._lcp()

    def _double(self, new: np.ndarray) -> None:
        n, step = len(self.words), 1
        while True:
            alone = new & np.r_[new[1:], True][:n]
            places = np.flatnonzero(~alone)
            if not len(places):
                return
            rank = self.ranks[-1]
            suffix = self.sa[places]
            beyond = suffix + step
            after = np.where(beyond < self.end[suffix], rank[np.minimum(beyond, n - 1)].astype(np.int64), -1)
            key = rank[suffix].astype(np.int64) * (n + 1) + after + 1
            order = np.argsort(key, kind="stable")  # groups are contiguous, so places stay theirs
            self.sa[places] = suffix[order]
            key = key[order]
            new = new.copy()
            new[places] = np.r_[True, key[1:] != key[:-1]]
            rank = rank.copy()
            rank[self.sa[places]] = np.maximum.accumulate(np.where(new, np.arange(n), 0))[places]
            self.ranks.append(rank)
            step *= 2

    def _lcp(self) -> np.ndarray:
        n = len(self.words)
        lcp = np.zeros(n, np.int64)
        first = self.ranks[0]
        at = np.flatnonzero(first[self.sa[1:]] == first[self.sa[:-1]]) + 1
        a, b = self.sa[at - 1].copy(), self.sa[at].copy()
        found = np.zeros(len(at), np.int64)
        limit = np.minimum(self.end[a], self.end[b]) if len(at) else found
        last = np.maximum(a, b)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            inside = last + found < limit
            same = inside & (rank[np.minimum(a + found, n - 1)] == rank[np.minimum(b + found, n - 1)])
            found[same] += 1 << k
        lcp[at] = found
        return lcp

    def agree(self, a: np.ndarray, b: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whether ``count`` (> 0) words from a and from b, inside their sequences, are equal."""
        level = np.floor(np.log2(count)).astype(np.int64)
        out = np.zeros(len(a), bool)
        for k in np.unique(level):
            if k < len(self.ranks):  # else no two suffixes agree that far
                m = np.flatnonzero(level == k)
                rest, rank = count[m] - (1 << int(k)), self.ranks[k]
                out[m] = (rank[a[m]] == rank[b[m]]) & (rank[a[m] + rest] == rank[b[m] + rest])
        return out


def _smaller(lcp: list[int]) -> tuple[list[int], list[int]]:
    """For every place the nearest smaller value before it and after it."""
    n = len(lcp)
    before, after, open_ = [0] * n, [n] * n, []
    for k, v in enumerate(lcp):
        while open_ and lcp[open_[-1]] > v:
            after[open_.pop()] = k
        before[k] = before[open_[-1]] if open_ and lcp[open_[-1]] == v else (open_[-1] if open_ else -1)
        open_.append(k)
    for k in reversed(open_):  # equal values of one interval end together
        after[k] = n
    for k in range(n - 1, -1, -1):
        e = after[k]
        if e < n and lcp[e] == lcp[k]:
            after[k] = after[e]
    return before, after


def _children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Depth, interval and child [first, last] of all children but one largest per interval.

    ``lcp`` belongs to one sequence, its first value being 0. Of the interval of depth 0, the
    whole sequence, nothing is needed.
    """
    at = np.flatnonzero(lcp > 0)
    before, after = (np.array(x, np.int64) for x in _smaller(lcp.tolist()))
    left, right, depth = before[at], after[at] - 1, lcp[at]
    order = np.lexsort((at, right, left))
    at, left, right, depth = at[order], left[order], right[order], depth[order]
    head = np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])]
    tail = np.r_[head[1:], True]
    # the boundaries of an interval cut it into children: one before each, one after the last
    first = np.where(head, left, np.r_[0, at[:-1]])
    owner = np.cumsum(head) - 1
    firsts = np.r_[first, at[tail]]
    lasts = np.r_[at - 1, right[tail]]
    owners = np.r_[owner, owner[tail]]
    depths, lefts, rights = depth[head], left[head], right[head]
    size = lasts - firsts
    order = np.lexsort((-size, owners))
    largest = np.r_[True, owners[order][1:] != owners[order][:-1]]
    small = order[~largest]
    o = owners[small]
    return depths[o], lefts[o], rights[o], firsts[small], lasts[small]


def _squares(s: Suffixes, lo: int, hi: int, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of squares that end for good and reach far enough to the left."""
    depth, left, right, first, last = _children(s.lcp[lo:hi])
    fits = depth * repeats <= hi - lo
    depth, left, right, first, last = (x[fits] for x in (depth, left + lo, right + lo, first + lo, last + lo))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    size = last - first + 1
    cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) // TESTED)) + 1, len(size)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        n = size[a:b]
        child = np.repeat(np.arange(a, b), n)
        place = first[child] + np.arange(len(child)) - np.repeat(np.cumsum(n) - n, n)
        suffix, d = s.sa[place], depth[child]
        for partner, start in ((suffix + d, suffix), (suffix - d, suffix - d)):
            within = (partner >= lo) & (partner < hi)
            other = s.isa[np.where(within, partner, lo)]
            within &= (other >= left[child]) & (other <= right[child])
            within &= (other < first[child]) | (other > last[child])
            found.append((start[within], d[within]))
    start = np.concatenate([x for x, _ in found] or [np.empty(0, np.int64)])
    root = np.concatenate([x for _, x in found] or [np.empty(0, np.int64)])
    more = np.maximum(least - 2 * root, (repeats - 2) * root)
    room = start - more >= lo
    start, root, more = start[room], root[room], more[room]
    far = more <= 0
    far[~far] = s.agree(start[~far] - more[~far], start[~far] - more[~far] + root[~far], more[~far])
    return start[far], root[far]


def _rotations(words: np.ndarray, start: int, root: int, lo: int) -> int:
    """How far the square can be rotated to the left, not before ``lo``."""
    at, step = start, 64
    while at > lo:
        a = max(lo, at - step)
        other = np.flatnonzero(words[a:at] != words[a + root : at + root])
        if len(other):
            return start - (a + int(other[-1]) + 1)
        at, step = a, step * 2
    return start - lo


def runs_of(words: np.ndarray, begin: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every sequence, by start and period."""
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")
    out: list[list[tuple[int, int, int]]] = [[] for _ in begin]
    if not len(words):
        return out
    s = Suffixes(words, begin)
    needed = max(1, -(-least * (repeats - 1) // repeats))
    ends = np.r_[begin[1:], len(words)]
    filled = np.flatnonzero(ends > begin)
    most = np.maximum.reduceat(s.lcp, begin[filled])
    for doc in filled[most >= needed]:
        lo, hi = int(begin[doc]), int(ends[doc])
        start, root = _squares(s, lo, hi, least, repeats)
        known: dict[int, list[tuple[int, int]]] = {}
        for i, q in sorted(set(zip(start.tolist(), root.tolist())), key=lambda x: (x[1], x[0])):
            ending = known.setdefault(i + 2 * q, [])
            if any(q % p == 0 and first <= i for p, first in ending):
                continue
            ending.append((q, i - _rotations(words, i, q, lo)))
        out[doc] = sorted((first - lo, end - first, q) for end, some in known.items() for q, first in some)
    return out


_FOUND_DDL = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())]
)


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of any run's repetitions."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``.

    Words are what white space (space, 9 to 13) parts. ``runs`` lists start, length and period
    in words of every stretch that has that smallest period, no neighbouring word continues,
    and that has ``least`` words and ``repeats`` periods or more, by start and period.
    ``collapsed`` is the text without the repetitions: the words no run holds after its first
    period, joined by one space. A null text is empty and has neither words nor runs; repeated
    rows and ids are answered each, an empty table gives no rows, further columns are ignored.
    """

    def answer(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        for words in texts:
            for w in words:
                number.setdefault(w, len(number))
        flat = np.array([number[w] for words in texts for w in words], np.int64)
        sizes = np.array([len(words) for words in texts], np.int64)
        runs = runs_of(flat, np.cumsum(sizes) - sizes, least, repeats)
        rows = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in runs]
        kept = [_kept(words, r) for words, r in zip(texts, runs)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(rows, pa.list_(_RUN)), pa.array(kept, pa.binary())],
            schema=_FOUND,
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for part in parts:
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"]):
                words = text.as_py().split()
                if texts and held + len(words) > BATCH_WORDS:
                    yield answer(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
        if texts:
            yield answer(ids, texts)

    found = docs.select("doc_id", utf8().alias("text")).mapInArrow(run, _FOUND_DDL)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest exact length/period; of equal ones the first in order; null if none."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))),
        F.get(F.col(runs), 0),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the tails of a tenth of the texts repeated, as the query's contract wants.

    With h = crc32 of the decimal id, g = floor(h / 10) and n words: where 10 divides h, the
    words from a = g mod n on repeat the first 1 + floor((n - a) / (3 + g mod 8)) of them.
    Texts without a word or an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select(
        "doc_id", "text", F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).cast("long").alias("_g")
    )
    rows = rows.withColumn("_a", F.expr("if(size(_words) > 0, cast(_g % size(_words) as int), null)"))
    rows = rows.withColumn("_p", F.expr("cast(1 + (size(_words) - _a) div (3 + _g % 8) as int)"))
    changed = F.expr(
        "array_join(concat(slice(_words, 1, _a), slice(flatten(array_repeat(slice(_words, _a + 1, _p),"
        " cast((size(_words) - _a) div _p + 1 as int))), 1, size(_words) - _a)), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
