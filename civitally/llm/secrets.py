"""Secret scan: fixed formats and windowed entropy of candidate strings.

Base spans follow three fixed formats. The method adds strings that look random: a window
of ``WINDOW`` characters slides over each candidate string, the counts of its characters
are updated by one in and one out, and so is the entropy, which is a sum over counts. The
limit depends on the character class of the string, since sixteen hex digits cannot be as
surprising as sixty-four characters. Allow-listed shapes are suppressed before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
KINDS = ("assign", "access", "hex", "entropy")

# The formats of the base spans.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_VALUE = 8

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)

#: Character class and the least bits per character of a window that count as random.
CLASSES = (
    (re.compile(r"[0-9]+"), 9.9),  # numbers are never secrets by themselves
    (re.compile(r"[0-9a-fA-F-]+"), 3.2),
    (re.compile(r"[0-9a-z_-]+|[0-9A-Z_-]+"), 3.5),
    (re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
)

#: Shapes that are random by nature or mere writing, and no secrets.
ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUID
        # every part in one way only, so that long paths take linear time
        r"[A-Z]?[a-z]+(?:[-_/=+][A-Z]?[a-z]+)*",  # words, joined words and paths of words
        r"[A-Z]+(?:[-_/=+][A-Z]+)*",  # constant names
        r"[-_=+/]+",  # rules
        r".*(EXAMPLE|example|XXXX|xxxx).*",  # placeholders
    )
)

_TERM = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_entropy", pa.int64())]
)


def windows_above(text: str, limit: float) -> Iterator[tuple[int, int]]:
    """Maximal runs covered by windows whose entropy per character reaches ``limit``."""
    counts: dict[str, int] = {}
    total, start, end = 0.0, None, 0
    for at, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERM[n + 1] - _TERM[n]
        first = at - WINDOW + 1
        if first < 0:
            continue
        if log2(WINDOW) - total / WINDOW >= limit:
            if start is not None and first > end:
                yield start, end
                start = None
            start, end = first if start is None else start, at + 1
        old = text[first]
        n = counts[old]
        counts[old] = n - 1
        total += _TERM[n - 1] - _TERM[n]
    if start is not None:
        yield start, end


def random_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of candidate strings that windowed entropy finds random."""
    for m in CANDIDATE.finditer(text):
        string = m[0]
        if any(p.fullmatch(string) for p in ALLOWED):
            continue
        limit = next(bits for p, bits in CLASSES if p.fullmatch(string))
        for start, end in windows_above(string, limit):
            yield m.start() + start, m.start() + end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed formats, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def scan_text(text: str) -> tuple:
    base = base_spans(text)
    added, at, reach = [], 0, 0
    for start, end in random_spans(text):  # both in order; a span that meets a base one is dropped
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start:
            added.append((start, 3, end))
    kinds = [k for _, k, _ in base]
    return (
        *(kinds.count(k) for k in range(3)),
        sha256(_written(base).encode()).hexdigest(),
        _written(sorted(base + added)),
        len(added),
    )


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of secrets per row of ``docs``.

    A null text is empty and has none; positions are code points. Repeated rows are
    scanned each, an empty table gives no rows, further columns are ignored.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [scan_text(t.as_py()) for t in part["text"]]
            columns = list(zip(*found)) or [()] * 6
            arrays = [part["doc_id"], *(pa.array(c, f.type) for c, f in zip(columns, list(_FOUND)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=_FOUND)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long",
    )
