import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np

from civitally.llm import runs
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def brute(words, least=24, repeats=3):
    """Runs from the stretches in which words q apart are equal, for every q."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x, found = np.array([number[w] for w in words], np.int64), {}
    for q in range(1, len(x) // repeats + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        change = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(change[::2].tolist(), change[1::2].tolist()):
            if e - s + q >= max(least, repeats * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def contract(doc_id, text):
    words = split(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_every_period(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = QUERIES["op13_runs"](spark, SF)
    assert df.columns == COLUMNS
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = sorted((contract(*r) for r in rows), key=repr)
    assert got == want
    assert sum(r[1] for r in want) > 50


def test_tails_of_a_tenth(spark, docs_of):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 70))) for i in range(400)] + [(None, "a b"), (10**18, None)]
    got = {r.doc_id: r.text for r in runs.with_repeated_tails(docs_of(rows)).collect()}
    changed = 0
    for doc_id, text in rows:
        h = zlib.crc32(str(doc_id).encode())
        words = split(text)
        if doc_id is not None and h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            text = " ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))])
            changed += 1
        assert got[doc_id] == text
    assert changed > 20


def test_runs_of_random_sequences():
    rnd = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(0, 4)):
            words = []
            while len(words) < rnd.randint(0, 70):
                part = [rnd.randint(0, 3) for _ in range(rnd.randint(1, 5))]
                words += part * rnd.randint(1, 9)
            texts.append(words)
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.array([w for t in texts for w in t], np.int64)
        for least, repeats in ((24, 3), (1, 2), (9, 4)):
            got = runs.runs_of(flat, np.cumsum(sizes) - sizes, least, repeats)
            assert got == [brute(t, least, repeats) for t in texts]


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\x0b "), (4, "la " * 23), (5, "la " * 24), (6, "la " * 5000), (7, "a b c " * 8), (7, "a b c " * 8),
    (None, "x " + "é 😀 " * 30 + "é y"), (8, "one two\x0cthree " * 40 + "end " + "one two three " * 40), (9, "A a " * 20),
    (10, " ".join(f"w{i % 997}" for i in range(60_000))), (11, "a " * 30 + "b " * 30 + ("a " * 30 + "b " * 30) * 4),
]


def test_awkward_rows(spark, docs_of, clashing):
    found = runs.periodic_runs(clashing(docs_of(AWKWARD)).withColumn("runs", runs.F.lit(1)))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    want = []
    for doc_id, text in AWKWARD:
        words = split(text)
        r = brute(words)
        drop = {i for s, length, q in r for i in range(s + q, s + length)}
        want.append((doc_id, len(words), r, " ".join(w for i, w in enumerate(words) if i not in drop)))
    assert got == sorted(want, key=repr)
    assert runs.periodic_runs(docs_of([])).count() == 0


def test_a_collapsed_text_keeps_one_period(docs_of):
    r = runs.periodic_runs(docs_of(["start " + "buy now " * 50 + "stop"])).first()
    assert (r.collapsed, [tuple(x) for x in r.runs]) == ("start buy now stop", [(1, 100, 2)])
