import random

import xxhash

from civitally.llm import simhash
from civitally.llm.components import components
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                group[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def expected(rows):
    prints = [slow_print(t) for _, t in rows]
    groups = slow_groups(prints)
    least = {}
    for (d, _), g in zip(rows, groups):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return sorted(((d, p, least.get(g)) for (d, _), p, g in zip(rows, prints, groups)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=repr)


def test_query_against_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op4_simhash"](spark, SF).collect()
    want = [(d, f"{p:016x}", c) for d, p, c in expected(rows)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_awkward_rows(docs_of, clashing, ws):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "one two"), (5, "one two"),
            (6, "é É \x85 x"), (None, "one two three"), (7, "one two three"), (8, "w " * 40_000), (None, "alone here now then")]
    assert found(simhash.simhash_groups(clashing(docs_of(rows)), ws)) == expected(rows)


def test_empty_table(docs_of, ws):
    assert simhash.simhash_groups(docs_of([]), ws).count() == 0
    assert simhash.keep_one_per_group(docs_of([]), ws).count() == 0


def test_dense_cluster_in_small_blocks(spark, ws):
    """A hot posting cut into chunks keeps every connection."""
    rng = random.Random(4)
    prints, at = [rng.getrandbits(64)], 0
    while len(prints) < 150:  # chains and clusters
        base = rng.choice(prints) if rng.random() < 0.9 else rng.getrandbits(64)
        for _ in range(rng.randint(1, 4)):
            base ^= 1 << rng.randrange(64)
        prints.append(base)
    prints = list(dict.fromkeys(prints))
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=16)
    found = {r.node: r.component for r in components(edges, ws).collect()}
    got = [found.get(p, p) for p in signed]
    want = slow_groups(prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_stays_per_group(docs_of, ws):
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (9, "x y z q r s t u"), (None, None), (4, "")]
    kept = simhash.keep_one_per_group(docs_of(rows), ws)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "a b c d e f"), (4, ""), (9, "x y z q r s t u")]


def test_unlike_documents_stay_whatever_their_ids(docs_of, ws):
    unlike = [" ".join(f"w{k}x{i}" for i in range(12)) for k in range(8)]
    rows = [(None, t) for t in unlike[:5]] + [(7, t) for t in unlike[5:]] + [(None, unlike[0]), (7, unlike[5]), (8, unlike[6]), (None, unlike[6])]
    kept = simhash.keep_one_per_group(docs_of(rows), ws)
    want = [(None, t) for t in unlike[:5]] + [(7, t) for t in unlike[5:]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_long_path(spark, ws):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges, ws).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
