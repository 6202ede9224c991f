import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitally.llm import pivots
from civitally.llm.queries import QUERIES
from civitally.llm.slots import Best

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, asked, best):
    """Inner products of all pairs, in Python integers; rows are told apart by their place."""
    whole = [
        (i, v, [math.floor(256 * x) for x in e])
        for i, (v, e) in enumerate(rows)
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, query, q in whole:
        if query is None or not asked(query):
            continue
        scored = [(-sum(a * b for a, b in zip(q, x)), v is None, v or 0, v) for j, v, x in whole if j != i]
        for rank, (score, _, _, v) in enumerate(sorted(scored)[:best], 1):
            out.append((query, rank, v, -score))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found(QUERIES["op12_nearest"](spark, SF)) == brute(rows, lambda v: v % 50 == 0, 5)


def made(n, dims, seed, scale=1.0, centres=0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dims)) * scale
    if centres:
        x = rnd.normal(size=(centres, dims))[rnd.integers(0, centres, n)] * 20 + x
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("scale, centres", [(1.0, 0), (0.05, 6), (1e5, 0), (3e-3, 0)])
def test_vectors_of_any_length(spark, ws, monkeypatch, scale, centres):
    monkeypatch.setattr(pivots, "BLOCK_ROWS", 40)
    rows = made(900, 6, 5, scale, centres)
    got = pivots.nearest(spark.createDataFrame(rows, SCHEMA).repartition(7), F.col("vec_id") % 9 == 0, 4, ws)
    assert found(got) == brute(rows, lambda v: v % 9 == 0, 4)


def test_awkward_rows(spark, ws):
    hot = [(1000 + i, [1.0, 0.0, 0.0]) for i in range(700)]
    rows = [
        (0, None), (50, []), (100, [1.0, None, 2.0]), (150, [math.nan, 1.0, 1.0]), (200, [math.inf, 0.0, 0.0]),
        (250, [0.5, 0.25, -0.1]), (250, [0.5, 0.25, -0.1]), (300, [0.0, 0.0, 0.0]), (350, [-1.0, -2.0, -3.0]), (None, [9.0, 9.0, 9.0]),
        (None, [9.0, 9.0, 9.0]), (400, [2.0]), (7, [0.003, 0.004, -0.004]), (-50, [0.1, 0.2, 0.3]), *hot,
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("uid", "v", "asked", "cell", "block")})
    got = found(pivots.nearest(df, F.col("vec_id") % 50 == 0, 5, ws))
    assert got == brute(rows, lambda v: v % 50 == 0, 5)


def test_few_rows_and_none(spark, ws):
    asked = F.col("vec_id") % 50 == 0
    one = spark.createDataFrame([(0, [1.0])], SCHEMA)
    assert found(pivots.nearest(one, asked, 5, ws)) == []
    none = spark.createDataFrame([], SCHEMA)
    assert found(pivots.nearest(none, asked, 5, ws)) == []
    two = spark.createDataFrame([(0, [1.0]), (50, [-1.0])], SCHEMA)
    assert found(pivots.nearest(two, asked, 5, ws)) == [(0, 1, 50, -65536), (50, 1, 0, -65536)]


def test_clustered_rows_are_ruled_out(monkeypatch):
    """With structure in the vectors, few rows are evaluated and the answer stays exact."""
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(40, 16)) * 400
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rnd.normal(size=(4000, 16)) * 4).astype("<i4")
    chosen = pivots.far_apart(vectors[::7], 16)
    apart = pivots.distances(vectors, chosen).astype(np.float32)
    blocks = [
        {"uids": np.arange(a, a + 100).tobytes(), "ids": np.arange(a, a + 100).tobytes(),
         "vectors": vectors[a : a + 100].tobytes(), "distances": apart[a : a + 100].tobytes()}
        for a in range(0, 4000, 100)
    ]
    seen = []
    monkeypatch.setattr(Best, "add", lambda self, s, d, add=Best.add: (seen.append(len(s)), add(self, s, d))[1])
    search = pivots._searcher(blocks, chosen, 16, "<i4", True, 5)
    answers = search([{"uid": u, "vector": vectors[u].tobytes()} for u in range(0, 4000, 500)]).to_pydict()
    products = vectors.astype(np.int64) @ vectors.astype(np.int64).T
    for u in range(0, 4000, 500):
        want = sorted((-products[u, j], j) for j in range(4000) if j != u)[:5]
        got = [(-s, v) for q, v, s in zip(*answers.values()) if q == u]
        assert sorted(got) == want
    assert sum(seen) < 8 * 4000 / 3


def test_best_keeps_ties_by_id():
    best, rnd = Best(3), random.Random(4)
    rows = [(rnd.randint(0, 4), i) for i in range(50)]
    rnd.shuffle(rows)
    for score, i in rows:
        best.add(np.array([score]), np.array([i]))
    assert list(zip(best.score.tolist(), best.doc.tolist())) == sorted(rows, key=lambda r: (-r[0], r[1]))[:3]
