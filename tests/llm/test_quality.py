import re
from collections import Counter

import numpy as np

from civitally.llm import quality
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def found(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((d, *counts(t)) for d, t in rows), key=repr)


def test_query_against_counting(spark, documents):
    df = QUERIES["op10_quality"](spark, SF)
    assert found(df) == expected([(r.doc_id, r.text) for r in documents.collect()])
    assert not [r for r in df.collect() if r.kept and r.base_failed]


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c a b c"), (5, "a b c d a b c"), (5, "a b c d a b c"), (None, "x\n\nx\n x\nx\r\nx"),
    (6, "é 😀#*$ \x0b\x0c a\x85b\xa0c"), (7, "w " * 30_000), (8, " ".join(map(str, range(30_000)))), (9, "one two"), (10, "\n".join(["l m"] * 9)),
]


def test_awkward_rows(docs_of, clashing, ws):
    assert found(quality.quality(clashing(docs_of(AWKWARD)).drop("block"), ws)) == expected(AWKWARD)
    odd = [(1, "a " * 60, None, None, None), (2, "b c", None, "s", None)]
    assert len(quality.quality(docs_of(odd), ws).collect()) == 2


def test_empty_table(docs_of, ws):
    assert quality.quality(docs_of([]), ws).count() == 0


def test_outliers_of_their_own_group(docs_of, ws):
    """Junk goes, the bulk stays, though each group has its own normal."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    rows = []
    for i in range(300):
        length = 4 if i % 2 else 9
        text = " ".join(word(max(1, length + rng.integers(-2, 3))) for _ in range(rng.integers(60, 200)))
        rows.append((i, text, "en" if i % 2 else "de", "s", None))
    for i in range(20):
        rows.append((1000 + i, " ".join(word(4) + "***" for _ in range(80)), "en", "s", None))
    kept = {r.doc_id: r.kept for r in quality.quality(docs_of(rows), ws).collect()}
    assert not any(kept[1000 + i] for i in range(20))
    assert sum(kept[i] for i in range(300)) >= 298


def test_factor_gives_mahalanobis_distances(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(2, 1, (500, 4)) @ rng.normal(0, 1, (4, 4)) * quality.UNIT).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], ["group", *quality.FEATURES])
    sums = {"n": len(x), **{f"s_{i}": int(x[:, i].sum()) for i in range(4)}}
    sums |= {f"q_{i}_{j}": int((x[:, i] * x[:, j]).sum()) for i in range(4) for j in range(i + 1)}
    moments = spark.createDataFrame([("g", *sums.values())], ["group", *sums])
    got = rows.join(quality._factor(moments), "group").select(quality._distance()).collect()
    y = x / quality.UNIT
    cov = np.cov(y.T, bias=True) + np.diag([v**2 for v in quality.FEATURES.values()])
    want = np.einsum("ni,ij,nj->n", y - y.mean(0), np.linalg.inv(cov), y - y.mean(0))
    assert np.allclose(sorted(r[0] for r in got), sorted(want))
