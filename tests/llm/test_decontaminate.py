import re
from hashlib import sha256

import pytest

from civitally.llm import decontaminate as d
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        found -= {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


@pytest.mark.parametrize("pass_words", [d.PASS_WORDS, 100])
def test_query_against_every_window(spark, documents, monkeypatch, pass_words):
    """Several passes over a cut benchmark give the same rows as one."""
    monkeypatch.setattr(d, "PASS_WORDS", pass_words)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = expected([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows(QUERIES["op6_decontaminate"](spark, SF)) == want
    assert any(r[5] for r in want) and not all(r[5] for r in want)


AWKWARD = [(1, None), (2, ""), (3, "a b c d e f g h i j k"), (3, "a b c d e f g h i j k"), (None, "x A B C D E F G H I J"),
           (4, "solo"), (5, "go go go go go go go go go go go go"), (6, "é È été"), (7, "a-b c1 " * 30_000)]
ITEMS = [(10, "A b c d e f g h i j k l"), (9, "solo"), (8, "a b c d e f g h i j"), (7, None), (6, "..."), (None, "x a"),
         (5, "go go go go go go go go go go go"), (4, "été"), (3, "b c1 a"), (3, "b c1 a")]


def test_awkward_rows(spark, docs_of, clashing, ws):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(d.decontaminate(clashing(docs_of(AWKWARD)), bench, ws)) == expected(AWKWARD, ITEMS)


def test_empty_tables(spark, docs_of, ws):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(d.decontaminate(docs_of(AWKWARD), none, ws)) == expected(AWKWARD, [])
    assert d.decontaminate(docs_of([]), spark.createDataFrame(ITEMS, none.schema), ws).count() == 0


def test_only_clean_rows_stay(spark, docs_of, ws):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(AWKWARD)
    kept = d.drop_contaminated(docs, bench, ws)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_items_without_an_id_hit(spark, docs_of, ws):
    bench = spark.createDataFrame([(None, "a b c d e f g h i j"), (None, "k l"), (1, "k l")], "item_id long, text string")
    docs = [(1, "x a b c d e f g h i j y"), (2, "k l"), (3, "a b")]
    got = rows(d.decontaminate(docs_of(docs), bench, ws))
    assert [(r[0], r[2], r[3], r[5]) for r in got] == [(1, 10, 0, True), (2, 2, 1, True), (3, 0, 0, False)]
