import zlib

import numpy as np

from civitally.llm import langid
from civitally.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language"](spark, SF).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.02


def test_awkward_rows(docs_of, clashing):
    rows = [(i, "the thing and that was here " * 3, "en", "s", 1) for i in range(40)]
    rows += [(100 + i, "der und die das nicht auch ein " * 3, "de", "s", 1) for i in range(40)]
    model = langid.train(docs_of(rows))
    odd = [(1, None), (2, ""), (3, "123 ... !"), (4, "THE and was"), (4, "THE and was"), (None, "nicht und"), (5, "das und " * 40_000), (6, "中文")]
    got = sorted(((r.doc_id, r.lang_pred, r.score == 0) for r in langid.identify(clashing(docs_of(odd)).drop("score", "text_key"), model).collect()), key=repr)
    want = [(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (4, "en", False), (5, "de", False), (None, "de", False)]
    assert sorted([g for g in got if g[0] != 6], key=repr) == sorted(want, key=repr)
    kept = langid.drop_rejected(docs_of(odd), model)
    assert kept.columns == docs_of(odd).columns
    assert not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(docs_of):
    model = langid.train(docs_of([(1, "no label", None, None, None)]))
    assert [(r.lang_pred, r.score) for r in langid.identify(docs_of(["some text"]), model).collect()] == [("und", 0.0)]
    assert langid.identify(docs_of([]), langid.train(docs_of([]))).count() == 0


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Größe und Maß, the end. x " * 50
    whole = langid.bucket_counts(text.encode())
    monkeypatch.setattr(langid, "_CHUNK", 37)
    assert (langid.bucket_counts(text.encode()) == whole).all() and whole.sum() > 0


def verdicts(spark, docs):
    model = langid.train(docs)
    rows = langid.identify(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()
    return {r.doc_id: (r.lang_pred, round(r.score, 6), r.rejected) for r in rows}, model


def test_repeated_rows_change_no_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    once, model = verdicts(spark, docs)
    again, doubled = verdicts(spark, docs.union(docs).union(docs))
    assert once == again and model.threshold == doubled.threshold > 0


def test_gibberish_is_rejected_at_any_size(spark, docs_of):
    for n in (60, 400):
        rows = [(i, "the thing and that was here " * 3, "en", "s", 1) for i in range(n)]
        rows += [(1000 + i, "der und die das nicht auch ein " * 3, "de", "s", 1) for i in range(n)]
        assert langid.train(docs_of(rows)).threshold > 0.1


def test_every_label_is_learned(docs_of, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_ROWS", 200)
    rows = [(i, f"w{chr(97 + i % 20)}x " * 9, f"l{i % 300}", "s", 1) for i in range(1500)]
    assert len(langid.train(docs_of(rows)).languages) == 300


def test_bytes_that_are_no_text():
    assert not langid.has_letter(b"\xff\xfe 12") and langid.has_letter(b"\xff a") and langid.has_letter("ж".encode())


def test_filter_sends_each_text_to_python_once(docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    model = langid.Model(["en"], np.zeros((langid.BUCKETS, 1), np.float32), np.zeros(1, np.float32))
    kept = langid.drop_rejected(docs.withColumnRenamed("text", "Text"), model)
    assert [(r.doc_id, r.Text) for r in kept.collect()] == [(1, "a b")]
    sent = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in sent and "cast(" not in sent
