"""The pipeline against what each stage has to do, by plain Python, on its own input."""

import re

import pytest
from pyspark.sql import functions as F
from test_decontaminate import expected as hits
from test_packing import check as check_packing
from test_pii import FORMATS, fine
from test_simhash import expected as groups

import __spark_entry__ as contract
import corpus_pipeline
from civitally.llm import langid

SF = "/root/testdata/sf0.001"


def redacted(text):
    """Base formats only: the made documents hold no others."""
    found = sorted(
        (m.start(), m.end(), kind) for kind, p in FORMATS.items() for m in re.finditer(p, text or "") if fine(kind, m[0])
    )
    out, at = "", 0
    for start, end, kind in found:
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + (text or "")[at:] if text is not None else None


def test_every_stage_on_its_own_input(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "benchmark", "personal_data", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns

    def step(name, docs):
        out = stages[name](spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    named = langid.identify(docs, langid.train(docs)).collect()
    kept = step("language", docs)
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in named if not r.rejected)
    assert kept.count() >= 0.97 * docs.count()

    single = step("near_duplicates", kept)
    texts = {r.doc_id: r.text for r in kept.collect()}
    least = {c for _, _, c in groups(list(texts.items()))}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(least)

    clean = step("benchmark", single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = [d for d, *_, bad in hits([(d, texts[d]) for d in least], items) if not bad]
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == sorted(want)
    assert len(want) < len(least)

    private = step("personal_data", clean)
    assert private.columns == columns
    rows = private.collect()
    assert {r.doc_id: r.text for r in rows} == {d: redacted(texts[d]) for d in want}
    assert all(r.n_chars == len(r.text) for r in rows)

    n, bound = check_packing(step("packing", private).collect(), [(r.doc_id, r.text) for r in rows])
    assert n <= bound + 1


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES[:-1]], ids=lambda s: s[0])
def test_stages_stand_awkward_rows(spark, docs_of, clashing, stage):
    rows = [(1, None), (2, ""), (None, "a plain text of words"), (3, "mail a@b.cc now " * 3), (3, "mail a@b.cc now " * 3), (None, None), (4, "x " * 30_000)]
    docs = clashing(docs_of(rows)).withColumns({c: F.lit(1) for c in ("row", "rejected", "lang_pred", "spans", "items", "pii", "new")})
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns
    assert out.count() <= len(rows)
    assert stage[1](spark, docs_of([]), SF).count() == 0


def test_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [sum(q.startswith(f"op{n}_") for q in contract.queries()) for n in range(1, 11)] == [1] * 10
