"""The pipeline against a plain reading of its stages, each on its own input."""

import importlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.llm.language import fit_language_model
from tabprep.llm.pii import BASE, find_pii
from tabprep.llm.shared import read_table

sys.path.insert(0, str(Path(__file__).parent))
from test_decontaminate import brute  # noqa: E402
from test_packing import check  # noqa: E402
from test_simhash import plain_components, plain_print, plain_roots  # noqa: E402

corpus_pipeline = importlib.import_module("corpus_pipeline")


def test_stages_have_the_columns_of_documents(spark, sf, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, corpus, sf).columns == corpus.columns


def test_each_stage_equals_a_plain_reading(spark, sf, corpus):
    stages = dict(corpus_pipeline.STAGES)
    extra = spark.createDataFrame(
        [(9001, None, "en", None, 0), (9002, "", None, "s", 0), (9003, "1 2 3", "en", "s", 5), (9003, "1 2 3", "en", "s", 5)],
        corpus.schema,
    )
    docs = corpus.unionByName(extra).unionByName(corpus.limit(5)).cache()
    rows = docs.collect()
    key = lambda r: (r.doc_id, r.text)

    model = fit_language_model(docs)
    verdicts = model.predict([r.text or "" for r in rows])
    kept = stages["language"](spark, docs, sf).cache()
    assert sorted(map(key, kept.collect())) == sorted(key(r) for r, v in zip(rows, verdicts) if not v[2])
    assert not {9001, 9002, 9003} & {r.doc_id for r in kept.collect()}

    rows = kept.collect()
    one = stages["near_duplicates"](spark, kept, sf).cache()
    components = {(d, p): c for d, p, c in plain_components([(r.doc_id, r.text) for r in rows])}
    expected = {key(r) for r in rows if components[r.doc_id, plain_print(r.text)] == r.doc_id}
    assert sorted(map(key, one.collect())) == sorted(expected)
    prints = {plain_print(r.text) for r in one.collect()}
    assert len(set(plain_roots(prints).values())) == len(prints)

    rows = one.collect()
    clean = stages["decontamination"](spark, one, sf).cache()
    hits = brute([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in read_table(spark, sf, "benchmark").collect()])
    assert sorted(map(key, clean.collect())) == sorted(key(r) for r in rows if not hits[r.doc_id][1])

    private = stages["personal_data"](spark, clean, sf).cache()
    assert private.count() == clean.count()
    spans = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    assert find_pii(private).where(F.size(spans) > 0).count() == 0
    untouched = {r.doc_id for r in find_pii(clean).where(F.size("spans") == 0).select("doc_id").collect()}
    before, after = ({key(r) for r in f.collect() if r.doc_id in untouched} for f in (clean, private))
    assert before == after

    packed = stages["packing"](spark, private, sf).collect()
    check(packed, [key(r) for r in private.collect()], 1024)
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in packed)


def test_run_and_empty_table(spark, sf, corpus):
    assert corpus_pipeline.run(spark, sf).count() > 0
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "personal_data"])
def test_clashing_column_names(spark, sf, corpus, name):
    docs = corpus.selectExpr("*", "1 AS fingerprint", "'x' AS spans", "2 AS component_id", "3 AS `odd.name`", "4 AS __own", "5 AS __id", "6 AS own")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, sf).columns == docs.columns
