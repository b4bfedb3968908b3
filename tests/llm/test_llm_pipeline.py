"""The pipeline against plain versions of its stages, and the registered queries."""

from collections import Counter

import brute
import corpus_pipeline
import fixtures
import pytest
from conftest import SMALL

import __spark_entry__
from riskframe.llm import queries
from riskframe.llm.frames import table


def test_every_query_is_registered():
    known = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in known) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in known and len(corpus_pipeline.STAGES) == 5
    assert set(__spark_entry__.oracle_sql()) <= set(known)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after every stage over the small tables."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, docs, SMALL), "stage")
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_columns(spark, stages):
    columns = table(spark, SMALL, "documents").columns
    assert all(c == columns for _, _, _, c in stages[:-1])


def test_quality_stage(spark, stages):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    verdicts = {r.doc_id: r.kept for r in queries.all_queries()["op4_quality_rules"](spark, SMALL).collect()}
    assert kept == {d for d, k in verdicts.items() if k}
    assert not any(brute.quality(r.text)[-1] for r in after) and 0 < len(after) < len(before)


def test_near_dedup_stage(stages):
    _, before, after, _ = stages[1]
    groups = brute.groups([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(d for d, (_, top) in groups.items() if d == top)


def test_decontamination_stage(spark, stages):
    _, before, after, _ = stages[2]
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in before], items)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, f in zip(before, found) if not f[-1])


def test_secrets_stage(stages):
    _, before, after, _ = stages[3]
    old = {r.doc_id: r for r in before}
    assert set(old) == {r.doc_id for r in after} and len(before) == len(after)
    for r in after:
        assert brute.base_secrets(r.text)[:3] == (0, 0, 0) and r.n_chars == len(r.text)
        if brute.base_secrets(old[r.doc_id].text)[:3] == (0, 0, 0) and "<secret>" not in r.text:
            assert r.text == old[r.doc_id].text


def test_encoding_stage(stages):
    _, before, after, _ = stages[4]
    model = brute.tokenizer()
    assert Counter(map(tuple, after)) == Counter((r.doc_id, *brute.tokens(r.text, model)) for r in before)


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(rows) == Counter(stages[-1][2])


def test_odd_documents(spark, tmp_path):
    """Nulls, blanks, repeats, clashing columns and an empty table pass through all stages."""
    for name, docs in (("odd", fixtures.documents(spark)[0]), ("none", fixtures.none(spark))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "c d e f")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.stored(stage(spark, kept, folder), "stage")
            assert kept.columns == docs.columns
        assert (corpus_pipeline.run(spark, folder).count() > 0) == (name == "odd")
