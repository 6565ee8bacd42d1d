import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare, oracle

from .cases import DOCS, corpus, documents, prose

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()])
def test_query(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in entry.oracle_sql():
        assert compare(df, oracle(FOLDER), entry.oracle_sql()[name]) == []
    elif name != "op8_warc_index":
        assert df.count() >= spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def _folder(spark, tmp_path):
    rng = random.Random(6)
    items = [(k, prose(rng, 25)) for k in range(5)]
    rows = corpus() + [(500 + k, prose(rng, 60) + "\n" + items[k % 5][1], "en", "s", 1) for k in range(10)] + [(600 + k, "\n".join(prose(rng, 70) for _ in range(3)), "en", "s", 1) for k in range(10)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, items


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rows, items = _folder(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    ids = [{r[0] for r in rows}]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/stage{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
        if name == "decontamination":
            assert not any(item in r.text for r in docs.collect() for _, item in items)
    assert set(range(600, 610)) <= ids[-1]
    # the other five lost the passage as a repeated line
    assert not set(range(500, 505)) & ids[-1]
    pieces = docs.collect()
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_run_applies_all_stages(spark, tmp_path):
    _folder(spark, tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).where("doc_id between 600 and 609").select("doc_id").distinct().count() == 10


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_bears_no_rows(spark, tmp_path, name):
    _folder(spark, tmp_path)
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, documents(spark).limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_extra_columns_of_any_name(spark, tmp_path, name):
    _folder(spark, tmp_path)
    docs = documents(spark, extra=True)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    assert all(r.uid == r.lang and r.region == r.lang and r.held == r.lang for r in found.collect())
