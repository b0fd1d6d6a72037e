"""The pipeline and its registration."""
from collections import defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ripplelake.llm import queries
from ripplelake.llm.common import cut, table
from tools.check_oracle import compare, connect


def test_registration():
    names = set(entry.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "quality classifier", "n-gram Jaccard join", "mixing", "best-fit packing"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    df = queries.queries()[name](spark, SF["0.001"])
    assert compare(df, connect(SF["0.001"]), queries.oracle_sql()[name]) == []


def test_stages(spark):
    """Every stage keeps the columns and follows its operator's verdicts; clean documents stay."""
    d = SF["0.001"]
    docs = table(spark, d, "documents").withColumn("kept", F.lit("x"))
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, d), "stage")
        now = {r.doc_id for r in docs.collect()}
        assert now <= ids
        if name != "best-fit packing":
            assert docs.columns == columns
        seen[name], ids = now, now
    labels = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    after = seen["quality classifier"]
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in after for i in good) / len(good) > 0.9
    assert sum(i in after for i, q in labels.items() if q == 0) <= 2
    ends = defaultdict(int)
    for r in docs.collect():
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 4096


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF["0.001"], "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF["0.001"]), "stage")
    assert docs.count() == 0
