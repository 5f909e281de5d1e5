import pytest
from plain import awkward, empty

import __spark_entry__ as entry_module
import corpus_pipeline
from compare import connect, difference
from gaugeworks.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry_module.queries().keys()


def test_stages_keep_the_columns(spark, path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = []
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_DIR)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(path(name))
        docs = spark.read.parquet(path(name))
        sizes.append(docs.count())
    assert all(sizes) and sizes[0] >= sizes[1] == sizes[2]


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_take_awkward_tables(spark, path, make):
    docs = make(spark)
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_DIR)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(path(name))
        docs = spark.read.schema(out.schema).parquet(path(name))
