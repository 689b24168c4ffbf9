"""The stages one by one on the given tables and on awkward rows."""
import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from compare import connect, differences
from edge import documents, empty
from sluice.llm.oracle import ORACLE
from sluice.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_takes_awkward_rows(spark, name, stage):
    docs = documents(spark)
    got = stage(spark, docs, SF)
    if name != "sharding":
        assert got.columns == docs.columns
        assert stage(spark, empty(spark), SF).columns == docs.columns
    assert got.count() > 0
    assert stage(spark, empty(spark), SF).count() == 0


def test_near_duplicates_leave_one(spark):
    docs = documents(spark)
    got = pipeline.keep_one_of_similar(spark, docs, SF).collect()
    left = Counter(r.doc_id for r in got)
    assert all(n == 1 for d, n in left.items() if d is not None)
    texts = Counter(re.sub(r"\s+", " ", (r.text or "").lower()).strip() for r in got if r.doc_id is not None and len((r.text or "").split()) > 4)
    assert max(texts.values()) == 1
    assert set(left) <= {r.doc_id for r in docs.collect()}


def test_run(spark):
    rows = pipeline.run(spark, SF).collect()
    assert rows and {r.shard for r in rows} == set(range(16)) and Counter((r.shard, r.slot) for r in rows).most_common(1)[0][1] == 1
    known = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} <= known and max(Counter(r.doc_id for r in rows).values()) <= 3
