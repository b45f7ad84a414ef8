"""The registered queries that have SQL, against it."""

import pytest

from oracle import connect, differences
from tradeloom.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_give_every_row(spark, name):
    table = "embeddings" if name.startswith("op8") else "conversations" if name.startswith("op11") else "documents"
    read = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    rows = read.select("conv_id").distinct().count() if name.startswith("op11") else read.count()
    got = QUERIES[name](spark, FOLDER).count()
    assert got == (10 * -(-rows // 100) if table == "embeddings" else rows)
