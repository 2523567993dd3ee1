"""Queries that SQL can express equal it (sf0.001); every query runs on its whole table."""

import os

import duckdb
import pytest

from minutelake.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data absent")
WHOLE = {"op1_ngram_jaccard_join": "documents", "op2_token_counts": "documents", "op4_language_id": "documents", "op6_url_filters": "pages", "op7_mixing": "documents", "op8_warc": "pages", "op10_quality_rules": "documents", "language_id_pages": "pages"}


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_query_matches_its_sql(spark, key):
    df = registry.QUERIES[key](spark, SF)
    with duckdb.connect() as c:
        for t in ("documents", "embeddings", "pages", "conversations"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        wanted = c.sql(registry.ORACLE[key])
        assert sorted(wanted.columns) == sorted(df.columns)
        rows = wanted.select(*sorted(df.columns)).fetchall()
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("key", sorted(WHOLE))
def test_a_row_for_each_row_of_the_table(spark, key):
    assert registry.QUERIES[key](spark, SF).count() == spark.read.parquet(f"{SF}/{WHOLE[key]}.parquet").count()
