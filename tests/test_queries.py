"""Entry contract and a sample of registered queries against DuckDB at sf0.001.

The full comparison of every query is ``python tools/oracle_check.py``.
"""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as ent  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_of_the_library_has_an_oracle():
    from tidemark.plans.catalog import ORACLE, QUERIES
    own = {k for k, f in QUERIES.items() if f.__module__.startswith("tidemark.plans")}
    assert own and own <= set(ORACLE)
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry(spark):
    df = ent.entry(spark)
    assert set(df.columns) == {"country", "order_date", "orders_count", "books_count"}
    assert df.count() > 0


@pytest.mark.parametrize("name", ["countries_stats", "auto_cdc_scd2", "scd2_price_history",
                                  "lateral_explode_join", "change_feed", "stream_stream_join",
                                  "authors_window_stream", "delete_propagation", "schema_add_columns",
                                  "apply_in_pandas_avg", "mask_udf", "pipeline_rerun",
                                  "full_refresh_protected", "append_only_table", "table_changes_since", "current_catalog"])
def test_query_matches_oracle(spark, name):
    line, ok = compare(spark, SF, name, ent.queries()[name], ent.oracle_sql()[name], duck(SF))
    assert ok, line


def test_pipeline_builds_every_table(spark):
    from tidemark.plans import pipeline
    tables = pipeline.run(spark, SF)
    assert set(tables) >= {"bronze", "customers_silver", "orders_silver", "books_silver",
                           "current_books", "customers_orders", "books_sales", "countries_stats", "authors_stats"}
    assert spark.read.parquet(tables["countries_stats"]).count() > 0


def test_full_refresh_keeps_bronze(spark):
    from tidemark.plans import pipeline
    from tidemark.session import generation
    first = pipeline.run(spark, SF)
    g = pipeline.full_refresh(spark, SF)
    assert generation(spark, SF) == g
    second = pipeline.run(spark, SF)
    assert second["bronze"] == first["bronze"]            # protected: same data, no re-ingest
    assert second["customers_silver"] != first["customers_silver"]   # rebuilt in a new folder
    assert spark.read.parquet(second["countries_stats"]).count() == \
        spark.read.parquet(first["countries_stats"]).count()
