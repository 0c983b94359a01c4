"""Gold views."""

from __future__ import annotations

import pytest
from conftest import rows

from tierlake import (
    SchemaError,
    bridged_join_sql,
    direct_join_sql,
    preview,
    publish_view,
    read_table,
    read_view,
    upsert,
)
from tierlake.functions.storage import unique_name


@pytest.fixture
def tables(spark, path):
    a, b, m = (unique_name(p) for p in ("a_", "b_", "m_"))
    people, profiles = "id INT, name STRING, value DOUBLE", "_id STRING, name STRING, value DOUBLE"
    put(spark, a, f"{path}/a", [(1, "Alice", 10.5), (2, "Bob", 20.0), (3, "Eve", 1.0)], people, "id", 4)
    put(spark, b, f"{path}/b", [("1", "Alice", 10.5), ("2", "Bob", 20.0), ("64f0", "X", 0.0)], profiles, "_id")
    put(spark, m, f"{path}/m", [(1, "2"), (2, "1"), (3, "none")], "sqlserver_id INT, mongodb_id STRING", "sqlserver_id")
    return a, b, m


def put(spark, name, path, data, schema, key, buckets=None):
    upsert(spark, name, path, spark.createDataFrame(data, schema), [key], buckets=buckets, table_format="parquet")


def test_direct_join(spark, tables):
    out = spark.sql(direct_join_sql(spark, *tables[:2]))
    assert out.columns == ["a_id", "a_name", "a_value", "b__id", "b_name", "b_value"]
    assert rows(out) == [(1, "Alice", 10.5, "1", "Alice", 10.5), (2, "Bob", 20.0, "2", "Bob", 20.0)]


def test_bridged_join(spark, tables):
    a, b, m = tables
    out = spark.sql(bridged_join_sql(spark, m, a, b))
    assert out.columns[:3] == ["sqlserver_id", "mongodb_id", "a_id"]
    assert rows(out.select("a_name", "b_name")) == [("Alice", "Bob"), ("Bob", "Alice")]


def test_durable_view_is_seen_by_other_sessions_and_follows_its_tables(spark, tables, path):
    a, b, _ = tables
    view = unique_name("gold_")
    publish_view(spark, view, direct_join_sql(spark, a, b))
    put(spark, a, f"{path}/a", [(2, "Bobby", 21.0)], "id INT, name STRING, value DOUBLE", "id")
    put(spark, b, f"{path}/b", [("3", "Eve", 3.0)], "_id STRING, name STRING, value DOUBLE", "_id")
    other = spark.newSession()
    assert rows(read_view(other, view).select("a_name")) == [("Alice",), ("Bobby",), ("Eve",)]
    assert rows(read_table(spark, view).select("a_id")) == [(1,), (2,), (3,)]


def test_temporary_view_is_this_sessions_own(spark, tables):
    view = unique_name("gold_")
    publish_view(spark, view, direct_join_sql(spark, *tables[:2]), temporary=True)
    assert read_view(spark, view).count() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        read_view(spark.newSession(), view).count()


def test_new_columns_do_not_change_a_published_view(spark, tables, path):
    a, b, _ = tables
    view = unique_name("gold_")
    publish_view(spark, view, direct_join_sql(spark, a, b))
    put(spark, a, f"{path}/a", [(1, "Alice", 10.5, "n")], "id INT, name STRING, value DOUBLE, extra STRING", "id")
    assert read_view(spark, view).columns == ["a_id", "a_name", "a_value", "b__id", "b_name", "b_value"]
    publish_view(spark, view, direct_join_sql(spark, a, b))
    assert "a_extra" in read_view(spark, view).columns


def test_colliding_names_are_refused(spark, tables):
    with pytest.raises(SchemaError, match="several columns"):
        direct_join_sql(spark, *tables[:2], prefixes=("", ""))


def test_preview_is_ordered_and_bounded(spark):
    df = spark.range(100).selectExpr("99 - id AS `a.b`")
    assert [r[0] for r in preview(df, ["a.b"]).collect()] == list(range(20))
    assert "TakeOrderedAndProject" in preview(df, ["a.b"])._jdf.queryExecution().executedPlan().toString()


def test_view_prunes_columns_and_pushes_filters(spark, tables):
    view = unique_name("gold_")
    publish_view(spark, view, direct_join_sql(spark, *tables[:2]))
    names = read_view(spark, view).filter("a_value > 15").select("a_name")
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,15.0)" in plan and "ReadSchema: struct<_id:string>" in plan


def test_same_typed_keys_are_not_cast(spark, tables):
    a, b, m = tables
    assert "CAST" in direct_join_sql(spark, a, b)
    assert "CAST" not in bridged_join_sql(spark, m, a, b)


def test_odd_names(spark, tables):
    a, b, _ = tables
    with pytest.raises(Exception):
        publish_view(spark, "v AS SELECT 1 --", direct_join_sql(spark, a, b))
