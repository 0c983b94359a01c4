"""Id mapping."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierlake import build_mapping

A = "id INT, name STRING"
B = "_id STRING, name STRING"


def sides(spark, a, b):
    return spark.createDataFrame(a, A), spark.createDataFrame(b, B)


def test_pairs_by_text_with_default_names(spark):
    out = build_mapping(*sides(spark, [(1, "x"), (2, "y"), (None, "n")], [("1", "p"), ("64f0aa", "q"), (None, "r")]))
    assert out.schema.simpleString() == "struct<sqlserver_id:int,mongodb_id:string>"
    assert rows(out) == [(1, "1")]


def test_chosen_columns_and_names(spark):
    a, b = sides(spark, [(1, "x"), (2, "y")], [("9", "x"), ("8", "z")])
    assert rows(build_mapping(a, b, on=("name", "name"), ids=("id", "_id"), names=("l", "r"))) == [(1, "9")]


@pytest.mark.parametrize("a, b", [([(1, "x"), (1, "y")], [("1", "p")]), ([(1, "x")], [("1", "p"), ("1", "q")])])
def test_repeated_pair_fails(spark, a, b):
    with pytest.raises(Exception, match="NOT_ONE_TO_ONE: key 1 "):
        build_mapping(*sides(spark, a, b)).collect()


def test_repeated_keys_without_partner_do_not_matter(spark):
    out = build_mapping(*sides(spark, [(1, "x"), (2, "y"), (2, "z")], [("1", "p"), ("3", "q"), ("3", "r")]))
    assert rows(out) == [(1, "1")]


def test_repeated_pairs_on_request(spark):
    a, b = sides(spark, [(1, "x"), (1, "y")], [("1", "p"), ("1", "q"), ("1", "r")])
    out = build_mapping(a, b, ids=("name", "name"), one_to_one=False)
    assert rows(out) == [(i, j) for i in "xy" for j in "pqr"]


def test_one_shuffle_per_side_after_reducing_it(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(100).selectExpr("CAST(id AS INT) id", "'n' name", "1.5D value").write.parquet(f"{tmp_path}/a")
    spark.range(100).selectExpr("CAST(id AS STRING) _id", "'n' name").write.parquet(f"{tmp_path}/b")
    out = build_mapping(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("partial_count") == 2
    assert "SortAggregate" not in plan
    assert "ReadSchema: struct<id:int>" in plan and "ReadSchema: struct<_id:string>" in plan


def test_a_key_with_a_third_of_all_rows_fails_fast(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    a = spark.range(300_000).select(hot.cast("int").alias("id"))
    b = spark.range(300_000).select(hot.cast("string").alias("_id"))
    with pytest.raises(Exception, match="NOT_ONE_TO_ONE: key 7 "):
        build_mapping(a, b).collect()


@pytest.mark.parametrize("limit", ["-1", "10m"])
@pytest.mark.parametrize("read", [lambda m: m.count(), lambda m: m.select("mongodb_id").collect(), lambda m: m.select("sqlserver_id").collect()])
def test_repeats_are_noticed_whatever_is_read(spark, conf, limit, read):
    conf(spark__sql__autoBroadcastJoinThreshold=limit, spark__sql__adaptive__autoBroadcastJoinThreshold=limit)
    pairs = build_mapping(*sides(spark, [(1, "x"), (1, "y"), (2, "z")], [("1", "p"), ("2", "q")]))
    with pytest.raises(Exception, match="NOT_ONE_TO_ONE"):
        read(pairs)
    assert build_mapping(*sides(spark, [(1, "x"), (3, "y"), (3, "z")], [("1", "p")])).count() == 1
