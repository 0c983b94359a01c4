"""Declared schemas."""

from __future__ import annotations

import pytest
from conftest import rows

from tierlake import SchemaError, conform, rejects
from tierlake.functions.schema import as_schema, evolved, grown, nullable


def test_conform_reorders_drops_fills_and_casts(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a INT, b STRING, c DOUBLE")
    out = conform(df, "c DOUBLE, a STRING, z INT")
    assert out.schema.simpleString() == "struct<c:double,a:string,z:int>"
    assert rows(out) == [(2.5, "1", None)]


def test_conform_refuses_text_to_number(spark):
    with pytest.raises(Exception, match="`b`"):
        conform(spark.createDataFrame([("1",)], "b STRING"), "b INT")


def test_conform_refuses_null_where_the_schema_has_none(spark):
    with pytest.raises(Exception, match="[Nn]ull"):
        conform(spark.createDataFrame([(1,)], "a INT"), "a INT NOT NULL")


def test_try_casts_and_their_rejects(spark):
    df = spark.createDataFrame([("1", "x"), ("no", "y"), (None, "z")], "n STRING, t STRING")
    schema = "n INT, t STRING"
    assert rows(conform(df, schema, casts="try")) == [(None, "y"), (None, "z"), (1, "x")]
    assert rows(rejects(df, schema)) == [("no", "y")]
    with pytest.raises(ValueError, match="casts"):
        conform(df, schema, casts="hard")


def test_conform_stays_out_of_python_workers(spark):
    plan = conform(spark.range(3), "id STRING")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan


def test_evolved_order_types_and_nullability(spark):
    old = spark.createDataFrame([], "a INT NOT NULL, b STRING").schema
    new = spark.createDataFrame([], "c DATE, B INT, a BIGINT").schema
    assert evolved(spark, old, new).toDDL() == "a INT,b STRING,c DATE"


def test_untyped_new_column_is_refused(spark):
    with pytest.raises(SchemaError, match="no type"):
        evolved(spark, spark.range(1).schema, spark.sql("SELECT 1L id, NULL x").schema)


NESTED = "k INT, s STRUCT<a: INT, t: STRUCT<x: INT>>, l ARRAY<STRUCT<a: INT>>, m MAP<STRING, STRUCT<a: INT>>"
MORE = "k INT, m MAP<STRING, STRUCT<b: INT, a: INT>>, s STRUCT<T: STRUCT<y: INT, x: INT>, c: STRING>, l ARRAY<STRUCT<b: INT, A: INT>>"
BOTH = (
    "k INT, s STRUCT<a: INT, t: STRUCT<x: INT, y: INT>, c: STRING>, l ARRAY<STRUCT<a: INT, b: INT>>, "
    "m MAP<STRING, STRUCT<a: INT, b: INT>>"
)


def test_structs_grow_wherever_they_are(spark):
    both = evolved(spark, as_schema(NESTED), as_schema(MORE))
    assert both == as_schema(BOTH)
    assert evolved(spark, both, as_schema(MORE)) == evolved(spark, both, as_schema(NESTED)) == both
    deep = evolved(spark, as_schema("a ARRAY<ARRAY<STRUCT<x: INT NOT NULL>>>"), as_schema("a ARRAY<ARRAY<STRUCT<y: INT NOT NULL>>>"))
    assert deep == as_schema("a ARRAY<ARRAY<STRUCT<x: INT, y: INT>>>")


def test_rows_take_the_types_of_a_grown_schema(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, named_struct('a', 1, 't', named_struct('x', 2)), array(named_struct('a', 3), NULL), "
        "map('p', named_struct('a', 4), 'q', NULL)), (2, NULL, NULL, NULL) AS t(k, s, l, m)"
    )
    got = grown(df, as_schema(BOTH))
    assert nullable(got.schema) == as_schema(BOTH)
    assert [tuple(r) for r in got.orderBy("k").collect()] == [
        (1, (1, (2, None), None), [(3, None), None], {"p": (4, None), "q": None}),
        (2, None, None, None),
    ]
    assert grown(df, df.schema) is df


@pytest.mark.parametrize(
    ("old", "new", "message"),
    [
        ("m MAP<STRUCT<a: INT>, INT>", "m MAP<STRUCT<a: INT, b: INT>, INT>", "keys of the map m"),
        ("s STRUCT<a: INT>", "s STRUCT<a: INT, n: VOID>", "s.n has no type"),
        ("k INT", "k INT, n ARRAY<VOID>", "n has no type"),
    ],
)
def test_what_cannot_grow_is_named(spark, old, new, message):
    with pytest.raises(SchemaError, match=message):
        evolved(spark, as_schema(old), as_schema(new))
