"""Relational source, on the embedded database that comes with Spark."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import (
    Connection,
    Ranges,
    SchemaError,
    Strides,
    discovered_strides,
    even_ranges,
    partition_bounds,
    read_jdbc,
)
from tierlake.functions.storage import unique_name
from tierlake.plans import queries
from tierlake.sources import jdbc

DATA = [(i, f"n{i}", i / 2) for i in range(1, 41)]


@pytest.fixture(scope="module")
def source(spark):
    connection = Connection(
        f"jdbc:derby:memory:{unique_name('d')};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver"
    )
    manager = spark._jvm.java.sql.DriverManager
    spark._jvm.java.lang.Class.forName(connection.driver)
    link = manager.getConnection(connection.url)
    statement = link.createStatement()
    statement.execute("CREATE TABLE items (id INT NOT NULL PRIMARY KEY, name VARCHAR(50), value DOUBLE, grp INT)")
    for i, n, v in DATA:
        group = "NULL" if i % 10 == 0 else i * 100
        statement.execute(f"INSERT INTO items VALUES ({i}, '{n}', {v}, {group})")
    link.close()
    return connection


def test_table(spark, source):
    assert rows(read_jdbc(spark, source, "items").select("id", "name", "value")) == sorted(
        DATA, key=lambda r: str(r[0])
    )


def test_subquery_runs_in_the_source(spark, source):
    df = read_jdbc(spark, source, "(SELECT id, value FROM items WHERE value > 15) AS q")
    assert df.columns == ["ID", "VALUE"] and df.count() == 10


def test_filter_and_columns_reach_the_source(spark, source):
    plan = read_jdbc(spark, source, "items").filter("id > 15").select("name")._jdf.queryExecution()
    assert "PushedFilters: [*IsNotNull(ID), *GreaterThan(ID,15)]" in plan.executedPlan().toString()
    assert "ReadSchema: struct<NAME:string>" in plan.executedPlan().toString()


@pytest.mark.parametrize("lower, upper", [("1", "40"), ("15", "20"), ("-100", "1000")])
def test_bounds_never_filter(spark, source, lower, upper):
    df = read_jdbc(spark, source, "items", split=Strides("id", lower, upper, 4))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40


def test_null_partition_values_are_read(spark, source):
    df = read_jdbc(spark, source, "items", split=Strides.of("grp", "1000", "2000", "4"))
    assert df.count() == 40 and df.filter("grp IS NULL").count() == 4


@pytest.mark.parametrize("left_out", range(4))
def test_partition_settings_go_together(left_out):
    given = ["id", "1", "10", "4"]
    given[left_out] = None
    with pytest.raises(ValueError, match="partitioned read"):
        Strides.of(*given)


def test_no_partition_settings():
    assert Strides.of(None, "", None, None) is None


def test_bounds_are_found_by_the_source(spark, source):
    bounds = partition_bounds(spark, source, "items", "id")
    assert bounds.columns == ["lower_bound", "upper_bound"] and rows(bounds) == [(1, 40)]
    strides = discovered_strides(spark, source, "(SELECT id FROM items WHERE id > 5) AS q", "id", 3)
    assert strides == Strides("id", "6", "40", 3)


def test_fractional_bounds_cover_the_range(spark, source):
    strides = discovered_strides(spark, source, "items", "value", 4)
    assert (strides.lower, strides.upper) == ("0", "20")
    assert read_jdbc(spark, source, "items", split=strides).count() == 40


def test_no_strides_for_an_empty_table(spark, source):
    assert discovered_strides(spark, source, "(SELECT id FROM items WHERE id > 99) AS q", "id", 3) is None


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.fixture(scope="module")
def gaps(spark, source):
    """A thousand neighbouring ids far below a few huge ones, some below zero, and rows without a value."""
    ids = [*range(1000), *(10**12 + i * 10**9 for i in range(50)), -(10**6), None, None]
    spark.createDataFrame([(i,) for i in ids], "id BIGINT").write.format("jdbc").options(
        **source.reader_options()
    ).option("dbtable", "gaps").mode("overwrite").save()
    return len(ids)


def test_even_ranges_where_ids_have_gaps(spark, source, gaps):
    equal = read_jdbc(spark, source, "gaps", split=discovered_strides(spark, source, "gaps", "id", 8))
    assert max(sizes(equal)) > 1000
    even = read_jdbc(spark, source, "gaps", split=even_ranges(spark, source, "gaps", "id", 8))
    assert even.count() == gaps and even.distinct().count() == gaps - 1
    assert max(sizes(even)) <= 2 * gaps / 8 and 8 <= len(sizes(even)) <= 16


def test_even_ranges_of_a_column_with_one_hot_value(spark, source):
    table = "(SELECT CASE WHEN id < 30 THEN 7 ELSE id END AS v FROM items) AS q"
    even = read_jdbc(spark, source, table, split=even_ranges(spark, source, table, "v", 4))
    assert even.count() == 40 and max(sizes(even)) <= 30


def test_even_ranges_of_other_tables(spark, source):
    one = even_ranges(spark, source, "(SELECT id FROM items WHERE id = 3) AS q", "id", 4)
    assert isinstance(one, Ranges) and len(one.predicates) == 1
    assert even_ranges(spark, source, "(SELECT id FROM items WHERE id > 99) AS q", "id", 4) is None
    assert even_ranges(spark, source, "items", "value", 4) == Strides("value", "0", "20", 4)
    assert even_ranges(spark, source, "(SELECT name FROM items WHERE id > 99) AS q", "name", 4) is None
    assert even_ranges(spark, source, "(SELECT name, id FROM items WHERE id > 99) AS q", "name", 4, "id") is None
    with_null = even_ranges(spark, source, "items", "grp", 4)
    assert read_jdbc(spark, source, "items", split=with_null).count() == 40


@pytest.fixture(scope="module")
def keyed(spark, source):
    """Keys of several kinds, most of them in a small part of their range; half of the rows have no `part`, a third share one."""
    rows = spark.range(1000).selectExpr(
        "CAST(id AS INT) AS n",
        "IF(id < 900, concat('it''s é ', lpad(id, 5, '0')), concat('z', id)) AS name",
        "md5(CAST(id AS STRING)) AS code",
        "date_add(DATE '1990-01-01', CAST(IF(id < 950, id % 300, id * 50) AS INT)) AS day",
        "timestamp_micros(IF(id < 900, id, id * 1000000000) * 1001) AS at",
        "IF(id % 2 = 0, 'none', IF(id % 3 = 0, 'common', concat('rare', id))) AS part",
        "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 3 = 1 THEN id END AS grp",
    )
    rows.write.format("jdbc").options(**source.reader_options()).option("dbtable", "keyed").option(
        "createTableColumnTypes", "name VARCHAR(60), code VARCHAR(60), part VARCHAR(60)"
    ).mode("overwrite").save()
    link = spark._jvm.java.sql.DriverManager.getConnection(source.url)
    link.createStatement().execute('ALTER TABLE keyed ALTER COLUMN "part" NULL')
    link.createStatement().execute("UPDATE keyed SET \"part\" = NULL WHERE \"part\" = 'none'")
    link.close()
    return rows.withColumn("part", F.expr("nullif(part, 'none')"))


@pytest.mark.parametrize("column", ["name", "code", "day", "at", "part"])
def test_even_ranges_of_keys_that_are_no_numbers(spark, source, keyed, column):
    split = even_ranges(spark, source, "keyed", column, 8)
    read = read_jdbc(spark, source, "keyed", split=split)
    assert rows(read) == rows(keyed)
    if column != "part":
        assert max(sizes(read)) <= 2 * 1000 / 8 and len(split.predicates) >= 7


@pytest.mark.parametrize(("column", "then"), [("part", "n"), ("part", "code"), ("grp", "name"), ("grp", "at"), ("n", "name")])
def test_a_second_column_splits_what_the_first_leaves_together(spark, source, keyed, column, then):
    alone = read_jdbc(spark, source, "keyed", split=even_ranges(spark, source, "keyed", column, 8))
    split = even_ranges(spark, source, "keyed", column, 8, then)
    read = read_jdbc(spark, source, "keyed", split=split)
    assert rows(read) == rows(keyed) == rows(alone)
    assert max(sizes(read)) <= 2 * 1000 / 8 and len(split.predicates) <= 2 * 8 + 2
    if column != "n":
        assert max(sizes(alone)) > 300


def test_a_second_column_where_all_rows_lack_the_first(spark, source):
    table = "(SELECT id, CAST(NULL AS VARCHAR(9)) AS nothing, CAST(NULL AS INT) AS missing FROM items) AS q"
    for then, most in (("id", 10), ("missing", 40)):
        read = read_jdbc(spark, source, table, split=even_ranges(spark, source, table, "nothing", 8, then))
        assert sorted(r.ID for r in read.collect()) == list(range(1, 41)) and max(sizes(read)) <= most


def test_quantiles_of_a_source_with_window_functions():
    """The text that other databases get, run by one that has them."""
    duckdb = pytest.importorskip("duckdb")
    duckdb.sql("CREATE OR REPLACE TEMP TABLE keys AS SELECT md5(i::VARCHAR) AS k FROM range(1000) t(i) UNION ALL SELECT NULL FROM range(50)")
    query = jdbc.quantile_query("keys", '"k"', [251, 501, 751])
    cuts = [bound for bound, _ in sorted(duckdb.sql(f"SELECT * FROM {query}").fetchall(), key=lambda r: r[1])]
    counts = [duckdb.sql(f"SELECT count(*) FROM keys WHERE {p}").fetchall()[0][0] for p in jdbc._between("k", [f"'{c}'" for c in cuts]).predicates]
    assert counts == [300, 250, 250, 250]


@pytest.mark.parametrize(
    ("url", "value", "dtype", "literal"),
    [
        ("jdbc:postgresql://h/d", "it's", T.StringType(), "'it''s'"),
        ("jdbc:mysql://h/d", "a\\'b", T.StringType(), "'a\\\\''b'"),
        ("jdbc:sqlserver://h", "2020-02-29", T.DateType(), "'2020-02-29'"),
        ("jdbc:sqlserver://h", "12.50", T.DecimalType(9, 2), "12.50"),
    ],
)
def test_literals_of_the_source(spark, url, value, dtype, literal):
    assert jdbc._literal(spark, Connection(url), value, dtype) == literal
    with pytest.raises(ValueError, match="binary"):
        jdbc._literal(spark, Connection(url), value, T.BinaryType())


def test_asserted_schema(spark, source):
    query = "(SELECT id, name, value FROM items) AS q"
    exact = "ID INT, NAME STRING, VALUE DOUBLE"
    assert read_jdbc(spark, source, query, schema=exact).count() == 40
    for other in (
        "ID INT, NAME STRING",
        "NAME STRING, ID INT, VALUE DOUBLE",
        "id INT, name STRING, value DOUBLE",
        "ID INT NOT NULL, NAME STRING, VALUE DOUBLE",
        "ID BIGINT, NAME STRING, VALUE DOUBLE",
    ):
        with pytest.raises(SchemaError, match="schema"):
            read_jdbc(spark, source, query, schema=other)


def test_conformed_schema(spark, source):
    df = read_jdbc(spark, source, "items", schema="value DOUBLE, id BIGINT", schema_mode="conform")
    assert df.schema.simpleString() == "struct<value:double,id:bigint>" and df.count() == 40
    with pytest.raises(ValueError, match="schema_mode"):
        read_jdbc(spark, source, "items", schema="id INT", schema_mode="guess")


def test_reader_options():
    connection = Connection("jdbc:x", user="u", options=(("queryTimeout", "60"),))
    assert connection.reader_options() == {"fetchsize": "10000", "url": "jdbc:x", "user": "u", "queryTimeout": "60"}
    assert Connection("jdbc:x", options=(("fetchsize", "5"),)).reader_options()["fetchsize"] == "5"


def test_column_types(spark, source):
    df = read_jdbc(spark, source, "items", column_types="ID BIGINT, VALUE DECIMAL(10,2)")
    assert dict(df.dtypes)["ID"] == "bigint" and dict(df.dtypes)["VALUE"] == "decimal(10,2)"


def test_the_schema_of_a_split_is_looked_up_once(spark, source, monkeypatch):
    asked = []
    quoted = jdbc._quoted
    monkeypatch.setattr(jdbc, "_quoted", lambda *args: (asked.append(args), quoted(*args))[1])
    even_ranges(spark, source, "items", "id", 4)
    assert len(asked) == 1


def test_each_load_of_the_query_source_has_a_table_of_its_own(spark):
    (one, first), (two, second) = (queries.relational_source(spark, f"/root/testdata/sf{sf}") for sf in ("0.001", "0.01"))
    counts = [read_jdbc(spark, c, t).count() for c, t in ((one, first), (two, second))]
    assert first != second and counts == [150, 1500]
