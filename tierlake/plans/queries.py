"""One query per operator, each over whole tables, with the SQL that gives the same rows.

The tables stand in for the sources: `customer` for the relational one (A), `supplier` for the document
collection (B). Upserts replay `orders` as it would arrive: a first load of the orders before 1999, then the
changes since 1998, in which the price has doubled. So 1998 is updated, later years are inserted, and earlier
ones stay as they were.

A query that writes does so below a fresh scratch folder and reads back what it published.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.config import DOCUMENT_SCHEMA, DocumentJob, GoldJob, MappingJob, Output, RelationalJob
from tierlake.functions.names import relation
from tierlake.functions.schema import conform
from tierlake.functions.storage import one_process, scratch_folder, unique_name
from tierlake.operators.gold import bridged_join_sql, direct_join_sql, preview, publish_view, read_view
from tierlake.operators.mapping import build_mapping
from tierlake.operators.publish import first_load, grow_buckets, overwrite, upsert
from tierlake.operators.tables import read_table, register_external_table
from tierlake.operators.upsert import merge_upsert
from tierlake.plans import jobs
from tierlake.sources.documents import read_export
from tierlake.sources.jdbc import Connection, Ranges, Strides, even_ranges, partition_bounds, read_jdbc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

A_SQL = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS value FROM customer"
B_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS name, s_acctbal AS value FROM supplier"
MAPPING_SQL = f"""
    SELECT a.id AS sqlserver_id, b._id AS mongodb_id
    FROM ({A_SQL}) a JOIN ({B_SQL}) b ON CAST(a.id AS VARCHAR) = b._id"""
DIRECT_SQL = f"""
    SELECT a.id AS a_id, a.name AS a_name, a.value AS a_value, b._id AS b__id, b.name AS b_name, b.value AS b_value
    FROM ({A_SQL}) a JOIN ({B_SQL}) b ON CAST(a.id AS VARCHAR) = b._id"""
BRIDGED_SQL = f"""
    SELECT m.sqlserver_id, m.mongodb_id, a.id AS a_id, a.name AS a_name, a.value AS a_value,
           b._id AS b__id, b.name AS b_name, b.value AS b_value
    FROM ({MAPPING_SQL}) m JOIN ({A_SQL}) a ON m.sqlserver_id = a.id JOIN ({B_SQL}) b ON m.mongodb_id = b._id"""

A_SCHEMA = "id BIGINT, name STRING, value DOUBLE"
LOADED = "o_orderdate < TIMESTAMP '1999-01-01'"
CHANGED = "o_orderdate >= TIMESTAMP '1998-01-01'"
DOUBLED = f"CASE WHEN {CHANGED} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice"


def query(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS value")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.selectExpr("CAST(s_suppkey AS STRING) AS _id", "s_name AS name", "s_acctbal AS value")


def registered(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A given table in the catalog, over its own files."""
    catalog_name, df = unique_name(f"tierlake_{name}_"), table(spark, sf_dir, name)
    register_external_table(spark, catalog_name, f"{sf_dir.rstrip('/')}/{name}.parquet", df.schema)
    return catalog_name


def bronze(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A and B by catalog name. They are views over the given files, so nothing is copied."""
    a, b = unique_name("tierlake_a_"), unique_name("tierlake_b_")
    customer, supplier = registered(spark, sf_dir, "customer"), registered(spark, sf_dir, "supplier")
    publish_view(
        spark,
        a,
        f"SELECT c_custkey AS id, c_name AS name, c_acctbal AS value FROM {relation(customer)}",
    )
    publish_view(
        spark,
        b,
        f"SELECT CAST(s_suppkey AS STRING) AS _id, s_name AS name, s_acctbal AS value FROM {relation(supplier)}",
    )
    return a, b


def exported(spark: SparkSession, df: DataFrame) -> str:
    """`df` as a collection export, one JSON document per line."""
    folder = scratch_folder(spark)
    df.write.json(folder)
    return folder


_LOADED_SOURCES: dict[tuple[str, str], tuple[Connection, str]] = {}


def relational_source(spark: SparkSession, sf_dir: str) -> tuple[Connection, str]:
    """A database and the name of a fresh table with A in it.

    `spark.tierlake.jdbc.url` (with `.user`, `.password` and `.driver`) names one that all executors reach. Without
    it, a local session uses the embedded database that comes with Spark, which only its own process sees.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _LOADED_SOURCES:
        url, name = spark.conf.get("spark.tierlake.jdbc.url", None), unique_name("tierlake_customer_")
        if url:
            rest = (spark.conf.get(f"spark.tierlake.jdbc.{k}", None) for k in ("user", "password", "driver"))
            connection = Connection(url, *rest)
        elif one_process(spark):
            log = os.path.join(tempfile.mkdtemp(prefix="tierlake_"), "derby.log")
            spark._jvm.java.lang.System.setProperty("derby.stream.error.file", log)
            connection = Connection(
                f"jdbc:derby:memory:{unique_name('tierlake_')};create=true",
                driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
            )
        else:
            raise ValueError("set spark.tierlake.jdbc.url to a database that all executors can reach")
        relational(spark, sf_dir).write.format("jdbc").options(**connection.reader_options()).options(
            dbtable=name, createTableColumnTypes="name VARCHAR(50)"
        ).mode("errorifexists").save()
        _LOADED_SOURCES[known] = connection, name
    return _LOADED_SOURCES[known]


def orders_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(_ntz(LOADED))
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def orders_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(_ntz(CHANGED))
    return orders.select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderdate")


def _ntz(condition: str) -> str:
    return condition.replace("TIMESTAMP", "TIMESTAMP_NTZ")


def published(spark: SparkSession, *batches: DataFrame, keys: list[str], **rules) -> DataFrame:
    """The table after upserting the batches in turn."""
    name, path = unique_name("tierlake_t_"), scratch_folder(spark)
    for batch in batches:
        upsert(spark, name, path, batch, keys, **rules)
    return read_table(spark, name)


# Sources


def split(spark: SparkSession, connection: Connection, source: str) -> Ranges | Strides | None:
    return even_ranges(spark, connection, source, "id", 8)


@query(A_SQL)
def jdbc_table_scan(spark, sf_dir):
    source, name = relational_source(spark, sf_dir)
    return read_jdbc(spark, source, name, split=split(spark, source, name))


@query("SELECT c_custkey AS id, c_acctbal AS value FROM customer WHERE c_acctbal > 5000")
def jdbc_subquery_scan(spark, sf_dir):
    source, name = relational_source(spark, sf_dir)
    subquery = f'(SELECT "id", "value" FROM {name} WHERE "value" > 5000) AS rich'
    return read_jdbc(spark, source, subquery, split=split(spark, source, subquery))


@query(A_SQL)
def jdbc_partitioned_scan(spark, sf_dir):
    """Equal strides between bounds that leave rows outside on both ends."""
    source, name = relational_source(spark, sf_dir)
    least, greatest = partition_bounds(spark, source, name, "id").first()
    inset = (greatest - least) // 16
    strides = Strides("id", str(least + inset), str(greatest - inset), 8)
    return read_jdbc(spark, source, name, split=strides)


@query(
    "SELECT min(c_custkey) AS lower_bound, max(c_custkey) AS upper_bound FROM customer"
)
def jdbc_partition_bounds(spark, sf_dir):
    return partition_bounds(spark, *relational_source(spark, sf_dir), "id")


@query(B_SQL)
def document_scan(spark, sf_dir):
    folder = exported(spark, documents(spark, sf_dir))
    return read_export(spark, folder, DOCUMENT_SCHEMA)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_acctbal AS value FROM supplier WHERE s_acctbal > 5000")
def document_scan_filtered(spark, sf_dir):
    folder = exported(spark, documents(spark, sf_dir))
    return read_export(spark, folder, DOCUMENT_SCHEMA, where=F.col("value") > 5000, columns=["_id", "value"])


@query("SELECT CAST(doc_id AS VARCHAR) AS _id, lang, n_chars, text FROM documents")
def document_text_scan(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("_id"), "*")
    return read_export(spark, exported(spark, texts), "_id STRING, lang STRING, n_chars BIGINT, text STRING")


@query(A_SQL)
def schema_enforced_read(spark, sf_dir):
    source, name = relational_source(spark, sf_dir)
    return read_jdbc(spark, source, name, split=split(spark, source, name), schema=A_SCHEMA)


@query("SELECT * FROM customer")
def catalog_table_scan(spark, sf_dir):
    return read_table(spark, registered(spark, sf_dir, "customer"))


@query("SELECT * FROM lineitem", name="register_external_table")
def register_in_place(spark, sf_dir):
    return spark.table(registered(spark, sf_dir, "lineitem"))


@query("SELECT c_name AS name, c_custkey AS id, c_acctbal AS value FROM customer")
def jdbc_text_key_scan(spark, sf_dir):
    """Split by names, at quantiles that the source is asked for."""
    source, name = relational_source(spark, sf_dir)
    rows = read_jdbc(spark, source, name, split=even_ranges(spark, source, name, "name", 8))
    return rows.select("name", "id", "value")


HALF_WITHOUT_KEY = "CASE WHEN {0} < 4500 THEN NULL WHEN {0} < 7000 THEN 'some' ELSE {1} END AS {2}"


@query(f"SELECT {HALF_WITHOUT_KEY.format('c_acctbal', 'c_name', 'part')}, c_custkey AS id, c_acctbal AS value FROM customer")
def jdbc_null_key_scan(spark, sf_dir):
    """Half of the rows have no value in the column that the read is split by, and a quarter share one."""
    source, name = relational_source(spark, sf_dir)
    part = HALF_WITHOUT_KEY.format('"value"', '"name"', '"part"')
    subquery = f'(SELECT {part}, "id", "value" FROM {name}) AS parts'
    return read_jdbc(spark, source, subquery, split=even_ranges(spark, source, subquery, "part", 8, "id"))


# Schema and projection


@query(
    "SELECT o_totalprice, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, "
    "CAST(NULL AS DOUBLE) AS discount FROM orders"
)
def conform_schema(spark, sf_dir):
    wanted = "o_totalprice DOUBLE, o_orderkey STRING, o_custkey DOUBLE, discount DOUBLE"
    return conform(table(spark, sf_dir, "orders"), wanted)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS _id, upper(s_name) AS name FROM supplier WHERE s_acctbal > 0")
def bronze_transform(spark, sf_dir):
    job = DocumentJob(
        output=Output(unique_name("tierlake_t_"), scratch_folder(spark), ("_id",)),
        export_path=exported(spark, documents(spark, sf_dir)),
    )
    return jobs.ingest_documents(
        spark, job, lambda rows: rows.filter("value > 0").select("_id", F.upper("name").alias("name"))
    )


# Joins


@query(MAPPING_SQL)
def silver_mapping_join(spark, sf_dir):
    return build_mapping(relational(spark, sf_dir), documents(spark, sf_dir))


@query(
    "SELECT c_custkey AS customer_id, s_name AS supplier_name "
    "FROM customer JOIN supplier ON c_custkey = s_suppkey"
)
def mapping_project_alias(spark, sf_dir):
    return build_mapping(
        relational(spark, sf_dir),
        documents(spark, sf_dir),
        ids=("id", "name"),
        names=("customer_id", "supplier_name"),
    )


@query(
    "SELECT o_orderkey AS order_id, l_linenumber AS line FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
)
def mapping_join_repeated_keys(spark, sf_dir):
    return build_mapping(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        on=("o_orderkey", "l_orderkey"),
        ids=("o_orderkey", "l_linenumber"),
        names=("order_id", "line"),
        one_to_one=False,
    )


@query(DIRECT_SQL)
def gold_direct_join(spark, sf_dir):
    return spark.sql(direct_join_sql(spark, *bronze(spark, sf_dir)))


@query(
    "SELECT l.*, o.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
)
def gold_direct_join_repeated_keys(spark, sf_dir):
    lines, orders = registered(spark, sf_dir, "lineitem"), registered(spark, sf_dir, "orders")
    return spark.sql(direct_join_sql(spark, lines, orders, on=("l_orderkey", "o_orderkey"), prefixes=("", "")))


def _mapping_table(spark: SparkSession, a: str, b: str) -> str:
    name = unique_name("tierlake_m_")
    output = Output(name, scratch_folder(spark), ("sqlserver_id",))
    jobs.map_sources(spark, MappingJob(output, left=a, right=b))
    return name


@query(BRIDGED_SQL)
def gold_via_mapping(spark, sf_dir):
    a, b = bronze(spark, sf_dir)
    return spark.sql(bridged_join_sql(spark, _mapping_table(spark, a, b), a, b))


@query(BRIDGED_SQL)
def gold_view_read(spark, sf_dir):
    a, b = bronze(spark, sf_dir)
    view = unique_name("tierlake_gold_")
    jobs.publish_gold(spark, GoldJob(view, left=a, right=b, mapping=_mapping_table(spark, a, b)))
    return read_view(spark, view)


@query(f"SELECT * FROM ({BRIDGED_SQL}) gold ORDER BY a_id LIMIT 20")
def gold_preview_top20(spark, sf_dir):
    return preview(gold_view_read(spark, sf_dir), ["a_id"])


@query(BRIDGED_SQL)
def gold_from_sources(spark, sf_dir):
    """Every job in turn: both sources to bronze, mapping, gold view."""
    a, b, m, view = (unique_name(f"tierlake_{part}_") for part in ("a", "b", "m", "gold"))
    source, name = relational_source(spark, sf_dir)
    jobs.ingest_relational(
        spark,
        RelationalJob(
            connection=source,
            query=name,
            output=Output(a, scratch_folder(spark), ("id",), buckets=8),
            schema=A_SCHEMA,
            discover=("id", 8),
        ),
    )
    jobs.ingest_documents(
        spark,
        DocumentJob(
            output=Output(b, scratch_folder(spark), ("_id",)),
            export_path=exported(spark, documents(spark, sf_dir)),
        ),
    )
    jobs.map_sources(
        spark,
        MappingJob(
            Output(m, scratch_folder(spark), ("sqlserver_id",)), left=a, right=b
        ),
    )
    return jobs.publish_gold(spark, GoldJob(view, left=a, right=b, mapping=m))


# Upsert and publish


LINES_AND_ORDERS = """
    SELECT coalesce(l_orderkey, o_orderkey) AS order_id, l_partkey, l_linenumber, l_quantity, o_orderstatus
    FROM lineitem FULL JOIN orders ON l_orderkey = o_orderkey"""


def lines_and_orders(spark: SparkSession, sf_dir: str, key=lambda column: column) -> list[DataFrame]:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return [
        lines.select(key(F.col("l_orderkey")).alias("order_id"), "l_partkey", "l_linenumber", "l_quantity"),
        orders.select(F.col("o_orderkey").alias("order_id"), "o_orderstatus"),
    ]


@query("SELECT * FROM orders")
def bronze_first_load(spark, sf_dir):
    return published(spark, table(spark, sf_dir, "orders"), keys=["o_orderkey"])


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def bronze_upsert(spark, sf_dir):
    return published(spark, orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir), keys=["o_orderkey"])


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def bronze_upsert_bucketed(spark, sf_dir):
    return published(
        spark, orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir), keys=["o_orderkey"], buckets=16
    )


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def upsert_rerun(spark, sf_dir):
    changed = orders_changed(spark, sf_dir)
    return published(spark, orders_loaded(spark, sf_dir), changed, changed, keys=["o_orderkey"])


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders WHERE {LOADED} AND {CHANGED}")
def upsert_matched_update(spark, sf_dir):
    """The rows of the merged table whose keys were in both."""
    loaded, changed = orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir)
    matched = changed.select("o_orderkey").join(loaded.select("o_orderkey"), "o_orderkey", "left_semi")
    return published(spark, loaded, changed, keys=["o_orderkey"]).join(matched, "o_orderkey", "left_semi")


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders WHERE NOT ({LOADED})")
def upsert_not_matched_insert(spark, sf_dir):
    """The rows of the merged table whose keys were only in the changes."""
    loaded = orders_loaded(spark, sf_dir)
    result = published(spark, loaded, orders_changed(spark, sf_dir), keys=["o_orderkey"])
    return result.join(loaded.select("o_orderkey"), "o_orderkey", "left_anti")


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def upsert_as_expression(spark, sf_dir):
    return merge_upsert(orders_loaded(spark, sf_dir), orders_changed(spark, sf_dir), ["o_orderkey"])


@query(
    f"SELECT o_orderkey, CASE WHEN {LOADED} THEN o_custkey END AS o_custkey, {DOUBLED}, "
    f"CASE WHEN {LOADED} THEN o_orderdate END AS o_orderdate, "
    f"CASE WHEN {CHANGED} THEN o_orderpriority END AS o_orderpriority FROM orders"
)
def upsert_schema_evolution(spark, sf_dir):
    changed = table(spark, sf_dir, "orders").filter(_ntz(CHANGED))
    changed = changed.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderpriority")
    return published(spark, orders_loaded(spark, sf_dir), changed, keys=["o_orderkey"])


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def upsert_fixed_schema(spark, sf_dir):
    changed = table(spark, sf_dir, "orders").filter(_ntz(CHANGED))
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return published(spark, orders_loaded(spark, sf_dir), changed, keys=["o_orderkey"], evolve=False)


@query(
    f"SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS order_id, {DOUBLED}, o_orderdate FROM orders "
    f"UNION ALL SELECT NULL, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P' AND {LOADED} AND {CHANGED}"
)
def upsert_null_keys_insert(spark, sf_dir):
    """A third of the orders have no key yet, so they match nothing and are inserted each time."""
    keyed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id")
    orders = table(spark, sf_dir, "orders")
    loaded = orders.filter(_ntz(LOADED)).select(keyed, "o_totalprice", "o_orderdate")
    changed = orders.filter(_ntz(CHANGED)).select(
        keyed, (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderdate"
    )
    return published(spark, loaded, changed, keys=["order_id"], null_keys="insert")


@query(LINES_AND_ORDERS)
def upsert_repeated_target_keys(spark, sf_dir):
    """Lines loaded under the key of their order: each order updates all its lines and adds its status."""
    return published(spark, *lines_and_orders(spark, sf_dir), keys=["order_id"])


@query(
    "SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(value, ts) AS value "
    "FROM events GROUP BY user_id"
)
def upsert_latest_per_key(spark, sf_dir):
    """Of many events of a user, the latest: first among those of clicks, then among all."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value", "event_type")
    clicks = events.filter("event_type = 'click'").drop("event_type")
    return published(spark, clicks, events.drop("event_type"), keys=["user_id"], dedupe_by="ts")


LINES_SQL = """
    SELECT l_orderkey, l_linenumber, sum(l_quantity) AS quantity, count(*) AS parcels
    FROM lineitem WHERE {} GROUP BY l_orderkey, l_linenumber"""
LINES_LOADED = "l_shipdate < TIMESTAMP '1999-01-01'"
LINES_CHANGED = "l_shipdate >= TIMESTAMP '1998-01-01'"


@query(
    f"""SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey,
        coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
        coalesce(s.quantity, t.quantity) AS quantity, coalesce(s.parcels, t.parcels) AS parcels
    FROM ({LINES_SQL.format(LINES_LOADED)}) t FULL JOIN ({LINES_SQL.format(LINES_CHANGED)}) s
    ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"""
)
def upsert_composite_key(spark, sf_dir):
    def parcels(condition: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem").filter(_ntz(condition))
        return lines.groupBy("l_orderkey", "l_linenumber").agg(
            F.sum("l_quantity").alias("quantity"), F.count("*").alias("parcels")
        )

    return published(spark, parcels(LINES_LOADED), parcels(LINES_CHANGED), keys=["l_orderkey", "l_linenumber"])


@query(
    "SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_totalprice, o_orderpriority FROM orders"
)
def overwrite_schema_evolution(spark, sf_dir):
    name, path, orders = unique_name("tierlake_t_"), scratch_folder(spark), table(spark, sf_dir, "orders")
    first_load(spark, name, path, orders.select("o_orderkey", "o_custkey", "o_totalprice"))
    overwrite(spark, name, path, orders.select("o_orderkey", "o_totalprice", "o_orderpriority"))
    return read_table(spark, name)


@query(
    f"""SELECT c_custkey AS sqlserver_id,
        CASE WHEN c_acctbal >= 0 THEN s_name ELSE CAST(s_suppkey AS VARCHAR) END AS mongodb_id
    FROM customer JOIN supplier ON c_custkey = s_suppkey"""
)
def silver_mapping_upsert(spark, sf_dir):
    """Partners by id for customers below 5000, then by name for those not in debt."""
    a, b = relational(spark, sf_dir), documents(spark, sf_dir)
    first = build_mapping(a.filter("value < 5000"), b)
    second = build_mapping(a.filter("value >= 0"), b, ids=("id", "name"))
    return published(spark, first, second, keys=["sqlserver_id"])


# The plans for sources too large to broadcast, whatever the size of the given tables


@query(LINES_AND_ORDERS)
def upsert_one_join(spark, sf_dir):
    return published(spark, *lines_and_orders(spark, sf_dir), keys=["order_id"], plan="one join")


@query(LINES_AND_ORDERS)
def upsert_two_shuffle_joins(spark, sf_dir):
    return published(spark, *lines_and_orders(spark, sf_dir), keys=["order_id"], plan="two joins")


@query(
    """SELECT coalesce(order_id, o_orderkey) AS order_id, l_partkey, l_linenumber, l_quantity, o_orderstatus
    FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS order_id, l_partkey, l_linenumber,
                 l_quantity FROM lineitem) lines
    FULL JOIN orders ON order_id = o_orderkey"""
)
def upsert_hot_key_bucketed(spark, sf_dir):
    """A third of the lines are under one key, so in one bucket."""
    batches = lines_and_orders(spark, sf_dir, lambda key: F.when(key % 3 == 0, 0).otherwise(key))
    return published(spark, *batches, keys=["order_id"], buckets=16, plan="two joins")


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def upsert_after_reregistration(spark, sf_dir):
    """The catalog loses a bucketed table, some of whose buckets have been rewritten; the next upsert finds it by path."""
    name, path = unique_name("tierlake_t_"), scratch_folder(spark)
    changed = orders_changed(spark, sf_dir)
    upsert(spark, name, path, orders_loaded(spark, sf_dir), ["o_orderkey"], buckets=16)
    upsert(spark, name, path, changed.filter("o_orderkey % 7 = 0"), ["o_orderkey"])
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
    upsert(spark, name, path, changed.filter("o_orderkey % 7 <> 0"), ["o_orderkey"])
    return read_table(spark, name)


@query(
    """SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
               l_linenumber DESC, l_quantity DESC) AS place
        FROM lineitem) lines
    WHERE place = 1"""
)
def upsert_latest_with_ties(spark, sf_dir):
    """The last line of each order by day; of several on that day, the one whose other columns are greatest."""
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return published(spark, lines.filter("l_linenumber < 3"), lines, keys=["l_orderkey"], dedupe_by="l_shipdate")


@query(
    """WITH changed AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
    lines AS (
        SELECT l_orderkey, l_linenumber AS line, l_quantity AS quantity, l_partkey AS part, TRUE AS is_new FROM changed
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_quantity, NULL, FALSE FROM lineitem
        WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_orderkey NOT IN (SELECT l_orderkey FROM changed)
    )
    SELECT l_orderkey, sum(quantity) OVER of_order AS total, CASE WHEN is_new THEN count(*) OVER of_order END AS parcels,
           line, quantity, part
    FROM lines WINDOW of_order AS (PARTITION BY l_orderkey)"""
)
def upsert_nested_evolution(spark, sf_dir):
    """Orders as documents with a struct and an array of structs, both of which gain a field with the changes."""

    def documents_of(condition: str, summary: list, line: list) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem").filter(_ntz(condition)).groupBy("l_orderkey")
        return lines.agg(F.struct(*summary).alias("summary"), F.collect_list(F.struct(*line)).alias("lines"))

    total, parcels = F.sum("l_quantity").alias("total"), F.count("*").alias("parcels")
    line = [F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity")]
    loaded = documents_of(LINES_LOADED, [total], line)
    changed = documents_of(LINES_CHANGED, [parcels, total], [F.col("l_partkey").alias("part"), *line])
    orders = published(spark, loaded, changed, keys=["l_orderkey"], buckets=16)
    return orders.select("l_orderkey", "summary.*", F.inline("lines"))


@query(f"SELECT o_orderkey, o_custkey, {DOUBLED}, o_orderdate FROM orders")
def upsert_after_bucket_growth(spark, sf_dir):
    """Half of the changes, then four times the buckets, then the other half."""
    name, path = unique_name("tierlake_t_"), scratch_folder(spark)
    changed = orders_changed(spark, sf_dir)
    upsert(spark, name, path, orders_loaded(spark, sf_dir), ["o_orderkey"], buckets=8)
    upsert(spark, name, path, changed.filter("o_orderkey % 2 = 0"), ["o_orderkey"])
    grow_buckets(spark, name, path, 32)
    upsert(spark, name, path, changed.filter("o_orderkey % 2 = 1"), ["o_orderkey"])
    return read_table(spark, name)
