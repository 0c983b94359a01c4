"""Times the alternatives behind a few design choices and prints a table. Settings as for bench.py."""

from __future__ import annotations

import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.storage import scratch_folder, unique_name
from tierlake.operators.gold import bridged_join_sql, direct_join_sql, publish_view
from tierlake.operators.mapping import build_mapping
from tierlake.operators.publish import upsert
from tierlake.operators.upsert import merge_in_one_join, merge_in_two_joins, split_unique
from tierlake.plans.queries import bronze, registered, relational_source, table
from tierlake.sources.jdbc import discovered_strides, read_jdbc

RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def report(name: str, work: Callable[[], object]) -> None:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    print(f"| {name} | {statistics.median(times):.2f} |", flush=True)


def joins(spark: SparkSession, setting: str) -> None:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", setting)


def upserts(spark: SparkSession, sf_dir: str) -> None:
    orders = table(spark, sf_dir, "orders")
    changed = orders.filter("o_orderdate >= TIMESTAMP_NTZ '2001-01-01'")
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    keys, split = ["o_orderkey"], split_unique(changed, ["o_orderkey"])

    def union(parts):
        return parts.updated.union(parts.inserted)

    def two_joins(broadcast):
        return union(merge_in_two_joins(orders, split, keys, broadcast_source=broadcast))

    report("merge, source broadcast", lambda: compute(two_joins(True)))
    joins(spark, "-1")
    report("merge, two shuffle joins", lambda: compute(two_joins(False)))
    report("merge, one full outer join", lambda: compute(union(merge_in_one_join(orders, split, keys))))
    joins(spark, "10m")
    for buckets in (None, 16):
        name, path = unique_name("tierlake_v_"), scratch_folder(spark)
        upsert(spark, name, path, orders, keys, buckets=buckets)
        layout = f"{buckets} buckets" if buckets else "no buckets"
        report(f"upsert into a table, {layout}", lambda: upsert(spark, name, path, changed, keys))
        few = changed.filter("o_orderdate >= TIMESTAMP_NTZ '2001-07-31' AND o_custkey < 1500")
        report(f"upsert of a few rows, {layout}", lambda: upsert(spark, name, path, few, keys))


def reads(spark: SparkSession, sf_dir: str) -> None:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    pairs = build_mapping(
        orders, lines, on=("o_orderkey", "l_orderkey"), ids=("o_orderkey", "l_linenumber"), one_to_one=False
    )
    report("mapping join orders x lineitem, broadcast", lambda: compute(pairs))
    joins(spark, "-1")
    report("mapping join orders x lineitem, sort-merge", lambda: compute(pairs.select("*")))
    joins(spark, "10m")
    source, customers = relational_source(spark, sf_dir)
    report("JDBC customer, one partition", lambda: compute(read_jdbc(spark, source, customers)))
    strides = discovered_strides(spark, source, customers, "id", 4)
    report("JDBC customer, four partitions", lambda: compute(read_jdbc(spark, source, customers, split=strides)))
    a, b = bronze(spark, sf_dir)
    view, mapping = unique_name("tierlake_v_"), unique_name("tierlake_m_")
    upsert(
        spark,
        mapping,
        scratch_folder(spark),
        build_mapping(spark.table(a), spark.table(b)),
        ["sqlserver_id"],
    )
    publish_view(spark, view, bridged_join_sql(spark, mapping, a, b))
    report("gold view through the mapping", lambda: compute(spark.table(view)))
    report("gold direct join", lambda: compute(spark.sql(direct_join_sql(spark, a, b))))
    lines_name, orders_name = registered(spark, sf_dir, "lineitem"), registered(spark, sf_dir, "orders")
    direct = direct_join_sql(spark, lines_name, orders_name, on=("l_orderkey", "o_orderkey"), prefixes=("", ""))
    report("gold direct join lineitem x orders", lambda: compute(spark.sql(direct)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="tierlake_bench_")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    compute(table(spark, sf_dir, "lineitem"))
    print("| variant | seconds |\n|---|---|")
    upserts(spark, sf_dir)
    reads(spark, sf_dir)
    spark.stop()


if __name__ == "__main__":
    main()
