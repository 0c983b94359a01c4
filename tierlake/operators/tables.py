"""Tables in the catalog: reading and registering them, and pointing them at other folders."""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.names import by_name, column_name, fold, text_literal
from tierlake.functions.schema import nullable
from tierlake.functions.storage import make_folder

BUCKET_COLUMN = "bucket"
# Names of the table properties that describe a layout.
BUCKETS = "tierlake.buckets"
KEYS = "tierlake.keys"
NEWEST_FOLDER = "tierlake.newest_folder"
# Where buckets lie that have been registered and not yet pointed at their rows.
EMPTY_FOLDER = "_empty"


class PublishError(RuntimeError):
    """The catalog and the storage disagree in a way a write must not paper over."""


@dataclass(frozen=True)
class Layout:
    """Where a registered table is and how its files are arranged."""

    provider: str
    location: str
    newest_folder: str
    # The number of hash buckets or the expression that gives the bucket, and the key columns it is made from.
    buckets: int | str | None = None
    keys: tuple[str, ...] = ()
    # Partition or bucket columns this package has not made.
    foreign_columns: tuple[str, ...] = ()


def table_exists(spark: SparkSession, name: str) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    if _is_view(spark, name):
        raise PublishError(f"{name} is a view, not a table")
    return True


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table or view by name, without the column that only serves its layout."""
    table = spark.table(name)
    if BUCKET_COLUMN in table.columns and not _is_view(spark, name) and table_layout(spark, name).buckets:
        # The filter keeps every row: no bucket is NULL. It makes Spark plan with the size of the files, as it only
        # looks them up beforehand for chosen partitions.
        return table.filter(F.col(BUCKET_COLUMN).isNotNull()).drop(BUCKET_COLUMN)
    return table


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType in ("VIEW", "TEMPORARY")


def table_layout(spark: SparkSession, name: str) -> Layout:
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name) AS JSON", args={"name": name}).first()[0]
    facts = json.loads(described)
    properties = facts.get("table_properties", {})
    foreign = facts.get("bucket_columns", []) + ([] if BUCKETS in properties else facts.get("partition_columns", []))
    return Layout(
        provider=facts.get("provider", "parquet").lower(),
        location=facts["location"],
        newest_folder=properties.get(NEWEST_FOLDER, facts["location"]),
        buckets=json.loads(properties.get(BUCKETS, "null")),
        keys=tuple(json.loads(properties.get(KEYS, "[]"))),
        foreign_columns=tuple(foreign),
    )


def register_external_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType,
    *,
    partitioned_by: Sequence[str] = (),
    properties: dict[str, str] | None = None,
    recover: bool = True,
) -> None:
    """Register the parquet files at `location` under `name`, unless the name is taken already."""
    parts = f"PARTITIONED BY ({', '.join(map(column_name, partitioned_by))})" if partitioned_by else ""
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({_ddl(schema.fields)}) USING parquet {parts} "
        f"LOCATION :location {f'TBLPROPERTIES ({pairs})' if pairs else ''}",
        args={"name": name, "location": location},
    )
    if partitioned_by and recover:
        spark.sql("ALTER TABLE IDENTIFIER(:name) RECOVER PARTITIONS", args={"name": name})


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ({pairs})", args={"name": name})


def add_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Add the columns of `schema` that the table lacks, and inner fields of structs. Files written before read as NULL there.

    SQL adds whole columns to such a table, and not inner fields; the session's catalog takes a whole schema.
    """
    now = spark.table(name).schema
    known = by_name(spark, now.names)
    added = [f for f in schema.fields if fold(spark, f.name) not in known]
    if added:
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD COLUMNS ({_ddl(added)})", args={"name": name})
    wanted = {fold(spark, f.name): f for f in schema.fields}
    kinds = [wanted.get(fold(spark, f.name), f).dataType for f in now.fields]
    fields = [T.StructField(f.name, kind, True, f.metadata) for f, kind in zip(now.fields, kinds, strict=True)]
    if nullable(T.StructType(fields)) != nullable(now):
        catalog, table = _session_catalog(spark, name)
        layout = [BUCKET_COLUMN] if table_layout(spark, name).buckets else []
        data = T.StructType([f for f in [*fields, *added] if f.name not in layout])
        catalog.alterTableDataSchema(table, spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json()))
        spark.catalog.refreshTable(name)


def check_writable(name: str, layout: Layout) -> None:
    if layout.provider not in ("parquet", "delta"):
        raise PublishError(f"{name} is stored as {layout.provider}; only parquet and delta tables can be written")
    if layout.provider == "parquet" and layout.foreign_columns:
        raise PublishError(f"{name} is laid out by {list(layout.foreign_columns)}, which a rewrite would not keep")


def check_unmoved(spark: SparkSession, name: str, layout: Layout) -> None:
    now = table_layout(spark, name).newest_folder
    if now != layout.newest_folder:
        raise PublishError(f"{name} went from {layout.newest_folder} to {now} while it was being rewritten")


def switch_table(spark: SparkSession, name: str, layout: Layout, location: str) -> None:
    check_unmoved(spark, name, layout)
    spark.sql(
        "ALTER TABLE IDENTIFIER(:name) SET LOCATION :location", args={"name": name, "location": location}
    )
    spark.catalog.refreshTable(name)


def switch_buckets(
    spark: SparkSession,
    name: str,
    layout: Layout,
    location: str,
    buckets: Collection[int],
    gone: Collection[int] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """Point these buckets at their folders below `location`, if the table is still where `layout` says, and drop those `gone`.

    New ones are first registered with an empty folder, all in one statement; then all are pointed at their rows, and those
    that go at the empty folder, in one call to the catalog, however many there are. `properties` are set before that, with the
    new place.
    """
    added = sorted(set(buckets) - registered_buckets(spark, name))
    check_unmoved(spark, name, layout)
    set_properties(spark, name, {NEWEST_FOLDER: location} | (properties or {}))
    empty = f"{location}/{EMPTY_FOLDER}"
    if added or gone:
        make_folder(spark, empty)
    if added:
        parts = " ".join(f"{_partition(number)} LOCATION {text_literal(empty)}" for number in added)
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS {parts}", args={"name": name})
    _move_partitions(spark, name, {n: _bucket_folder(location, n) for n in buckets} | dict.fromkeys(gone, empty))
    drop_buckets(spark, name, gone)
    spark.catalog.refreshTable(name)


def _move_partitions(spark: SparkSession, name: str, where: dict[int, str]) -> None:
    """SQL can only move one partition at a time; the session's catalog takes a list.

    The driver makes that list with a few calls to the JVM for each, so tables should have some thousands of buckets at most.
    """
    if not where:
        return
    jvm, (catalog, table) = spark._jvm, _session_catalog(spark, name)
    values = jvm.java.util.HashMap()
    values.put(BUCKET_COLUMN, str(min(where)))
    to_scala = jvm.scala.jdk.javaapi.CollectionConverters.asScala
    some = catalog.getPartition(table, jvm.scala.collection.immutable.HashMap().concat(to_scala(values)))
    # What all partitions share, and the classes, are looked up once: each look is a call to the JVM.
    form, spec, moved = some.storage(), some.spec(), jvm.java.util.ArrayList()
    fixed = [form.productElement(i) for i in range(1, form.productArity())]  # all but the location
    rest = [some.parameters(), some.createTime(), some.lastAccessTime(), jvm.scala.Option.empty()]  # no old sizes
    as_path, new_uri, a_value = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI.create, jvm.scala.Some
    roots = {root: as_path(root).toUri().toString() for root in {folder.rpartition("/")[0] for folder in where.values()}}
    for number, folder in sorted(where.items()):
        root, _, last = folder.rpartition("/")
        storage = form.copy(a_value(new_uri(f"{roots[root]}/{last}")), *fixed)
        moved.add(some.copy(spec.updated(BUCKET_COLUMN, str(number)), storage, *rest))
    catalog.alterPartitions(table, to_scala(moved).toSeq())


def drop_buckets(spark: SparkSession, name: str, buckets: Collection[int]) -> None:
    """Take these buckets out of the table. Their files stay."""
    if buckets:
        gone = ", ".join(_partition(number) for number in sorted(buckets))
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) DROP {gone}", args={"name": name})
        spark.catalog.refreshTable(name)


def restored_buckets(spark: SparkSession, name: str, where: dict[int, str], newest: str) -> None:
    """Register each bucket in the folder that holds it."""
    parts = [f"{_partition(n)} LOCATION {text_literal(_bucket_folder(at, n))}" for n, at in sorted(where.items())]
    if parts:
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS {' '.join(parts)}", args={"name": name})
    set_properties(spark, name, {NEWEST_FOLDER: newest})
    spark.catalog.refreshTable(name)


def bucket_locations(spark: SparkSession, name: str) -> list[str]:
    catalog, table = _session_catalog(spark, name)
    parts = catalog.listPartitions(table, spark._jvm.scala.Option.empty())
    return [parts.apply(i).location().toString() for i in range(parts.size())]


def _session_catalog(spark: SparkSession, name: str):
    """The session's catalog and the table's name as it has it, for what SQL has no statement for."""
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.catalog().qualifyIdentifier(state.sqlParser().parseTableIdentifier(name))


def registered_buckets(spark: SparkSession, name: str) -> set[int]:
    rows = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name}).collect()
    return {int(row[0].rpartition("=")[2]) for row in rows}


def _partition(number: int) -> str:
    return f"PARTITION ({BUCKET_COLUMN} = {int(number)})"


def _bucket_folder(location: str, number: int) -> str:
    return f"{location}/{BUCKET_COLUMN}={int(number)}"


def _ddl(fields: Sequence[T.StructField]) -> str:
    return T.StructType(list(fields)).toDDL()
