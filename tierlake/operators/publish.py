"""Writing keyed tables: first load, upsert and overwrite.

Spark cannot overwrite files it is reading, so every write goes to a fresh folder below the table's path and
the catalog is pointed at it afterwards. A reader sees the old rows or the new ones, a failed job leaves the
table as it was, and no write ever deletes a file; `remove_unused` does, on request.

A plain table switches as a whole. A table with buckets is partitioned by a function of its key, and an upsert
rewrites and switches only the buckets its source touches, in one call to the catalog; running the same upsert again
completes one that was cut short. A job holds a claim on the table's path while it writes, so there is one at a time.

Each folder that is written also holds a small file that says how its rows are laid out, and, once the catalog points to
it, one that says so. From these a table the catalog has lost can be found again by its path; what a job has written and
not published is never taken for the table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Sequence
from contextlib import ExitStack
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.keys import any_null, bucket_of
from tierlake.functions.names import by_name, column_name, fold
from tierlake.functions.schema import SchemaError, conform, evolved, nullable
from tierlake.functions.sizing import TASK_ROWS, added, fits_broadcast, planned_bytes, room_to_shuffle, row_bytes, size_setting
from tierlake.functions.storage import (
    committed_folders,
    folder_names,
    name_time,
    plain_path,
    read_text,
    remove_folder,
    staged,
    unique_name,
    write_text,
)
from tierlake.operators import delta
from tierlake.operators.claims import claimed
from tierlake.operators.tables import (
    BUCKET_COLUMN,
    BUCKETS,
    KEYS,
    Layout,
    PublishError,
    add_columns,
    bucket_locations,
    check_unmoved,
    check_writable,
    read_table,
    register_external_table,
    registered_buckets,
    restored_buckets,
    switch_buckets,
    switch_table,
    table_exists,
    table_layout,
)
from tierlake.operators.upsert import (
    Merged,
    Split,
    apply_null_rule,
    latest_per_key,
    merge_in_one_join,
    merge_in_two_joins,
    prepare_source,
    repeated_keys,
    resolved_keys,
    split_repeated,
    split_unique,
)

# A key with at most this many rows is no burden for the task that gets it.
FEW_ROWS = 10_000
PLANS = ("broadcast", "one join", "two joins")
# Beside the files of each folder that is written: how they are laid out, and, once the catalog points to them, what the
# table then was.
LAYOUT_FILE, MARKER = "_tierlake.json", "_tierlake_published.json"
# What the names of these folders begin with.
FOLDER = "v"


def first_load(
    spark: SparkSession,
    name: str,
    path: str,
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    buckets: int | str | None = None,
) -> None:
    """Write all rows as they are to a new folder below `path` and register them as table `name`.

    buckets: how many parts to split the table into by a hash of its key, or a whole-number expression of the
        key columns that names the part, such as "id DIV 1000000", which keeps rows with neighbouring keys together.
    """
    with claimed(spark, name, path) as check:
        _first_load(spark, name, path, df, check, keys, buckets)


def _first_load(
    spark: SparkSession,
    name: str,
    path: str,
    df: DataFrame,
    check: Callable[[], None],
    keys: Sequence[str] = (),
    buckets: int | str | None = None,
) -> None:
    published = set(_published(spark, path))
    # What a job of this package has written and not published is nobody's table.
    if left := [f for f in committed_folders(spark, path) if f in published or not _written_at(f)]:
        raise PublishError(
            f"{name} is not in the catalog, but {path} holds complete folders, the newest being {left[-1]}; "
            "register them with register_path or register_external_table, or choose an empty path"
        )
    properties, partitioned_by = {}, []
    if buckets:
        keys = resolved_keys(df, keys)
        _check_buckets(df, keys, buckets)
        properties = {BUCKETS: json.dumps(buckets), KEYS: json.dumps(list(keys))}
        partitioned_by = [BUCKET_COLUMN]
        df = _with_bucket(df, keys, buckets)
        with room_to_shuffle(spark, planned_bytes(df), _hashed(buckets)):
            location = _write(_spread(df), path, buckets, keys)
    else:
        location = _write(df, path)
    check()
    register_external_table(
        spark, name, location, nullable(df.schema), partitioned_by=partitioned_by, properties=properties
    )
    _mark(spark, name)


def upsert(
    spark: SparkSession,
    name: str,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    evolve: bool = True,
    null_keys: str = "error",
    dedupe_by: str | None = None,
    buckets: int | str | None = None,
    table_format: str | None = None,
    plan: str | None = None,
) -> None:
    """Merge `source` into table `name`, or load it whole when there is no such table yet.

    The rules for columns, duplicates and NULL keys are those of `merge_upsert`; a first load takes duplicate
    keys as they are. A table that the catalog has lost is found by `path` and merged into; one that is in the
    catalog must lie below it.

    table_format: "parquet", unless given as "delta", for a new table; an existing one keeps its own. `buckets` too
        only matters for a new table, and a Delta table has none.
    plan: "broadcast", "one join" or "two joins" to have that plan of the merge instead of the one that sizes and
        counts per key speak for. "one join" is only right if no key of the table is hot.
    """
    table_format = _known_format(table_format, buckets)
    if plan is not None and plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}, not {plan!r}")
    rules = {"evolve": evolve, "null_keys": null_keys, "dedupe_by": dedupe_by}
    if _is_delta(spark, name, table_format):  # which has transactions of its own
        _upsert_delta(spark, name, path, source, keys, **rules)
        return
    with claimed(spark, name, path) as check:
        _upsert(spark, name, path, source, keys, check, **rules, buckets=buckets, plan=plan)


def _upsert_delta(spark: SparkSession, name: str, path: str, source: DataFrame, keys: Sequence[str], **rules) -> None:
    if not table_exists(spark, name) and delta.is_table(spark, path):
        delta.register(spark, name, path)
    if not table_exists(spark, name):
        source = _as_first(source, keys, **rules)
        delta.overwrite(source, path, evolve=rules["evolve"])
        delta.register(spark, name, path)
        return
    _check_path(spark, name, table_layout(spark, name), path)
    target = read_table(spark, name)
    keys = resolved_keys(target, keys)
    delta.upsert(spark, name, prepare_source(target, source, keys, **rules), keys, evolve=rules["evolve"])


def _as_first(
    source: DataFrame, keys: Sequence[str], *, null_keys: str, dedupe_by: str | None, evolve: bool = True
) -> DataFrame:
    """The rows of a source as a new table has them."""
    keys = resolved_keys(source, keys)
    source = apply_null_rule(source, keys, null_keys)
    return source if dedupe_by is None else latest_per_key(source, keys, dedupe_by, null_keys)


def _upsert(
    spark: SparkSession,
    name: str,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    check: Callable[[], None],
    *,
    buckets: int | str | None,
    plan: str | None,
    evolve: bool,
    null_keys: str,
    dedupe_by: str | None,
) -> None:
    if not table_exists(spark, name) and _published(spark, path):
        register_path(spark, name, path)
    if not table_exists(spark, name):
        source = _as_first(source, keys, null_keys=null_keys, dedupe_by=dedupe_by)
        _first_load(spark, name, path, source, check, resolved_keys(source, keys), buckets)
        return

    layout, target = _settled(spark, name, path), read_table(spark, name)
    keys = resolved_keys(target, keys)
    if layout.buckets:
        _check_bucket_column(source)
        if list(layout.keys) != keys:
            raise PublishError(f"{name} is bucketed by {list(layout.keys)} and cannot be upserted on {keys}")
    prepared = prepare_source(target, source, keys, evolve=evolve, null_keys=null_keys, dedupe_by=dedupe_by)

    with ExitStack() as staging:
        rows, stored_bytes = staging.enter_context(staged(prepared))
        with room_to_shuffle(spark, stored_bytes, rows=rows.count()):
            profile = _profile(rows, keys, row_bytes(rows.schema))
        if not profile["rows"]:
            check()
            add_columns(spark, name, evolved(spark, target.schema, prepared.schema))
            _mark(spark, name)
            return
        touched = _touched_buckets(rows, keys, layout.buckets) if layout.buckets else []
        part = target
        if layout.buckets:
            part = spark.table(name).filter(F.col(BUCKET_COLUMN).isin(touched)).drop(BUCKET_COLUMN)
        small = fits_broadcast(spark, profile["bytes"]) if plan is None else plan == "broadcast"
        held = part.count()  # which the files tell
        grouped = _stays_grouped(part, layout.buckets, len(touched), small, held)
        if not (small and grouped):
            size = added(stored_bytes, planned_bytes(part))
            staging.enter_context(room_to_shuffle(spark, size, _hashed(layout.buckets), profile["rows"] + held))
        # Only the keys of what is rewritten are counted, and each time: others may write to the table too.
        one_join = plan == "one join" or (plan is None and not small and _profile(part, keys)["most"] <= FEW_ROWS)

        split = _split(rows, keys, profile["repeated"], staging)
        if one_join:
            merged = merge_in_one_join(part, split, keys)
        else:
            merged = merge_in_two_joins(part, split, keys, broadcast_source=small)
        if layout.buckets:
            written = _bucketed(merged, keys, layout.buckets, grouped)
            location = _write(written, path, layout.buckets, keys, whole=False, after=layout.newest_folder)
        else:
            location = _write(merged.updated.union(merged.inserted), path, after=layout.newest_folder)
        _publish(spark, name, layout, location, merged.updated.schema, check, touched)


def overwrite(
    spark: SparkSession, name: str, path: str, df: DataFrame, *, evolve: bool = True, table_format: str | None = None
) -> None:
    """Replace all rows of table `name`, creating it if need be.

    With `evolve`, new columns are added and columns that `df` lacks stay in the table as NULL. Without it, `df`
    must have all columns of the table, and others are dropped. `table_format` is that of a new table.
    """
    table_format = _known_format(table_format)
    if _is_delta(spark, name, table_format):
        if table_exists(spark, name):
            _check_path(spark, name, table_layout(spark, name), path)
            delta.overwrite(df, table_layout(spark, name).location, evolve=evolve)
        else:
            delta.overwrite(df, path, evolve=evolve)
            delta.register(spark, name, path)
        return
    with claimed(spark, name, path) as check:
        _overwrite(spark, name, path, df, check, evolve)


def _overwrite(
    spark: SparkSession, name: str, path: str, df: DataFrame, check: Callable[[], None], evolve: bool
) -> None:
    if not table_exists(spark, name):
        if not _published(spark, path):
            _first_load(spark, name, path, df, check)
            return
        register_path(spark, name, path)
    layout, target = _settled(spark, name, path), read_table(spark, name)
    schema = evolved(spark, target.schema, df.schema) if evolve else nullable(target.schema)
    have = by_name(spark, df.columns)
    missing = [f.name for f in schema.fields if fold(spark, f.name) not in have]
    if missing and not evolve:
        raise SchemaError(f"the new rows lack {missing}, and the schema may not evolve")
    rows, held, gone = conform(df, schema), [], set()
    if layout.buckets:
        _check_bucket_column(df)
        rows = _with_bucket(rows, layout.keys, layout.buckets)
        with room_to_shuffle(spark, planned_bytes(rows), _hashed(layout.buckets)):
            location = _write(_spread(rows), path, layout.buckets, layout.keys, after=layout.newest_folder)
        held = _buckets_in(spark, location)
        gone = registered_buckets(spark, name) - set(held)
    else:
        location = _write(rows, path, after=layout.newest_folder)
    _publish(spark, name, layout, location, schema, check, held, gone)


def grow_buckets(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """Give table `name` more hash buckets, a multiple of those it has, which stay the same rows in smaller parts.

    A key's bucket among m * n is its bucket among n, or that plus a multiple of n, so each task splits the files it reads
    and nothing is shuffled. All buckets switch at once; a job that is cut short is finished by the next writer.
    """
    with claimed(spark, name, path) as check:
        layout = _settled(spark, name, path)
        if not isinstance(layout.buckets, int) or buckets < layout.buckets or buckets % layout.buckets:
            raise PublishError(f"{name} has {layout.buckets} buckets and can only get a multiple of a number of them, not {buckets}")
        if buckets == layout.buckets:
            return
        location = _write(_regrouped(spark, name, layout, buckets), path, buckets, layout.keys, after=layout.newest_folder)
        held, schema = _buckets_in(spark, location), read_table(spark, name).schema
        gone = registered_buckets(spark, name) - set(held)
        _publish(spark, name, layout, location, schema, check, held, gone, {BUCKETS: json.dumps(buckets)})


def _regrouped(spark: SparkSession, name: str, layout: Layout, buckets: int) -> DataFrame:
    return _with_bucket(spark.table(name), layout.keys, buckets)


def register_path(spark: SparkSession, name: str, path: str) -> None:
    """Bring back under `name` a table whose folders lie below `path`, with its buckets and keys.

    The folder published last is the table; where it holds some buckets only, older published ones have the others. Folders
    that were written and never published, by a job that was refused or broke off, are not looked at.
    """
    folders = _published(spark, path)
    if not folders:
        raise PublishError(f"{path} holds no folder that a table was published from")
    location = folders[-1]
    if read_text(spark, f"{location}/{LAYOUT_FILE}") is None:
        raise PublishError(f"{location} does not say how it is laid out; register it with register_external_table")
    layout, was = (json.loads(read_text(spark, f"{location}/{file}")) for file in (LAYOUT_FILE, MARKER))
    schema = T.StructType.fromJson(was["schema"])
    if not layout["buckets"]:
        register_external_table(spark, name, location, schema)
        return
    wanted, where = set(was["buckets"]), {}
    for at in reversed(folders):
        where |= {number: at for number in _buckets_in(spark, at) if number in wanted and number not in where}
        if len(where) == len(wanted):
            break
    if lost := sorted(wanted - where.keys()):
        raise PublishError(f"no published folder below {path} holds the buckets {lost}")
    kind = T.StructField(BUCKET_COLUMN, T.IntegerType() if isinstance(layout["buckets"], int) else T.LongType())
    schema = T.StructType([*schema.fields, kind])
    properties = {BUCKETS: json.dumps(layout["buckets"]), KEYS: json.dumps(layout["keys"])}
    register_external_table(
        spark, name, location, schema, partitioned_by=[BUCKET_COLUMN], properties=properties, recover=False
    )
    restored_buckets(spark, name, where, location)


def remove_unused(spark: SparkSession, name: str, path: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete the folders below `path` that table `name` no longer points into; their names are returned.

    Folders written within the grace period stay for running readers and for a job that has yet to switch. Only
    complete folders that this package has written are looked at, and `path` must be that of the table, whose other
    names in the catalog, if there are any, must not point there.
    """
    layout = table_layout(spark, name)
    check_writable(name, layout)
    _check_path(spark, name, layout, path)
    used = {plain_path(spark, folder) for folder in (layout.location, layout.newest_folder)}
    used |= {plain_path(spark, folder).rpartition("/")[0] for folder in bucket_locations(spark, name)} if layout.buckets else set()
    border = datetime.now(timezone.utc) - older_than
    gone = []
    for folder in committed_folders(spark, path):
        written = _written_at(folder)
        if written and written < border and plain_path(spark, folder) not in used:
            remove_folder(spark, folder)
            gone.append(folder)
    return gone


def _written_at(folder: str) -> datetime | None:
    """When this package began to write a folder; None for any other."""
    return name_time(folder.rstrip("/").rpartition("/")[2], FOLDER)


def _published(spark: SparkSession, path: str) -> list[str]:
    """Folders below `path` that the catalog has pointed to, oldest first."""
    return committed_folders(spark, path, MARKER)


def _mark(spark: SparkSession, name: str) -> None:
    """Note beside the table's newest rows that they are published, and what columns and buckets the table has with them."""
    layout = table_layout(spark, name)
    if _written_at(layout.newest_folder):  # not into a folder that was made elsewhere
        buckets = sorted(registered_buckets(spark, name)) if layout.buckets else None
        was = {"schema": read_table(spark, name).schema.jsonValue(), "buckets": buckets}
        write_text(spark, f"{layout.newest_folder}/{MARKER}", json.dumps(was))


def _settled(spark: SparkSession, name: str, path: str) -> Layout:
    """The layout of a table that may be written to, after finishing a switch that was cut short.

    Its folder is complete, and nobody has written since, as that takes the claim and comes through here.
    """
    layout = table_layout(spark, name)
    check_writable(name, layout)
    _check_path(spark, name, layout, path)
    at = layout.newest_folder
    if _written_at(at) and read_text(spark, f"{at}/{MARKER}") is None:
        if layout.buckets:
            held, written = _buckets_in(spark, at), json.loads(read_text(spark, f"{at}/{LAYOUT_FILE}"))
            gone = registered_buckets(spark, name) - set(held) if written["whole"] else ()
            switch_buckets(spark, name, layout, at, held, gone)
        _mark(spark, name)
    return layout


def _is_delta(spark: SparkSession, name: str, table_format: str) -> bool:
    return (table_layout(spark, name).provider if table_exists(spark, name) else table_format) == "delta"


def _buckets_in(spark: SparkSession, location: str) -> list[int]:
    prefix = f"{BUCKET_COLUMN}="
    return [int(n.removeprefix(prefix)) for n in folder_names(spark, location) if n.startswith(prefix)]


def _known_format(table_format: str | None, buckets: int | str | None = None) -> str:
    if table_format not in (None, "parquet", "delta"):
        raise ValueError(f"table_format must be 'parquet' or 'delta', not {table_format!r}")
    if table_format == "delta" and buckets:
        raise ValueError("a Delta table has no buckets")
    return table_format or "parquet"


def _check_path(spark: SparkSession, name: str, layout: Layout, path: str) -> None:
    """A table stays where it is: a Delta table at `path`, another in a folder right below it."""
    own, given = plain_path(spark, layout.location), plain_path(spark, path)
    if given != (own if layout.provider == "delta" else own.rpartition("/")[0]):
        raise PublishError(f"{name} is at {layout.location}, which is not below {path}")


def _publish(
    spark: SparkSession,
    name: str,
    layout: Layout,
    location: str,
    schema: T.StructType,
    check: Callable[[], None],
    buckets: Sequence[int] = (),
    gone: Collection[int] = (),
    properties: dict[str, str] | None = None,
) -> None:
    """Make the rows just written at `location` those of the table, or of its given buckets; drop those `gone`.

    check: fails if the claim has been lost. Rows that may not be published are deleted.
    """
    try:
        check()
        check_unmoved(spark, name, layout)
    except PublishError:
        remove_folder(spark, location)
        raise
    add_columns(spark, name, schema)
    if layout.buckets:
        switch_buckets(spark, name, layout, location, buckets, gone, properties)
    else:
        switch_table(spark, name, layout, location)
    _mark(spark, name)


def _profile(rows: DataFrame, keys: Sequence[str], width: Column | None = None) -> dict[str, int]:
    """Facts about the keys, in one pass.

    Row count, number of keys that repeat, rows of the most frequent key (NULL included), and, given the width of a
    row, the size of all.
    """
    size = F.sum(width if width is not None else F.lit(0)).alias("bytes")
    grouped = rows.groupBy([column_name(k) for k in keys])
    per_key = grouped.agg(F.count("*").alias("n"), any_null(keys).alias("no_key"), size)
    facts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if((F.col("n") > 1) & ~F.col("no_key")).alias("repeated"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )
    return facts.first().asDict()


def _split(rows: DataFrame, keys: Sequence[str], repeated: int, staging: ExitStack) -> Split:
    if not repeated:
        return split_unique(rows, keys)
    # Both are written out because adaptive execution can only split a hot key between two plain shuffles.
    known = staging.enter_context(staged(repeated_keys(rows, keys))).frame
    matching, direct = split_repeated(rows, keys, known)
    return Split(staging.enter_context(staged(matching)).frame, direct)


def _touched_buckets(rows: DataFrame, keys: Sequence[str], buckets: int | str) -> list[int]:
    """The numbers of the buckets; the catalog holds an entry for each, so there are no more than it can."""
    return [row[0] for row in rows.select(bucket_of(keys, buckets).alias(BUCKET_COLUMN)).distinct().collect()]


def _check_buckets(df: DataFrame, keys: Sequence[str], buckets: int | str) -> None:
    _check_bucket_column(df)
    if isinstance(buckets, str):
        number = df.select([column_name(k) for k in keys]).selectExpr(buckets).schema[0].dataType
        if not isinstance(number, T.IntegralType):
            raise SchemaError(f"buckets must be a whole number, but {buckets!r} is {number.simpleString()}")


def _check_bucket_column(df: DataFrame) -> None:
    if fold(df.sparkSession, BUCKET_COLUMN) in by_name(df.sparkSession, df.columns):
        raise SchemaError(f"a table with buckets cannot have a column named {BUCKET_COLUMN}")


def _hashed(buckets: int | str | None) -> int:
    """The number the shuffle partitions should be a multiple of."""
    return buckets if isinstance(buckets, int) else 1


def _with_bucket(df: DataFrame, keys: Sequence[str], buckets: int | str) -> DataFrame:
    return df.withColumn(BUCKET_COLUMN, bucket_of(keys, buckets))


def _spread(df: DataFrame) -> DataFrame:
    """Rows grouped by bucket; adaptive execution joins small buckets and splits a large one over tasks."""
    return df.hint("rebalance", BUCKET_COLUMN)


def _bucketed(merged: Merged, keys: Sequence[str], buckets: int | str, grouped: bool) -> DataFrame:
    updated, inserted = (_with_bucket(part, keys, buckets) for part in merged)
    return updated.union(_spread(inserted)) if grouped else _spread(updated.union(inserted))


def _stays_grouped(part: DataFrame, buckets: int | str | None, touched: int, source_is_broadcast: bool, rows: int) -> bool:
    """Whether the merged rows can be written without another shuffle to bring buckets together.

    After a broadcast they are grouped as the files they came from, which will do unless earlier upserts have left
    far more files than their size calls for. After a shuffle join they are grouped by hash bucket.
    """
    if not buckets:
        return True
    if not source_is_broadcast:
        return isinstance(buckets, int)
    full_files = (planned_bytes(part) or 0) // size_setting(part.sparkSession, "spark.sql.files.maxPartitionBytes") + rows // TASK_ROWS
    # Counted where the list is, which stays there.
    return len(part._jdf.inputFiles()) <= 4 * (full_files + touched)


def _write(
    df: DataFrame,
    path: str,
    buckets: int | str | None = None,
    keys: Sequence[str] = (),
    whole: bool = True,
    after: str | None = None,
) -> str:
    """A fresh folder below `path` with the `whole` table, or with some of its buckets; its name sorts behind that of `after`."""
    location = f"{path.rstrip('/')}/{unique_name(FOLDER, after and after.rstrip('/').rpartition('/')[2])}"
    # A file is what a later task gets at least, however well its rows compress.
    df.write.partitionBy(*([BUCKET_COLUMN] if buckets else [])).option("maxRecordsPerFile", TASK_ROWS).parquet(location)
    layout = {"buckets": buckets, "keys": list(keys), "whole": whole}
    write_text(df.sparkSession, f"{location}/{LAYOUT_FILE}", json.dumps(layout))
    return location
