"""Upsert by key as a DataFrame expression: what a table holds after a merge of new rows into it.

Every target row is kept. A matched row takes the source's value in each shared column, NULLs included, an
unmatched source row is added, and nothing is deleted. There are two plans for it:

* Two joins. The updated rows are target LEFT JOIN source: a small source is broadcast and the target is not
  shuffled at all; otherwise adaptive execution splits a hot target key, because the source side holds at most
  one row per key. The inserted rows are those of the source whose key is not among the target's keys; only the
  target's key columns are read for it, and they are made distinct before they are shuffled.
* One full outer join. It reads and shuffles the target once, but it can be neither broadcast nor split when a
  key is hot, so it is for a target known to have no such key.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.keys import any_null, same_keys
from tierlake.functions.names import by_name, column_name, fold
from tierlake.functions.schema import SchemaError, evolved, grown, nullable
from tierlake.functions.sizing import added, fits_broadcast, fixed_parts, planned_bytes

NULL_KEY_RULES = ("error", "insert", "drop")
COUNT, HOT, SALT = "__rows_of_key", "__hot_key", "__salt"
# A source row with a hot key is repeated once per salt, and there are fewer hot keys than salts.
MOST_SALTS = 2000


class Split(NamedTuple):
    """A prepared source: at most one row per key to match, and rows to add without looking for a match."""

    matching: DataFrame
    direct: DataFrame


class Merged(NamedTuple):
    """The two parts of a merge result, with the same columns."""

    updated: DataFrame
    inserted: DataFrame


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    evolve: bool = True,
    null_keys: str = "error",
    dedupe_by: str | None = None,
    unique_source: bool = False,
) -> DataFrame:
    """`target` after an upsert of `source` on `keys`.

    evolve: add columns only the source has (NULL in untouched rows) and let the source lack some; without it
        the target's columns are the result's, extra ones are dropped and missing ones are an error. Structs grow likewise,
        also in arrays and maps. A nested value is updated as a whole: inner fields that the source lacks become NULL.
    null_keys: a NULL key matches nothing. "insert" adds such rows on every run, "drop" leaves them out, and
        "error" fails the query.
    dedupe_by: keep only the row with the greatest value in this column for each key. Without it, several source
        rows for one target row fail the query; several rows for a new key are all added.
    unique_source: no key but NULL repeats in the source, so the plan need not look for repetition.

    This is one lazy plan that reads the source several times. Adaptive execution splits a hot target key over tasks only
    with `unique_source`, as it does between two plain shuffles; without, the plan salts it, for which the target's keys
    are read once more, and fixes the number of its partitions by the size of the files, if the source is too large to
    broadcast, so that no task's rows grow with the tables. `tierlake.operators.publish.upsert` merges into a stored table without either limit.
    """
    keys = resolved_keys(target, keys)
    prepared = prepare_source(target, source, keys, evolve=evolve, null_keys=null_keys, dedupe_by=dedupe_by)
    if unique_source or dedupe_by is not None:
        updated, inserted = merge_in_two_joins(target, split_unique(prepared, keys), keys)
    else:
        parts = _parts(target, source)
        split = split_repeated(prepared, keys, repeated_keys(prepared, keys, parts), parts)
        updated, inserted = merge_in_two_joins(target, split, keys, salts=_salts(target.sparkSession), parts=parts)
    return updated.union(inserted)


def _parts(target: DataFrame, source: DataFrame) -> int | None:
    """The number of partitions to fix; None if it is left to Spark, as it must be if Spark is to broadcast the source."""
    spark, own = target.sparkSession, planned_bytes(source)
    if own is None or fits_broadcast(spark, own):
        return None
    return fixed_parts(spark, added(own, planned_bytes(target)))


def _dealt(rows: DataFrame, parts: int | None, keys: Sequence[str]) -> DataFrame:
    """Rows by key in a fixed number of partitions, or as they are."""
    return rows.repartition(parts, *[column_name(k) for k in keys]) if parts else rows


def _salts(spark: SparkSession) -> int:
    """Some salts per shuffle partition, so that each partition gets about as many of a hot key's."""
    return min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_SALTS)


def hot_keys(target: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """Hashes of the keys (NULL is one) that hold more than 1 / `salts` of the rows, so fewer than `salts` of them.

    They come out of one pass with a sketch, whose counts are estimates: it may take a key that holds a little less or
    leave out one that holds a little more, which is of no account for the result.
    """
    key = F.xxhash64(*[F.col(column_name(k)) for k in keys])
    sketch = target.select(key.alias("key")).agg(
        F.expr(f"approx_top_k(key, {salts}, {max(10_000, 4 * salts)})").alias("top"), F.count("*").alias("rows")
    )
    found = sketch.select("rows", F.inline("top")).filter(F.col("count") * salts > F.col("rows"))
    return found.select(F.col("item").alias(HOT))


def salted(
    target: DataFrame, matching: DataFrame, keys: Sequence[str], salts: int, hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: rows of a hot target key are dealt over `salts` of them, and the source's row has all.

    A row's salt follows from its values, so that a repeated task deals it in the same way; rows that are equal in all of
    them stay together.
    """

    def beside(rows: DataFrame) -> DataFrame:
        return rows.join(hot, _is_hot(keys), "left")

    plain = [F.col(column_name(f.name)) for f in target.schema.fields if _sortable(f.dataType)]  # what can be hashed
    own = F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")
    dealt = beside(target).withColumn(SALT, F.when(F.col(HOT).isNotNull(), own).otherwise(0)).drop(HOT)
    all_salts = F.when(F.col(HOT).isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dealt, beside(matching).withColumn(SALT, F.explode(all_salts)).drop(HOT)


def _is_hot(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(column_name(k)) for k in keys]) == F.col(HOT)


def prepare_source(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    evolve: bool = True,
    null_keys: str = "error",
    dedupe_by: str | None = None,
) -> DataFrame:
    """Source rows in the target's types, with the NULL key rule and the choice among duplicates applied."""
    keys = resolved_keys(target, keys)
    source = _aligned(target, source, keys, evolve, extra=[dedupe_by] if dedupe_by else [])
    kept = source.columns if dedupe_by is None else _aligned(target, source, keys, evolve).columns
    source = apply_null_rule(source, keys, null_keys)
    if dedupe_by is not None:
        source = latest_per_key(source, keys, dedupe_by, null_keys)
    return source.select([column_name(c) for c in kept])


def resolved_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Key names as `df` spells them."""
    keys = [keys] if isinstance(keys, str) else keys
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    columns = by_name(df.sparkSession, df.columns)
    missing = [k for k in keys if fold(df.sparkSession, k) not in columns]
    if missing:
        raise SchemaError(f"columns {missing} are not among {df.columns}")
    return [columns[fold(df.sparkSession, k)] for k in keys]


def apply_null_rule(source: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    if rule not in NULL_KEY_RULES:
        raise ValueError(f"null_keys must be one of {NULL_KEY_RULES}, not {rule!r}")
    if rule == "drop":
        return source.filter(~any_null(keys))
    if rule == "error":
        message = f"NULL_KEY: a source row has NULL in a key column ({', '.join(keys)})"
        checked = F.when(any_null(keys), F.raise_error(F.lit(message))).otherwise(F.col(column_name(keys[0])))
        return source.withColumn(keys[0], checked)
    return source


def latest_per_key(source: DataFrame, keys: Sequence[str], order: str, null_keys: str = "insert") -> DataFrame:
    """One row per key, the one with the greatest `order`; rows with a NULL key all stay.

    Of several rows with that order it is the one whose other columns, from left to right, are greatest, NULL being
    least, so the answer does not depend on how rows are dealt over tasks. Columns that cannot be sorted, such as
    maps, are not compared. The source is read once.
    """
    row = F.struct(*[F.col(column_name(c)) for c in source.columns])
    others = [f.name for f in source.schema.fields if _sortable(f.dataType)]
    first = F.struct(*[F.col(column_name(c)) for c in (order, *others)])
    groups = [F.col(column_name(k)) for k in keys]
    if null_keys == "insert":  # a group of its own for each row without a key
        groups.append(F.when(any_null(keys), F.monotonically_increasing_id()))
    names = [f"g{i}" for i in range(len(groups))]
    grouped = source.groupBy([g.alias(n) for g, n in zip(groups, names)])
    return grouped.agg(F.max_by(row, first).alias("row")).select("row.*")


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, T.MapType) and kind.typeName() != "variant"


def split_unique(source: DataFrame, keys: Sequence[str]) -> Split:
    """The split of a source in which no key but NULL repeats."""
    return Split(source.filter(~any_null(keys)), source.filter(any_null(keys)))


def repeated_keys(source: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Keys that several source rows share, with their number of rows."""
    keyed = _dealt(source.filter(~any_null(keys)), parts, keys)
    counted = keyed.groupBy([column_name(k) for k in keys]).agg(F.count("*").alias(COUNT))
    return counted.filter(F.col(COUNT) > 1)


def split_repeated(source: DataFrame, keys: Sequence[str], repeated: DataFrame, parts: int | None = None) -> Split:
    """The split of any other source.

    Repeated keys may only be new, so their rows need no matching. One row with the key and the count stands for
    them among the rows to match, and a target row that meets it fails the query.
    """
    columns = [column_name(c) for c in source.columns]
    keyed, loose = split_unique(source, keys)
    keyed = _dealt(keyed, parts, keys)
    matching = keyed.join(repeated, keys, "left_anti").unionByName(repeated, allowMissingColumns=True)
    return Split(matching, keyed.join(repeated, keys, "left_semi").select(columns).union(loose))


def merge_in_two_joins(
    target: DataFrame,
    source: Split,
    keys: Sequence[str],
    *,
    broadcast_source: bool | None = None,
    salts: int = 0,
    parts: int | None = None,
) -> Merged:
    """Both parts of the merge, whatever the keys of the target.

    broadcast_source: the caller has compared the size of the source to Spark's limit; None leaves that to Spark.
    salts: into how many parts a hot target key is dealt by the plan itself; 0 leaves that to adaptive execution.
    parts: with salts, into how many partitions the plan itself deals both sides; None leaves that to adaptive execution.
    """
    keys = resolved_keys(target, keys)
    schema = evolved(target.sparkSession, target.schema, source.direct.schema)
    target = grown(target, schema)
    names, columns = [column_name(k) for k in keys], [column_name(c) for c in source.direct.columns]
    matching = source.matching
    if broadcast_source is not None:
        matching = matching.hint("broadcast" if broadcast_source else "merge")
    dealt, on = target, list(keys)
    if salts > 1:
        hot = F.broadcast(hot_keys(target, keys, salts))
        (dealt, matching), on = salted(target, matching, keys, salts, hot), [*keys, SALT]
        dealt, matching = _dealt(dealt, parts, on), _dealt(matching, parts, on)
    joined = dealt.alias("t").join(matching.alias("s"), same_keys("t", "s", on), "left")
    if COUNT in source.matching.columns:
        joined = joined.filter(_single(keys, F.lit(True)))
    updated = joined.select(_merged_columns(schema, target, source.matching, keys))

    single = source.matching
    if COUNT in single.columns:
        single = single.filter(F.col(COUNT).isNull()).select(columns)
    if salts > 1 and parts:
        # Hot keys are few, and only they have to be made distinct.
        present = target.select(names).filter(~any_null(keys))
        cold = _dealt(present.join(hot, _is_hot(keys), "left_anti"), parts, keys)
        often = F.broadcast(present.join(hot, _is_hot(keys), "left_semi").distinct())
        fresh = single.join(cold, keys, "left_anti").join(often, keys, "left_anti").select(columns).union(source.direct)
        return Merged(updated, fresh.to(schema))
    present, wanted = target.select(names).distinct(), single.select(names)
    if broadcast_source is not False:
        # Spark moves this semi join below the distinct if the source is small enough to broadcast, so that only
        # keys found in the source are shuffled. Otherwise it would change nothing.
        present = present.join(F.broadcast(wanted) if broadcast_source else wanted, keys, "left_semi")
    fresh = single.join(present, keys, "left_anti").select(columns).union(source.direct)
    return Merged(updated, fresh.to(schema))


def merge_in_one_join(target: DataFrame, source: Split, keys: Sequence[str]) -> Merged:
    """The same merge reading the target once, for a target in which no key holds a large share of the rows."""
    keys = resolved_keys(target, keys)
    schema = evolved(target.sparkSession, target.schema, source.direct.schema)
    target = grown(target, schema)
    joined = target.alias("t").join(source.matching.alias("s"), same_keys("t", "s", keys), "full")
    if COUNT in source.matching.columns:  # rows that stand for a repeated key have done their work
        joined = joined.filter(_single(keys, F.col(f"t.{column_name(keys[0])}").isNotNull()))
    columns = _merged_columns(schema, target, source.matching, keys, key_from_either=True)
    return Merged(joined.select(columns), source.direct.to(schema))


def _merged_columns(
    schema: T.StructType,
    target: DataFrame,
    matching: DataFrame,
    keys: Sequence[str],
    *,
    key_from_either: bool = False,
) -> list[Column]:
    spark = target.sparkSession
    in_target, in_source = by_name(spark, target.columns), by_name(spark, matching.columns)
    matched = F.col(f"s.{column_name(keys[0])}").isNotNull()
    columns = []
    for field in schema.fields:
        name = fold(spark, field.name)
        old = F.col(f"t.{column_name(in_target[name])}") if name in in_target else None
        new = F.col(f"s.{column_name(in_source[name])}") if name in in_source else None
        if field.name in keys:
            value = F.coalesce(old, new) if key_from_either else old
        elif old is None:
            value = new
        elif new is None:
            value = old
        else:
            value = F.when(matched, new).otherwise(old)
        columns.append(value.alias(field.name))
    return columns


def _single(keys: Sequence[str], in_target: Column) -> Column:
    """Whether a row is one of the result, or an error for a target row that meets a repeated key.

    As a filter it is kept whatever columns are read.
    """
    shown = F.concat_ws(", ", *[F.col(f"s.{column_name(k)}").cast("string") for k in keys])
    message = f"REPEATED_SOURCE_KEY: several source rows match one target row on ({', '.join(keys)}): "
    error = F.raise_error(F.concat(F.lit(message), shown)).cast("boolean")
    return F.when(F.col(f"s.{COUNT}").isNull(), True).when(~in_target, False).otherwise(error)


def _aligned(
    target: DataFrame, source: DataFrame, keys: Sequence[str], evolve: bool, extra: Sequence[str] = ()
) -> DataFrame:
    """Source columns in result order and target types. Columns only the target has stay absent."""
    spark = target.sparkSession
    resolved_keys(source, [*keys, *extra])
    have = by_name(spark, source.columns)
    if evolve:
        fields = evolved(spark, target.schema, source.schema).fields
    else:
        fields = nullable(target.schema).fields
        missing = [f.name for f in fields if fold(spark, f.name) not in have]
        if missing:
            raise SchemaError(f"the source lacks {missing}, and the schema may not evolve")
    fields = [f for f in fields if fold(spark, f.name) in have]
    known = {fold(spark, f.name) for f in fields}
    fields += [source.schema[have[fold(spark, e)]] for e in extra if fold(spark, e) not in known]
    return source.to(T.StructType(fields))
