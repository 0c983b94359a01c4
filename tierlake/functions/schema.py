"""Declared schemas: conforming a frame to one, finding what does not fit, and additive evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.names import by_name, column_name, fold


class SchemaError(ValueError):
    """A frame does not fit the schema it is meant for."""


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def nullable(schema: T.StructType) -> T.StructType:
    """The same columns, all nullable, inner ones too, as every file-backed table has them."""
    return T.StructType([T.StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in schema.fields])


def _nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return nullable(kind)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


def assert_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """`df` itself if its columns are exactly those declared: names, types, order and nullability."""
    declared = [(f.name, f.dataType, f.nullable) for f in as_schema(schema).fields]
    found = [(f.name, f.dataType, f.nullable) for f in df.schema.fields]
    if found != declared:
        raise SchemaError(
            f"the schema found is not the one declared: {df.schema.toDDL()} and {as_schema(schema).toDDL()}"
        )
    return df


def conform(df: DataFrame, schema: T.StructType | str, *, casts: str = "safe") -> DataFrame:
    """Columns of `df` by name in the order and types of `schema`.

    Columns outside the schema are dropped and missing nullable ones filled with NULL.
    `casts="safe"` allows what Spark allows when storing into a table (so no text to number);
    `casts="try"` also converts text, and a value that does not convert becomes NULL.
    """
    schema = as_schema(schema)
    if casts == "try":
        columns = by_name(df.sparkSession, df.columns)
        df = df.select(
            [
                F.col(column_name(columns[fold(df.sparkSession, f.name)])).try_cast(f.dataType).alias(f.name)
                for f in schema.fields
                if fold(df.sparkSession, f.name) in columns
            ]
        )
    elif casts != "safe":
        raise ValueError(f"casts must be 'safe' or 'try', not {casts!r}")
    return df.to(schema)


def rejects(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows holding a value that `conform(casts="try")` would turn into NULL, as they came."""
    spark, schema = df.sparkSession, as_schema(schema)
    columns = by_name(spark, df.columns)
    lost = F.lit(False)
    for field in schema.fields:
        if fold(spark, field.name) in columns:
            value = F.col(column_name(columns[fold(spark, field.name)]))
            lost = lost | (value.isNotNull() & value.try_cast(field.dataType).isNull())
    return df.filter(lost)


def evolved(spark: SparkSession, target: T.StructType, source: T.StructType) -> T.StructType:
    """`target` followed by the columns only `source` has; shared columns keep the target's type.

    Structs grow in the same way, also inside arrays and as values of maps. A key of a map cannot: two keys that differ in
    the new field alone would become one where it is dropped.
    """
    return nullable(_union(spark, target, source, ""))


def _union(spark: SparkSession, target: T.StructType, source: T.StructType, prefix: str) -> T.StructType:
    fields = {fold(spark, f.name): f for f in target.fields}
    for field in source.fields:
        old, name = fields.get(fold(spark, field.name)), f"{prefix}{field.name}"
        if old is not None:
            kind = _grown(spark, old.dataType, field.dataType, name)
            fields[fold(spark, field.name)] = T.StructField(old.name, kind, old.nullable, old.metadata)
        elif _untyped(field.dataType):
            raise SchemaError(f"new column {name} has no type; cast it before writing")
        else:
            fields[fold(spark, field.name)] = T.StructField(field.name, field.dataType, True)
    return T.StructType(list(fields.values()))


def _grown(spark: SparkSession, old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return _union(spark, old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_grown(spark, old.elementType, new.elementType, name), old.containsNull)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if _grown(spark, old.keyType, new.keyType, name) != old.keyType:
            raise SchemaError(f"keys of the map {name} have new inner fields, and keys cannot grow")
        return T.MapType(old.keyType, _grown(spark, old.valueType, new.valueType, name), old.valueContainsNull)
    return old


def _untyped(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_untyped(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _untyped(kind.elementType)
    if isinstance(kind, T.MapType):
        return _untyped(kind.keyType) or _untyped(kind.valueType)
    return isinstance(kind, T.NullType)


def grown(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the types that its columns have in `schema`, which may be structs with more inner fields: NULL in its rows."""
    wanted = {fold(df.sparkSession, f.name): f for f in schema.fields}
    fields = [T.StructField(f.name, wanted[fold(df.sparkSession, f.name)].dataType, True) for f in df.schema.fields]
    return df if nullable(df.schema) == nullable(T.StructType(fields)) else df.to(T.StructType(fields))
