"""Key columns: comparing ids of different types, unwrapping document ids, hashing keys into buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.names import column_name


def compared_as_text(left: T.DataType, right: T.DataType) -> bool:
    """Whether ids of these types are compared as text.

    A relational key is a number and a document key is text. Left alone, Spark would cast the text to a
    number and fail on the first id that is not one.
    """
    return isinstance(left, T.StringType) != isinstance(right, T.StringType)


def join_key(column: Column, as_text: bool) -> Column:
    return column.cast("string") if as_text else column


def plain_object_id(column: Column) -> Column:
    """A document id read as text: `{"$oid": "64f0"}` becomes `64f0`, any other id stays as it is."""
    return F.coalesce(F.get_json_object(column, "$['$oid']"), column)


def any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(column_name(key)).isNull()
    return found


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of all keys between two aliased frames. NULL keys match nothing."""
    matches = [F.col(f"{left}.{column_name(k)}") == F.col(f"{right}.{column_name(k)}") for k in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    return condition


def bucket_of(keys: Sequence[str], buckets: int | str) -> Column:
    """Bucket number of a key. Key columns must already have the table's types: the hash depends on them.

    buckets: a number of buckets, or a whole-number expression of the key columns; NULL in it counts as 0.
    The hash is the one Spark shuffles by, so after a shuffle join on the keys each task holds rows of one bucket
    if the number of shuffle partitions is a multiple of that of buckets.
    """
    if isinstance(buckets, str):
        return F.coalesce(F.expr(buckets).cast("bigint"), F.lit(0))
    return F.pmod(F.hash(*[F.col(column_name(k)) for k in keys]), F.lit(buckets))
