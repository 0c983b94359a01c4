"""Table names, column names and text that goes into SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def qualified_name(table: str, schema: str | None = None, catalog: str | None = None) -> str:
    """One-, two- or three-part table name. A catalog without a schema is ignored."""
    if schema and catalog:
        return f"{catalog}.{schema}.{table}"
    return f"{schema}.{table}" if schema else table


def column_name(name: str) -> str:
    """`name` as a quoted column reference, so dots and blanks in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def relation(name: str) -> str:
    """`name` for a FROM clause; Spark parses it as a name and as nothing else."""
    return f"IDENTIFIER({text_literal(name)})"


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


def by_name(spark: SparkSession, names: Iterable[str]) -> dict[str, str]:
    """Names indexed the way this session compares them."""
    return {fold(spark, name): name for name in names}


def fold(spark: SparkSession, name: str) -> str:
    return name if case_sensitive(spark) else name.lower()


def repeated_names(spark: SparkSession, names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    repeated = []
    for name in names:
        folded = fold(spark, name)
        if folded in seen:
            repeated.append(name)
        seen.add(folded)
    return repeated
