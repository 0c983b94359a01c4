"""The same table operations on the Delta format, for clusters that have its library.

The library brings its own transactional merge, so this only calls it. NULL keys and duplicates chosen by
`dedupe_by` are settled before; several source rows for one target row fail in the library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierlake.functions.names import column_name


def is_table(spark: SparkSession, path: str) -> bool:
    from delta.tables import DeltaTable

    return DeltaTable.isDeltaTable(spark, path)


def register(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(
        "CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) USING DELTA LOCATION :path",
        args={"name": name, "path": path},
    )


def overwrite(df: DataFrame, path: str, *, evolve: bool = True) -> None:
    df.write.format("delta").option("mergeSchema", str(evolve).lower()).mode("overwrite").save(path)


def upsert(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], *, evolve: bool = True) -> None:
    from delta.tables import DeltaTable

    condition = " AND ".join(f"target.{column_name(k)} = source.{column_name(k)}" for k in keys)
    merge = DeltaTable.forName(spark, name).alias("target").merge(source.alias("source"), condition)
    if evolve:
        merge = merge.withSchemaEvolution()
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()
