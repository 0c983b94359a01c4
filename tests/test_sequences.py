"""Random batches upserted one after the other into every layout, against a dictionary."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from tierlake import read_table, upsert


def model(state, columns, batch, batch_columns):
    """One batch applied to rows by key; the columns the table has afterwards."""
    columns = columns + [c for c in batch_columns if c not in columns]
    for row in batch:
        key = tuple(row[c] for c in ("k", "j"))
        state[key] = {c: state.get(key, {}).get(c) for c in columns} | row
    return columns


@pytest.mark.parametrize("buckets", [None, 3, "k DIV 5 - j"])
@pytest.mark.parametrize("seed", range(4))
def test_batches(spark, name, path, conf, buckets, seed):
    rng = random.Random(seed)
    state, columns = {}, []
    for number in range(5):
        # At -1 every source counts as large; otherwise all are small enough to broadcast.
        limit = rng.choice(["-1", "10m"])
        conf(spark__sql__autoBroadcastJoinThreshold=limit, spark__sql__adaptive__autoBroadcastJoinThreshold=limit)
        batch_columns = ["k", "j", *rng.sample(["a", "b", f"c{number}"], rng.randint(1, 3))]
        keys = {(rng.randrange(30), rng.randrange(2)) for _ in range(rng.randint(1, 25))}
        batch = [
            dict(zip(batch_columns, [*key, *(rng.choice([None, rng.randrange(99)]) for _ in batch_columns[2:])]))
            for key in sorted(keys)
        ]
        schema = ", ".join(f"{c} INT" for c in batch_columns)
        source = spark.createDataFrame([tuple(r[c] for c in batch_columns) for r in batch], schema)
        upsert(spark, name, path, source, ["k", "j"], buckets=buckets, table_format="parquet")
        columns = model(state, columns, batch, batch_columns)
    table = read_table(spark, name)
    expected = [tuple(row.get(c) for c in columns) for row in state.values()]
    assert table.columns == columns
    assert rows(table) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
