"""The upsert contract, case by case and against brute force."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierlake import SchemaError, merge_upsert
from tierlake.operators.upsert import (
    apply_null_rule,
    latest_per_key,
    merge_in_one_join,
    repeated_keys,
    split_repeated,
)

KV = "k INT, v STRING"


def frame(spark, data, schema=KV):
    return spark.createDataFrame(data, schema)


def test_matched_updated_unmatched_inserted_rest_kept(spark):
    out = merge_upsert(frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B"), (3, "C")]), ["k"])
    assert rows(out) == [(1, "a"), (2, "B"), (3, "C")]


def test_source_null_overwrites(spark):
    assert rows(merge_upsert(frame(spark, [(1, "a")]), frame(spark, [(1, None)]), ["k"])) == [(1, None)]


def test_null_keys_are_an_error_by_default(spark):
    with pytest.raises(Exception, match="NULL_KEY"):
        merge_upsert(frame(spark, [(1, "a")]), frame(spark, [(None, "s")]), ["k"]).collect()


def test_null_keys_inserted_again_on_every_run(spark):
    target, source = frame(spark, [(1, "a"), (None, "t")]), frame(spark, [(1, "b"), (None, "s"), (2, None)])
    once = merge_upsert(target, source, ["k"], null_keys="insert")
    assert rows(once) == [(None, "s"), (None, "t"), (1, "b"), (2, None)]
    twice = merge_upsert(once, source, ["k"], null_keys="insert")
    assert rows(twice) == [(None, "s"), (None, "s"), (None, "t"), (1, "b"), (2, None)]


def test_null_keys_dropped(spark):
    out = merge_upsert(frame(spark, [(None, "t")]), frame(spark, [(None, "s"), (1, "a")]), ["k"], null_keys="drop")
    assert rows(out) == [(None, "t"), (1, "a")]


def test_unknown_null_rule(spark):
    with pytest.raises(ValueError, match="null_keys"):
        merge_upsert(frame(spark, []), frame(spark, []), ["k"], null_keys="keep")


def test_repeated_target_key_updates_every_row_and_keeps_other_columns(spark):
    target = frame(spark, [(1, "a", "x"), (1, "a2", "x2")], "k INT, v STRING, w STRING")
    assert rows(merge_upsert(target, frame(spark, [(1, "b")]), ["k"])) == [(1, "b", "x"), (1, "b", "x2")]


def test_repeated_source_key_with_match_fails(spark):
    target, source = frame(spark, [(1, "a"), (5, "e")]), frame(spark, [(1, "b"), (1, "c"), (6, "f")])
    with pytest.raises(Exception, match="REPEATED_SOURCE_KEY.*: 1"):
        merge_upsert(target, source, ["k"]).collect()


def test_repeated_source_key_without_match_inserts_all(spark):
    out = merge_upsert(frame(spark, [(1, "a")]), frame(spark, [(2, "b"), (2, "c"), (1, "z")]), ["k"])
    assert rows(out) == [(1, "z"), (2, "b"), (2, "c")]


def test_filter_on_a_merge_with_repeated_new_keys_does_not_fail(spark):
    out = merge_upsert(frame(spark, [(1, "a"), (3, "c")]), frame(spark, [(2, "b"), (2, "c")]), ["k"])
    assert rows(out.filter("k = 3")) == [(3, "c")]
    assert rows(out.filter("k = 2")) == [(2, "b"), (2, "c")]


def test_dedupe_takes_the_latest_row_even_without_an_order(spark):
    data = [(1, "old", 1), (1, "new", 2), (2, "only", None), (3, "x", None), (3, "y", 0)]
    out = merge_upsert(frame(spark, [(1, "a")]), frame(spark, data, KV + ", ts INT"), ["k"], dedupe_by="ts")
    assert rows(out) == [(1, "new", 2), (2, "only", None), (3, "y", 0)]


def test_dedupe_column_need_not_be_in_a_fixed_target(spark):
    source = frame(spark, [(1, "old", 1), (1, "new", 2), (None, "n", 1), (None, "n", 2)], KV + ", ts INT")
    out = merge_upsert(
        frame(spark, [(1, "a")]), source, ["k"], dedupe_by="ts", evolve=False, null_keys="insert"
    )
    assert rows(out) == [(None, "n"), (None, "n"), (1, "new")]


def test_evolution_adds_columns_and_fills_missing_ones(spark):
    target = frame(spark, [(1, "a", 1.0), (2, "b", 2.0)], "k INT, v STRING, w DOUBLE")
    source = frame(spark, [("n2", 2, "B"), ("n3", 3, "C")], "extra STRING, k INT, v STRING")
    out = merge_upsert(target, source, ["k"])
    assert out.columns == ["k", "v", "w", "extra"]
    assert rows(out) == [(1, "a", 1.0, None), (2, "B", 2.0, "n2"), (3, "C", None, "n3")]


def test_fixed_schema_drops_extra_and_demands_the_rest(spark):
    target = frame(spark, [(1, "a")])
    source = frame(spark, [(1, "b", 9)], KV + ", extra INT")
    assert rows(merge_upsert(target, source, ["k"], evolve=False)) == [(1, "b")]
    with pytest.raises(SchemaError, match="lacks"):
        merge_upsert(target, source.select("k"), ["k"], evolve=False)


def test_target_type_wins_and_unsafe_casts_fail(spark):
    target = frame(spark, [(1, "a", 1)], "k BIGINT, v STRING, n INT")
    out = merge_upsert(target, frame(spark, [(1, 7, 2.9)], "k INT, v INT, n DOUBLE"), ["k"])
    assert out.schema.simpleString() == "struct<k:bigint,v:string,n:int>"
    assert rows(out) == [(1, "7", 2)]
    with pytest.raises(Exception, match="n"):
        merge_upsert(target, frame(spark, [(1, "a", "x")], "k BIGINT, v STRING, n STRING"), ["k"])


def test_names_are_compared_as_the_session_does(spark):
    target, source = frame(spark, [(1, "a")], "Id INT, V STRING"), frame(spark, [(1, "b")], "ID INT, v STRING")
    out = merge_upsert(target, source, ["id"])
    assert out.columns == ["Id", "V"] and rows(out) == [(1, "b")]


def test_odd_column_names(spark):
    odd = "`a.b` INT, `c d` STRING, `e``f` STRING"
    out = merge_upsert(frame(spark, [(1, "x", "y")], odd), frame(spark, [(1, "X", "Y"), (2, "Z", "W")], odd), ["a.b"])
    assert rows(out) == [(1, "X", "Y"), (2, "Z", "W")]


def test_nested_and_other_types_pass_through(spark):
    ddl = "k INT, s STRUCT<a: INT, b: ARRAY<STRING>>, m MAP<STRING, INT>, d DECIMAL(12,2), t TIMESTAMP_NTZ"
    one = spark.sql("SELECT 1 k, struct(1 a, array('x') b) s, map('a', 1) m, 1.25BD d, TIMESTAMP_NTZ '2020-01-01' t")
    target = one.to(spark.createDataFrame([], ddl).schema)
    source = target.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("m", F.expr("map('b', 2)"))
    out = merge_upsert(target, source, ["k"])
    assert [(r.k, r.m, r.s.b) for r in out.sort("k").collect()] == [(1, {"b": 2}, ["x"]), (2, {"b": 2}, ["x"])]


@pytest.mark.parametrize("unique", [False, True])
def test_structs_gain_and_lose_inner_fields(spark, unique):
    target = spark.sql("SELECT id AS k, struct(id AS a) AS s, array(struct(id AS x)) AS l FROM range(3)")
    source = spark.sql("SELECT id AS k, array(struct('n' AS y), NULL) AS l, struct(id * 10 AS b) AS s FROM range(2, 4)")
    out = merge_upsert(target, source, ["k"], unique_source=unique)
    assert out.columns == ["k", "s", "l"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [
        (0, (0, None), [(0, None)]),
        (1, (1, None), [(1, None)]),
        (2, (None, 20), [(None, "n"), None]),  # updated as a whole
        (3, (None, 30), [(None, "n"), None]),
    ]
    fixed = merge_upsert(target, source, ["k"], evolve=False, unique_source=unique)
    assert [tuple(r) for r in fixed.orderBy("k").collect()][2:] == [(2, (None,), [(None,), None]), (3, (None,), [(None,), None])]


def test_missing_key(spark):
    with pytest.raises(SchemaError, match="nope"):
        merge_upsert(frame(spark, []), frame(spark, []), ["nope"])
    with pytest.raises(SchemaError, match="ts"):
        merge_upsert(frame(spark, []), frame(spark, []), ["k"], dedupe_by="ts")
    with pytest.raises(ValueError):
        merge_upsert(frame(spark, []), frame(spark, []), [])


def brute_force(target, source, n_keys, columns):
    """The contract on lists of dicts; None when it demands an error."""
    key = lambda r: tuple(r[c] for c in columns[:n_keys])
    result, hit = [], set()
    for old in target:
        matches = [] if None in key(old) else [s for s in source if key(s) == key(old)]
        if len(matches) > 1:
            return None
        hit.update(key(m) for m in matches)
        result.append({**old, **matches[0]} if matches else dict(old))
    result += [dict(s) for s in source if None in key(s) or key(s) not in hit]
    return result


@pytest.mark.parametrize("seed", range(12))
def test_random_tables_match_brute_force(spark, seed):
    rng = random.Random(seed)
    n_keys = rng.choice([1, 2])
    keys = [f"k{i}" for i in range(n_keys)]
    t_cols, s_cols = [*keys, "a", "b"], [*keys, *rng.choice([["a", "b"], ["a"], ["b", "c"], ["c"]])]

    def table(columns, size, null_share, unique):
        made, seen = [], set()
        for _ in range(size):
            key = tuple(None if rng.random() < null_share else rng.randrange(12) for _ in keys)
            if unique and key in seen and None not in key:
                continue
            seen.add(key)
            rest = [rng.choice([None, rng.randrange(100)]) for _ in columns[n_keys:]]
            made.append(dict(zip(columns, [*key, *rest])))
        return made

    target = table(t_cols, 15, 0.1, unique=rng.random() < 0.5)
    source = table(s_cols, 12, 0.1, unique=seed % 3 > 0)
    out_cols = t_cols + [c for c in s_cols if c not in t_cols]
    expected = brute_force(target, source, n_keys, out_cols)

    def df(data, columns):
        schema = ", ".join(f"{c} INT" for c in columns)
        return spark.createDataFrame([tuple(r[c] for c in columns) for r in data], schema)

    out = merge_upsert(df(target, t_cols), df(source, s_cols), keys, null_keys="insert")
    if expected is None:
        with pytest.raises(Exception, match="REPEATED_SOURCE_KEY"):
            out.collect()
    else:
        assert out.columns == out_cols
        tuples = [tuple(r.get(c) for c in out_cols) for r in expected]
        assert rows(out) == sorted(tuples, key=lambda r: [(v is not None, str(v)) for v in r])


def test_same_source_twice_equals_once(spark):
    target = spark.range(50).selectExpr("id k", "id v")
    source = spark.range(30, 80).selectExpr("id k", "-id v")
    once = merge_upsert(target, source, ["k"])
    assert rows(merge_upsert(once, source, ["k"])) == rows(once)


@pytest.mark.parametrize("limit", ["-1", "10m"])
@pytest.mark.parametrize("read", [lambda m: m.count(), lambda m: m.select("k").collect(), lambda m: m.select("v").collect()])
def test_repeats_are_noticed_whatever_is_read(spark, conf, limit, read):
    conf(spark__sql__autoBroadcastJoinThreshold=limit, spark__sql__adaptive__autoBroadcastJoinThreshold=limit)
    target = frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    with pytest.raises(Exception, match="REPEATED_SOURCE_KEY"):
        read(merge_upsert(target, frame(spark, [(1, "x"), (1, "y"), (4, "z")]), ["k"]))
    assert merge_upsert(target, frame(spark, [(4, "x"), (4, "y"), (1, "z")]), ["k"]).count() == 5
    split = split_repeated(frame(spark, [(1, "x"), (1, "y"), (4, "z")]), ["k"], repeated_keys(frame(spark, [(1, "x"), (1, "y")]), ["k"]))
    merged = merge_in_one_join(target, split, ["k"])
    with pytest.raises(Exception, match="REPEATED_SOURCE_KEY"):
        read(merged.updated.union(merged.inserted))


TIED = "k INT, ts INT, a STRING, b DOUBLE, m MAP<STRING, INT>"


@pytest.mark.parametrize("null_keys", ["insert", "drop"])
def test_ties_go_to_the_same_row_however_rows_are_dealt(spark, null_keys):
    pick = random.Random(3)
    data = [(pick.choice([None, 1, 2, 3]), pick.choice([None, 1]), pick.choice("ab"), pick.choice([0.5, None]), None) for _ in range(60)]
    results = set()
    for parts in (1, 2, 3, 5, 7):
        pick.shuffle(data)
        source = spark.createDataFrame(data, TIED).repartition(parts)
        out = merge_upsert(frame(spark, []), source, ["k"], dedupe_by="ts", null_keys=null_keys)
        results.add(tuple(rows(out.drop("v"))))
    (result,) = results
    by_key = {k: max(((ts is not None, ts or 0), a, (b is not None, b or 0)) for kk, ts, a, b, _ in data if kk == k) for k in (1, 2, 3)}
    assert {r[0]: r[2] for r in result if r[0]} == {k: best[1] for k, best in by_key.items()}
    assert sum(r[0] is None for r in result) == (sum(d[0] is None for d in data) if null_keys == "insert" else 0)


@pytest.mark.parametrize("null_keys", ["error", "drop", "insert"])
def test_the_latest_rows_are_found_in_one_read(spark, tmp_path, null_keys):
    spark.range(10).selectExpr("id k", "id ts", "'x' v").write.json(f"{tmp_path}/s")
    source = spark.read.schema("k LONG, ts LONG, v STRING").json(f"{tmp_path}/s")
    found = latest_per_key(apply_null_rule(source, ["k"], null_keys), ["k"], "ts", null_keys)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    assert found.count() == 10
