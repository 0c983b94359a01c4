"""Folders."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierlake.functions.sizing import fits_broadcast, row_bytes
from tierlake.functions.storage import (
    committed_folders,
    name_time,
    folder_names,
    one_process,
    plain_path,
    read_text,
    scratch_folder,
    staged,
    unique_name,
    write_text,
)


class Session:
    """A session as far as its settings go."""

    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_scratch_is_below_the_shared_folder():
    session = Session(spark__checkpoint__dir="hdfs://lake/shared/", spark__master="yarn")
    first, second = scratch_folder(session), scratch_folder(session)
    assert first.startswith("hdfs://lake/shared/tierlake_") and first != second


@pytest.mark.parametrize("master", ["yarn", "k8s://https://host", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    assert not one_process(Session(spark__master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(spark__master=master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2, 3]"])
def test_a_local_session_may_do_without(master):
    session = Session(spark__master=master, spark__sql__warehouse__dir="/lake/warehouse/")
    assert one_process(session)
    assert scratch_folder(session).startswith("/lake/warehouse/.scratch/tierlake_")


def test_small_files_of_text(spark, tmp_path):
    name = f"{tmp_path}/a b/ü.json"
    assert read_text(spark, name) is None
    write_text(spark, name, "é 1")
    write_text(spark, name, "é 2")
    assert read_text(spark, name) == "é 2"
    assert plain_path(spark, f"file://{tmp_path}/a b/") == plain_path(spark, f"{tmp_path}/a b")


def test_names_sort_by_time():
    names = [unique_name("v") for _ in range(50)]
    assert len(set(names)) == 50 and names == sorted(names, key=lambda n: n.split("_")[0])


def test_a_staged_frame_is_the_same_rows_until_it_goes(spark):
    random = spark.range(100).selectExpr("id", "rand() r")
    with staged(random) as (frame, size):
        folder = frame.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert size > 0 and rows(frame) == rows(frame) and os.path.isdir(folder)
        assert frame.dtypes == random.dtypes
    assert not os.path.exists(folder)


def test_a_staged_frame_goes_even_after_a_failure(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with staged(spark.range(1)):
        before = len(os.listdir(shared))
    with pytest.raises(ZeroDivisionError), staged(spark.range(1)):
        1 / 0
    assert len(os.listdir(shared)) == before - 1


def test_rows_are_measured_before_they_are_broadcast(spark, conf):
    def measured(df):
        return df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0

    long = spark.range(400_000).selectExpr("id", "repeat('x', 5000) t")  # 2 GB, of which a parquet file has 2 MB
    assert measured(long) > 2_000_000_000 and not fits_broadcast(spark, measured(long))
    assert fits_broadcast(spark, measured(long.limit(1000)))
    nested = spark.range(1000).selectExpr("array_repeat('abc', 20000) a", "named_struct('b', id) s", "map('k', id) m", "CAST(NULL AS BINARY) n")
    assert not fits_broadcast(spark, measured(nested)) and fits_broadcast(spark, measured(nested.drop("a")))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert not fits_broadcast(spark, 0)


def test_only_finished_folders_count(spark, tmp_path):
    assert committed_folders(spark, str(tmp_path)) == []
    spark.range(1).write.parquet(f"{tmp_path}/v2")
    spark.range(1).write.parquet(f"{tmp_path}/v1")
    (tmp_path / "v3").mkdir()
    assert [f.rsplit("/", 1)[1] for f in committed_folders(spark, str(tmp_path))] == ["v1", "v2"]
    assert sorted(folder_names(spark, str(tmp_path))) == ["v1", "v2", "v3"]


def test_a_name_sorts_behind_one_from_a_clock_that_is_ahead():
    ahead = "v99990101T000000000000_0a1b2c3d"
    assert unique_name("v", ahead) > ahead and name_time(ahead, "v").year == 9999
    assert unique_name("v", "elsewhere") > unique_name("v")[:5]
    assert name_time("elsewhere", "v") is None and name_time(ahead + "x", "v") is None
