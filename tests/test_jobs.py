"""The jobs on the seed rows, run and run again."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierlake import (
    Connection,
    DocumentJob,
    GoldJob,
    MappingJob,
    Output,
    RelationalJob,
    ingest_documents,
    ingest_relational,
    map_sources,
    publish_gold,
    read_view,
)
from tierlake.functions.storage import unique_name

PEOPLE = [(1, "Alice", 10.5), (2, "Bob", 20.0)]


class Seeds:
    def __init__(self, spark, root, buckets):
        self.spark = spark
        self.connection = Connection(
            f"jdbc:derby:memory:{unique_name('s')};create=true",
            driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
        )
        self.export = f"{root}/export.jsonl"
        a, b, m = (unique_name(p) for p in ("a_", "b_", "m_"))
        self.relational = RelationalJob(
            self.connection, "people", self.output(a, root, "id", buckets), discover=("id", 2)
        )
        self.documents = DocumentJob(self.output(b, root, "_id", buckets), export_path=self.export)
        self.mapping = MappingJob(self.output(m, root, "sqlserver_id", buckets), left=a, right=b)
        self.direct = GoldJob(unique_name("g_"), left=a, right=b)
        self.bridged = GoldJob(unique_name("g_"), left=a, right=b, mapping=m)

    @staticmethod
    def output(name, root, key, buckets):
        return Output(name, f"{root}/{name}", (key,), buckets=buckets, table_format="parquet")

    def fill(self, people, documents=None, schema="id INT, name STRING, value DOUBLE"):
        self.spark.createDataFrame(people, schema).write.format("jdbc").options(
            **self.connection.reader_options()
        ).option("dbtable", "people").mode("overwrite").save()
        with open(self.export, "w", encoding="utf-8") as out:
            for row in documents or people:
                out.write(json.dumps({"_id": str(row[0]), "name": row[1], "value": row[2]}) + "\n")

    def run(self):
        ingest_relational(self.spark, self.relational)
        ingest_documents(self.spark, self.documents)
        return map_sources(self.spark, self.mapping)


@pytest.fixture(params=[None, 4])
def seeds(spark, tmp_path, request):
    made = Seeds(spark, tmp_path, request.param)
    made.fill(PEOPLE)
    return made


def test_every_stage_and_a_rerun(spark, seeds):
    for _ in range(2):
        assert rows(ingest_relational(spark, seeds.relational)) == PEOPLE
        assert rows(ingest_documents(spark, seeds.documents)) == [("1", "Alice", 10.5), ("2", "Bob", 20.0)]
        assert rows(map_sources(spark, seeds.mapping)) == [(1, "1"), (2, "2")]
        direct = publish_gold(spark, seeds.direct)
        assert rows(direct) == [(1, "Alice", 10.5, "1", "Alice", 10.5), (2, "Bob", 20.0, "2", "Bob", 20.0)]
        bridged = publish_gold(spark, seeds.bridged)
        assert rows(bridged.drop("sqlserver_id", "mongodb_id")) == rows(direct)
    assert rows(read_view(spark.newSession(), seeds.direct.view)) == rows(direct)


def test_later_rows_flow_through(spark, seeds):
    seeds.run()
    seeds.fill([(2, "Bobby", 21.0), (3, "Eve", 3.0)], [("3", "Eve", 33.0), ("x", "X", 0.0)])
    assert rows(seeds.run()) == [(1, "1"), (2, "2"), (3, "3")]
    gold = publish_gold(spark, seeds.bridged)
    assert rows(gold.select("a_id", "a_name", "b_value")) == [(1, "Alice", 10.5), (2, "Bobby", 20.0), (3, "Eve", 33.0)]


def test_other_names_and_keys(spark, seeds):
    a, b, m = seeds.relational.output.table, seeds.documents.output.table, seeds.mapping.output
    seeds.run()
    by_name = MappingJob(
        Output(m.table + "n", m.path + "n", ("left_id",), buckets=m.buckets, table_format="parquet"),
        left=a,
        right=b,
        on=("name", "name"),
        ids=("id", "_id"),
        names=("left_id", "right_id"),
    )
    assert rows(map_sources(spark, by_name)) == [(1, "1"), (2, "2")]
    gold = GoldJob(
        unique_name("g_"),
        left=a,
        right=b,
        mapping=m.table + "n",
        mapping_columns=("left_id", "right_id"),
        prefixes=("crm_", "app_"),
    )
    assert publish_gold(spark, gold).columns == [
        "left_id", "right_id", "crm_id", "crm_name", "crm_value", "app__id", "app_name", "app_value"
    ]


def test_transform_hook(spark, seeds):
    out = ingest_relational(spark, seeds.relational, lambda df: df.select("id", F.upper("name").alias("name")))
    assert rows(out) == [(1, "ALICE"), (2, "BOB")]


def test_asserted_source_schema(spark, seeds):
    seeds.fill([(1, "Alice", 10.5, 1)], schema="id INT, name STRING, value DOUBLE, more INT")
    with pytest.raises(Exception, match="schema"):
        ingest_relational(spark, seeds.relational)


def test_command_line_in_separate_processes(tmp_path):
    """Jobs share nothing but the catalog and the lake, and the reader sees the durable view."""
    export = tmp_path / "export.jsonl"
    export.write_text("".join(json.dumps({"_id": str(i), "name": n, "value": v}) + "\n" for i, n, v in PEOPLE))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    submit = (
        "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 "
        f"--conf spark.checkpoint.dir={tmp_path}/shared --conf spark.sql.warehouse.dir={tmp_path}/warehouse "
        f"--conf spark.driver.extraJavaOptions=-Dderby.system.home={tmp_path} pyspark-shell"
    )

    def run(job, *arguments, **settings):
        done = subprocess.run(
            [sys.executable, "-m", "tierlake", job, *arguments],
            env=os.environ | {"PYTHONPATH": repo, "PYSPARK_SUBMIT_ARGS": submit} | settings,
            cwd=tmp_path,
            capture_output=True,
            text=True,
            timeout=300,
        )
        assert done.returncode == 0, done.stderr[-3000:]
        return done.stdout

    for table in ("left_docs", "right_docs"):
        run(
            "ingest-documents",
            DOCUMENT_EXPORT_PATH=str(export),
            DELTA_PATH=f"{tmp_path}/{table}",
            DELTA_TABLE=table,
            TABLE_FORMAT="parquet",
        )
    sources = {"SQLSERVER_BRONZE_TABLE": "left_docs", "MONGODB_BRONZE_TABLE": "right_docs", "JOIN_KEYS": "_id,_id"}
    run("map-sources", MAPPING_PATH=f"{tmp_path}/mapping", TABLE_FORMAT="parquet", **sources)
    run("publish-bridged-gold", GOLD_VIEW="people_gold", **sources)
    for shown in (run("show-gold", "--view", "people_gold"), run("show-gold", GOLD_VIEW="people_gold")):
        assert "Alice" in shown and "Bob" in shown and "a_name" in shown
