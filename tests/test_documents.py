"""Document collections."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierlake import read_collection, read_export

SCHEMA = "_id STRING, name STRING, value DOUBLE"


@pytest.fixture
def export(tmp_path):
    def write(*lines):
        file = tmp_path / "export.jsonl"
        file.write_text("\n".join(lines), encoding="utf-8")
        return str(file)

    return write


def test_ids_of_both_kinds(spark, export):
    path = export('{"_id":{"$oid":"64f0"},"name":"B","value":2.0}', '{"_id":"1","name":"A","value":1}')
    assert rows(read_export(spark, path, SCHEMA)) == [("1", "A", 1.0), ("64f0", "B", 2.0)]


def test_filter_on_an_unwrapped_id(spark, export):
    path = export('{"_id":{"$oid":"64f0"},"name":"B","value":2.0}', '{"_id":"1","name":"A","value":1}')
    assert rows(read_export(spark, path, SCHEMA, where=F.col("_id") == "64f0", columns=["name"])) == [("B",)]


def test_fields_outside_the_schema_are_ignored_and_missing_ones_null(spark, export):
    assert rows(read_export(spark, export('{"_id":"1","other":[1,2]}'), SCHEMA)) == [("1", None, None)]


def test_wrong_type_and_malformed_documents(spark, export):
    path = export('{"_id":"3","name":"C","value":"x"}', "{bad", '{"_id":"4","name":"D","value":4}')
    out = read_export(spark, path, SCHEMA + ", _corrupt_record STRING")
    assert rows(out.cache()) == [
        (None, None, None, "{bad"),
        ("3", "C", None, '{"_id":"3","name":"C","value":"x"}'),
        ("4", "D", 4.0, None),
    ]
    assert rows(read_export(spark, path, SCHEMA, mode="DROPMALFORMED")) == [("4", "D", 4.0)]
    with pytest.raises(Exception):
        read_export(spark, path, SCHEMA, mode="FAILFAST").collect()


def test_filter_and_columns_reach_the_scan(spark, export):
    path = export('{"_id":"1","name":"A","value":1}')
    df = read_export(spark, path, SCHEMA, where="value > 0", columns=["_id", "value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,0.0)" in plan and "ReadSchema: struct<_id:string,value:double>" in plan


def test_whole_texts_survive(spark, export, tmp_path):
    text = "line\nnext   \U0001f600 \"q\" \\ \t" + "x" * 100_000
    spark.createDataFrame([("1", text)], "_id STRING, name STRING").write.json(str(tmp_path / "out"))
    assert rows(read_export(spark, str(tmp_path / "out"), SCHEMA)) == [("1", text, None)]


def test_collection_options(spark, monkeypatch):
    """Without the connector, only what it would be asked can be checked."""
    asked = {}

    class Reader:
        def format(self, name):
            asked["format"] = name
            return self

        def options(self, **options):
            asked.update(options)
            return self

        def schema(self, schema):
            asked["schema"] = schema.simpleString()
            return self

        def load(self):
            return "loaded"

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    pipeline = '[{"$match": {"value": {"$gt": 1}}}]'
    assert read_collection(spark, "mongodb://h", "d", "c", SCHEMA, pipeline=pipeline, options={"x": "y"}) == "loaded"
    assert asked == {
        "format": "mongodb",
        "connection.uri": "mongodb://h",
        "database": "d",
        "collection": "c",
        "pipeline": pipeline,
        "aggregation.pipeline": pipeline,
        "x": "y",
        "schema": "struct<_id:string,name:string,value:double>",
    }
    asked.clear()
    read_collection(spark, "mongodb://h", "d", "c", SCHEMA)
    assert "pipeline" not in asked
