"""The Delta format. Its library is not installed here, so only the calls made to it are checked."""

from __future__ import annotations

import sys
import types

import pytest

from tierlake.operators import delta, publish
from tierlake.operators.tables import Layout


class Recorder:
    def __init__(self, calls):
        self.calls = calls

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, args))
            return self

        return call


@pytest.fixture
def calls(monkeypatch):
    made = []
    module = types.ModuleType("delta")
    module.tables = types.ModuleType("delta.tables")
    module.tables.DeltaTable = Recorder(made)
    monkeypatch.setitem(sys.modules, "delta", module)
    monkeypatch.setitem(sys.modules, "delta.tables", module.tables)
    return made


@pytest.mark.parametrize("evolve", [True, False])
def test_merge(spark, calls, evolve):
    delta.upsert(spark, "t", spark.range(1).selectExpr("id AS a", "id AS `b.c`"), ["a", "b.c"], evolve=evolve)
    names = [name for name, _ in calls]
    expected = ["forName", "alias", "merge"] + ["withSchemaEvolution"] * evolve
    assert names == expected + ["whenMatchedUpdateAll", "whenNotMatchedInsertAll", "execute"]
    assert calls[2][1][1] == "target.`a` = source.`a` AND target.`b.c` = source.`b.c`"


@pytest.mark.parametrize("there", [False, True])
def test_a_table_at_the_path_is_merged_into_and_never_loaded_over(spark, monkeypatch, there):
    """The catalog may have lost the name; the path decides."""
    done, names = [], set()
    monkeypatch.setattr(publish, "table_exists", lambda _, name: name in names)
    monkeypatch.setattr(publish, "read_table", lambda *_: spark.range(1))
    monkeypatch.setattr(publish, "table_layout", lambda *_: Layout("delta", "/p", "/p"))
    monkeypatch.setattr(delta, "is_table", lambda *_: there)
    monkeypatch.setattr(delta, "register", lambda _, name, path: (names.add(name), done.append("register")))
    monkeypatch.setattr(delta, "overwrite", lambda *_, **__: done.append("overwrite"))
    monkeypatch.setattr(delta, "upsert", lambda *_, **__: done.append("merge"))
    publish.upsert(spark, "t", "/p", spark.range(1), "id", table_format="delta")
    assert done == (["register", "merge"] if there else ["overwrite", "register"])


def test_the_format_is_a_setting_whatever_is_installed(spark, monkeypatch, calls, name, path):
    publish.upsert(spark, name, path, spark.range(3), "id")  # the library seems to be there
    assert publish.table_layout(spark, name).provider == "parquet" and calls == []
    with pytest.raises(ValueError, match="no buckets"):
        publish.upsert(spark, f"{name}x", path, spark.range(1), "id", table_format="delta", buckets=4)
    with pytest.raises(ValueError, match="'parquet' or 'delta'"):
        publish.overwrite(spark, f"{name}x", path, spark.range(1), table_format="orc")
    done = []
    monkeypatch.setattr(delta, "overwrite", lambda *_, **__: done.append("overwrite"))
    monkeypatch.setattr(delta, "register", lambda *_: done.append("register"))
    publish.overwrite(spark, f"{name}y", path, spark.range(1), table_format="delta")
    assert done == ["overwrite", "register"]
