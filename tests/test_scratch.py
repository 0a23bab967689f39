"""Where scratch tables go, and that a scope leaves none behind."""

from __future__ import annotations

from pathlib import Path

import pytest

from martloom.operators import scratch


class Session:
    def __init__(self, **conf):
        self.conf = {k.replace("__", "."): v for k, v in conf.items()}


def test_the_named_folder_is_used():
    assert scratch.scratch_root(Session(spark__checkpoint__dir="s3a://b/c/")) == "s3a://b/c"


def test_without_a_named_folder_the_shared_warehouse_is_used():
    session = Session(spark__sql__warehouse__dir="hdfs://nn/warehouse")
    assert scratch.scratch_root(session) == "hdfs://nn/warehouse/scratch"


def test_a_table_is_written_below_the_root(spark):
    table = scratch.materialize(spark.range(10), "numbers")
    root = scratch.scratch_root(spark).removeprefix("file:")
    assert table.count() == 10 and root in table.inputFiles()[0]


def test_a_scope_empties_its_tables_only(spark):
    kept = scratch.materialize(spark.range(5))
    with scratch.scope():
        inside = scratch.materialize(spark.range(100_000))
        with scratch.scope():
            nested = scratch.materialize(spark.range(100_000))
            nested_path = Path(nested.inputFiles()[0].removeprefix("file://")).parent
        assert inside.count() == 100_000
        inside_path = Path(inside.inputFiles()[0].removeprefix("file://")).parent
        assert sum(p.stat().st_size for p in nested_path.glob("*.parquet")) < 1000
    assert sum(p.stat().st_size for p in inside_path.glob("*.parquet")) < 1000
    assert kept.count() == 5


def test_a_scope_cleans_up_after_an_error(spark):
    with pytest.raises(ValueError), scratch.scope():
        inside = scratch.materialize(spark.range(100_000))
        path = Path(inside.inputFiles()[0].removeprefix("file://")).parent
        raise ValueError
    assert sum(p.stat().st_size for p in path.glob("*.parquet")) < 1000


def test_distilled_keeps_the_result_alone(spark):
    made = []

    def build():
        made.append(scratch.materialize(spark.range(50), "step"))
        return made[0].where("id < 5")

    found = scratch.distilled(build, "result")
    assert found.count() == 5
    path = made[0].inputFiles()[0].rsplit("/", 1)[0] if made[0].inputFiles() else None
    assert path is None or spark.read.parquet(path).isEmpty()
    with scratch.scope():
        inner = scratch.distilled(lambda: spark.range(7), "inner")
        assert inner.count() == 7
