"""The queries' star: order lines joined once, stored anew by each query."""

from __future__ import annotations

import shutil

import __spark_entry__ as entry_module


def test_a_build_joins_the_order_lines_once(spark, sf_dir):
    built = entry_module._built(spark, sf_dir)
    for name in ("fact_sales", "dim_customer", "budget"):
        assert "o_orderkey" not in built.tables()[name]._jdf.queryExecution().toString()


def test_a_stored_star_follows_its_tables(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "tables")
    shutil.copytree(sf_dir, folder, ignore=shutil.ignore_patterns("lineitem*"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = []
    for kept in (lines, lines.where("l_orderkey % 2 = 0")):
        kept.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
        rows.append((kept.count(), entry_module._stored(spark, folder).fact_sales.count()))
    assert rows[0][0] == rows[0][1] > rows[1][0] == rows[1][1]
