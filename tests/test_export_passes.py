"""The extracts that count bills share one look for repeated ids."""

from __future__ import annotations

import __spark_entry__ as entry_module
from martloom.operators import bills
from martloom.plans import views
from martloom.sinks import exports


def test_exports_look_for_repeated_ids_once(spark, sf_dir, tmp_path, monkeypatch):
    detail = views.sales_detail(entry_module._built(spark, sf_dir))
    seen, write = [], bills.materialize
    monkeypatch.setattr(bills, "materialize", lambda df, label: (seen.append(label), write(df, label))[1])
    exports.export_extracts(detail, str(tmp_path / "out"), entry_module.ORDER_RULES)
    assert seen == ["repeats"]
