"""Physical plan checks: one series exchange, no single-partition window."""

import re

import pytest
from pyspark.sql import functions as F

from barloom.functions import windows as W
from barloom.plans import layers, long_layers
from barloom.sources import bars
from conftest import SF001, SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_gold_single_series_exchange(spark):
    b = bars.lineitem_bars(spark, SF0001)
    plan = _plan(layers.gold(layers.silver(b)))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    keyed = [e for e in exchanges if "series_key" in e[1] and "_groupingexpression" not in e[1]]
    assert len(keyed) == 1, exchanges
    assert "SinglePartition" not in plan


def test_no_unpartitioned_window(spark):
    b = bars.lineitem_bars(spark, SF0001)
    plan = _plan(layers.gold(layers.silver(b)))
    for line in plan.splitlines():
        if "Window [" in line:
            assert re.search(r"\], \[[^\]]*series_key", line), line


def test_many_series_single_exchange(spark):
    b = bars.supplier_bars(spark, SF0001)
    plan = _plan(layers.gold(layers.silver(b)))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    keyed = [e for e in exchanges if "series_key" in e[1] and "_groupingexpression" not in e[1]]
    assert len(keyed) == 1, exchanges


def test_bars_are_a_hash_aggregate(spark):
    for source in (bars.lineitem_bars, bars.supplier_bars, bars.event_bars):
        plan = source(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def _largest_part(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("layer", [layers.silver, lambda b: layers.gold(layers.silver(b))], ids=["silver", "gold"])
def test_more_series_more_tasks(spark, monkeypatch, layer):
    def rows():
        return layer(bars.text_bars(spark, SF001, bars.supplier_bars))

    plain = rows()
    monkeypatch.setattr(W, "TASK_ROWS", 2000, raising=False)
    many = rows()
    assert _largest_part(many) <= 3 * 2000 < _largest_part(plain)
    assert many.exceptAll(plain).isEmpty() and many.count() == plain.count()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\), (\w+)", _plan(many))
    assert len(exchanges) == 2 and all(kind == "REPARTITION_BY_NUM" for _, kind in exchanges), exchanges


def test_stored_layers_are_dealt(spark, monkeypatch):
    b = bars.supplier_bars(spark, SF001)
    monkeypatch.setattr(W, "TASK_ROWS", 2000, raising=False)
    assert _largest_part(long_layers.build_silver(b)) <= 3 * 2000
