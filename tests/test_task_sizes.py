"""Groupings of narrow rows are dealt out by their number, joins do not sort the large side."""

import os

import pytest

import __spark_entry__ as entry_module
from tallymark.operators import ranking

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plan(spark, name):
    return entry_module.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def dealt_exchanges(text):
    return [line for line in text.splitlines() if "REPARTITION_BY_NUM" in line]


@pytest.mark.parametrize("name", ["q_map_diff", "q_project_weights", "q_all_equal_first"])
def test_rows_are_dealt_by_their_number(spark, monkeypatch, name):
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    monkeypatch.setattr(ranking, "ROWS_A_TASK", n // 40)
    exchanges = dealt_exchanges(plan(spark, name))
    assert exchanges and all(f", {-(-n // (n // 40))})" in line for line in exchanges)


def test_lines_are_not_sorted_to_meet_their_orders(spark):
    assert "ShuffledHashJoin" in plan(spark, "q_findings_all")
