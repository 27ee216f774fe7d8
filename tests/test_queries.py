"""Every registered query against its SQL twin at the smallest scale."""

import math
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry_module

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLES = {k: v for k, v in entry_module.oracle_sql().items() if k.startswith("q_")}
QUERIES = {k: v for k, v in entry_module.queries().items() if k.startswith("q_")}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    assert got == want


def test_import_needs_no_session():
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    code = "import __spark_entry__ as e; q = {k for k in e.queries() if k[:2] == 'q_'}; assert len(q) > 100 and q == {k for k in e.oracle_sql() if k[:2] == 'q_'}"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark):
    assert sorted(entry_module.entry(spark).columns) == ["id", "n", "n_subjects", "severity"]


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heads_are_limited_before_the_shuffle(spark):
    assert final_plan(QUERIES["q_topn_per_key"](spark, SF)).count("WindowGroupLimit") == 2
    assert final_plan(QUERIES["q_describe_five"](spark, SF)).count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["q_asymmetric_containment"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,1.0)" in plan
    plan = QUERIES["q_zero_size"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_discount,0.0)" in plan and "l_extendedprice" not in plan
