"""List entries deeper than sixteen path segments."""

import pytest

pytest.importorskip("duckdb")

from tallymark.llm import url_lists  # noqa: E402


def test_deep_entries_are_met(spark):
    path = "/".join(f"s{i}" for i in range(30))
    deep = "a.org/" + "/".join(f"s{i}" for i in range(20))
    pages = spark.createDataFrame([(1, f"http://a.org/{path}", "2024-01-02"), (2, "http://a.org/s0", "2024-01-02")], "page_id long, url string, day string")
    entries = spark.createDataFrame([(deep, "2024-01-01", "block")], "pattern string, day string, action string")
    got = {r["page_id"]: (r["pattern"], r["kept"]) for r in url_lists.judged(pages, entries).collect()}
    assert got == {1: (deep, False), 2: (None, True)}
