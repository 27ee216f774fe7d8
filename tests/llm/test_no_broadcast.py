"""Tables that grow with the corpus are not broadcast, however small Spark takes them to be."""

import re

import pytest
from pyspark.sql import DataFrame

from tallymark.llm import common, components, mixing, near_texts, repeated_bytes, simhash


@pytest.fixture
def plans(monkeypatch):
    """The plans of all frames that are stored, as they are before anything has been measured."""
    seen = []
    write = common.stored

    def noted(frame: DataFrame, name: str) -> DataFrame:
        seen.append(planned(frame))
        return write(frame, name)

    for module in (components, near_texts, repeated_bytes, simhash):
        monkeypatch.setattr(module, "stored", noted)
    monkeypatch.setattr(components, "FEW", 0, raising=False)
    return seen


def planned(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().sparkPlan().toString()


def joins(plans: list[str]) -> set[str]:
    return {kind for plan in plans for kind in re.findall(r"\w*(?:Join|CartesianProduct)\b", re.sub(r"\[.*", "", plan))}


TEXTS = ["one two three four five six seven"] * 3 + [f"word{i} other{i} third{i} fourth{i}" for i in range(20)] + ["", None]


def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_fingerprints_and_links_are_not_broadcast(spark, plans):
    found = simhash.near_duplicates(documents(spark), threshold=1)
    assert joins([*plans, planned(found)]) == {"SortMergeJoin"}
    assert found.count() == len(TEXTS)


def test_many_links_are_not_broadcast(spark, plans):
    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "a long, b long")
    found = components.components(links)
    assert joins(plans) == {"SortMergeJoin"}
    assert {tuple(r) for r in found.collect()} == {*((i, 0) for i in range(10)), (20, 20), (21, 20)}


def test_near_texts_are_not_broadcast(spark, plans):
    found = simhash.one_of_each(documents(spark))
    assert joins([*plans, planned(found)]) == {"SortMergeJoin"}
    assert found.count() == 22


def test_the_mix_is_not_broadcast(spark):
    docs = documents(spark).selectExpr("*", "'s' as source")
    [kind] = joins([planned(mixing.taken_copies(docs))])
    assert kind == "SortMergeJoin"


def test_repeated_windows_are_not_broadcast(spark, plans):
    texts = [" ".join(f"{i}word{j}" for j in range(60)) + " common" * 60 for i in range(5)]
    found = repeated_bytes.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert joins([*plans, planned(found)]) == {"SortMergeJoin"}
    assert all(r["n_removed"] > 0 for r in found.collect())
