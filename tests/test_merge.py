from __future__ import annotations

import random

import pytest

from conftest import as_dicts, by_key
from tallyloom.operators import merge

SCHEMA = "k1 int, k2 string, a int, b double"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_table(pick):
    keys = {(pick.randrange(8), pick.choice("xy")) for _ in range(10)}
    return [(*k, pick.choice([None, 1, 2]), pick.choice([None, 0.5])) for k in sorted(keys)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("columns", [None, ["a"], []])
def test_upsert_twice_is_upsert_once(spark, seed, columns):
    pick = random.Random(seed)
    target, updates = random_table(pick), random_table(pick)
    names = ["a", "b"] if columns is None else columns
    expected = {row[:2]: dict(zip(("a", "b"), row[2:])) for row in target}
    for row in updates:
        new = dict(zip(("a", "b"), row[2:]))
        old = expected.get(row[:2])
        expected[row[:2]] = new if old is None else {**old, **{c: new[c] for c in names}}
    keys = ["k1", "k2"]
    once = merge.upsert(table(spark, target), table(spark, updates), keys, columns)
    assert sorted_rows(once) == sorted(
        ((*k, v["a"], v["b"]) for k, v in expected.items()), key=str
    )
    twice = merge.upsert(once, table(spark, updates), keys, columns)
    assert sorted_rows(twice) == sorted_rows(once)


def test_updates_may_set_null(spark):
    merged = merge.upsert(
        table(spark, [(1, "x", 5, 1.0)]), table(spark, [(1, "x", None, None)]), ["k1", "k2"]
    )
    assert as_dicts(merged) == [{"k1": 1, "k2": "x", "a": None, "b": None}]


def test_nan_becomes_null_and_the_rest_stays(spark):
    rows = sorted_rows(
        merge.nan_to_null(table(spark, [(1, "x", 5, float("nan")), (2, None, None, 2.0)]))
    )
    assert rows == [(1, "x", 5, None), (2, None, None, 2.0)]


def test_profile(spark):
    profile = by_key(
        merge.table_profile(table(spark, [(1, None, None, 1.0), (2, "x", None, None)])),
        "column_name",
    )
    assert {c: r["null_count"] for c, r in profile.items()} == {"k1": 0, "k2": 1, "a": 2, "b": 1}
    assert profile["a"]["row_count"] == 2 and profile["a"]["column_count"] == 4
