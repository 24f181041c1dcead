"""Every query with SQL against that SQL on the whole sample tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from oracles import oracle_statements
from tallyloom.plans.catalog import BUILDERS, MODEL_QUERIES, all_queries

ORACLES = oracle_statements()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sample_folder):
    connection = duckdb.connect()
    for file in Path(sample_folder).glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')"
        )
    return connection


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (datetime.date, pd.Timestamp)):
        return str(pd.Timestamp(value))
    return value


def rows_of(rows, columns, names):
    places = [names.index(c) for c in columns]
    return sorted((tuple(plain(row[i]) for i in places) for row in rows), key=str)


def test_every_query_has_sql_or_is_a_model_query():
    checks = {name for name in MODEL_QUERIES if name.endswith("_check")}
    assert set(ORACLES) == (set(BUILDERS) - MODEL_QUERIES) | checks


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, duck, sample_folder):
    df = all_queries()[name](spark, sample_folder)
    relation = duck.sql(ORACLES[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(
        zip(relation.columns, map(str, relation.types))
    )
    columns = sorted(df.columns)
    ours = rows_of(df.collect(), columns, df.columns)
    theirs = rows_of(relation.fetchall(), columns, relation.columns)
    assert ours
    assert ours == theirs
