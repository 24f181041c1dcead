from __future__ import annotations

import pytest

from llm.helpers import DDL, ROWS
from tallyloom.llm.shared import bounded_batches


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    bounded_batches(spark)
    df = spark.createDataFrame(ROWS, DDL).repartition(3)
    for name in ("node", "n", "score", "part", "length", "kept", "key", "segment"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def sample_docs(spark, sample_folder):
    return bounded_batches(spark).read.parquet(f"{sample_folder}/documents.parquet")


@pytest.fixture(scope="session")
def some_docs(sample_docs):
    return sample_docs.where("doc_id < 200").cache()
