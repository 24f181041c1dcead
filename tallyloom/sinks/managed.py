"""Keyed tables whose upserts rewrite only the files they touch.

Rows are dealt to a fixed number of buckets by a hash of their key, one folder
each.  A manifest names the folder of every bucket; a new version of the
table is a new manifest.  It is written last, as one file, so a run that dies
before leaves the old version, and readers of the old version keep theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.merge import nan_to_null, upsert

BUCKET = "__bucket"
MANIFEST = "version long, buckets int, keys array<string>, bucket int, folder string, rows long"


@dataclass(frozen=True)
class UpsertReport:
    version: int
    buckets_read: int
    buckets_written: int
    buckets_kept: int


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of one version, by default the newest."""
    rows = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(f"{root}/manifest")
    wanted = version if version is not None else rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == F.lit(wanted))


def _write_buckets(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write rows below a folder of their own; (bucket, folder, rows) of the buckets that have some."""
    folder = f"{root}/data/{uuid.uuid4().hex}"
    dealt = df.withColumn(BUCKET, _bucket_of(keys, buckets))
    dealt.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
    written = df.sparkSession.read.schema(dealt.schema).parquet(folder)
    path = F.concat(F.lit(f"{folder}/{BUCKET}="), BUCKET)
    return written.groupBy(BUCKET).agg(F.count("*").alias("rows")).select(
        F.col(BUCKET).alias("bucket"), path.alias("folder"), "rows"
    )


def _publish(folders: DataFrame, root: str, keys: Sequence[str], buckets: int, version: int) -> None:
    rows = folders.select(
        F.lit(version).cast("long").alias("version"),
        F.lit(buckets).alias("buckets"),
        F.array(*map(F.lit, keys)).alias("keys"),
        "bucket",
        "folder",
        "rows",
    )
    # One file with a row for each bucket: it is there or it is not.
    rows.coalesce(1).write.parquet(f"{root}/manifest/{version}-{uuid.uuid4().hex}")


def _scan(spark: SparkSession, folders: DataFrame, like: DataFrame) -> DataFrame:
    paths = [row["folder"] for row in folders.select("folder").collect()]  # one for each bucket
    if not paths:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(*paths)


def create_table(df: DataFrame, root: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Version 1 of a table at a root that has none; keys are unique in ``df``."""
    _publish(_write_buckets(df, root, keys, buckets), root, keys, buckets, 1)


def read_table(spark: SparkSession, root: str, like: DataFrame, version: int | None = None) -> DataFrame:
    """The newest or a given version, with the schema of ``like``."""
    return _scan(spark, _manifest(spark, root, version), like)


def upsert_table(
    updates: DataFrame, root: str, update_columns: Sequence[str] | None = None
) -> UpsertReport:
    """Merge ``updates``, which have the table's columns, by key as ``upsert`` does.

    Only the buckets of keys that occur in the updates are read and written.
    """
    spark = updates.sparkSession
    current = _manifest(spark, root).cache()
    try:
        head = current.select("version", "buckets", "keys").first()
        keys, buckets = head["keys"], head["buckets"]
        fresh = nan_to_null(updates)
        touched = fresh.select(_bucket_of(keys, buckets).alias("bucket")).distinct()
        hit = current.join(touched, "bucket", "left_semi")
        kept = current.join(touched, "bucket", "left_anti").select("bucket", "folder", "rows")
        old = _scan(spark, hit, fresh)
        written = _write_buckets(upsert(old, fresh, keys, update_columns), root, keys, buckets).cache()
        report = UpsertReport(head["version"] + 1, hit.count(), written.count(), kept.count())
        _publish(kept.unionByName(written), root, keys, buckets, report.version)
        written.unpersist()
        return report
    finally:
        current.unpersist()
