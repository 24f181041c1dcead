"""A log of finished stages, so that a run that failed goes on where it stopped.

Every stage has a print of what its result depends on: its settings and the
prints of its inputs, down to the names, sizes and times of the source files.
It is logged, with the number of rows written, once the stage's table is there.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.sinks.tables import write_parquet

ROWS = "stage string, print string, rows long, finished_at timestamp"


def source_print(df: DataFrame) -> str:
    """A number for the files that a frame reads: their paths, sizes and times, not their contents."""
    files = sorted(df.inputFiles())
    if not files:
        return "no files"
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    seen = listed.agg(F.count("*"), F.sum(F.pmod(F.xxhash64(*listed.columns), F.lit(1 << 40)))).first()
    return f"{seen[0]} files {seen[1]}"


class StageLog:
    """Writes tables below a root and remembers from what."""

    def __init__(self, spark: SparkSession, root: str, resume: bool):
        self.spark, self.root, self.resume = spark, root.rstrip("/"), resume
        self.prints = self._finished()

    def _finished(self) -> dict[str, str]:
        try:
            rows = self.spark.read.schema(ROWS).parquet(f"{self.root}/_stages")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        # A row for each stage that ever finished.
        newest = rows.groupBy("stage").agg(F.max_by("print", "finished_at").alias("print"))
        return {row["stage"]: row["print"] for row in newest.collect()}

    def source(self, name: str, df: DataFrame) -> None:
        self.prints[name] = source_print(df) if self.resume else "not looked at"

    def write(
        self,
        name: str,
        inputs: Sequence[str],
        build: Callable[[], DataFrame],
        settings: object = None,
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """The written table of a stage; ``build`` only runs if it has to."""
        # An input that no log knows is never the same twice.
        known = [self.prints.get(i, uuid.uuid4().hex) for i in inputs]
        digest = json.dumps([name, known, settings], sort_keys=True, default=str)
        print_ = hashlib.sha256(digest.encode()).hexdigest()
        path = f"{self.root}/{name}"
        if self.resume and self.prints.get(name) == print_:
            return self.spark.read.parquet(path)
        counted = Observation()
        built = build().observe(counted, F.count("*").alias("rows"))
        written = write_parquet(built, path, partition_by=partition_by)
        # Without resume nothing is looked at, so nothing can be left out later.
        kept = print_ if self.resume else uuid.uuid4().hex
        row = self.spark.createDataFrame([(name, kept, counted.get["rows"])], "stage string, print string, rows long")
        row.withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
            f"{self.root}/_stages"
        )
        self.prints[name] = kept
        return written
