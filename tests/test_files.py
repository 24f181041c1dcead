from __future__ import annotations

import csv
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import RAW_ROWS, as_dicts
from tallyloom.operators.tables import RetailTables
from tallyloom.sinks import exports, runlog, tables as sink
from tallyloom.sources import files
from tallyloom.sources.schemas import raw_schema


def part_lines(folder, suffix):
    rows = []
    for part in sorted(Path(folder).glob(f"part-*{suffix}")):
        rows += part.read_text().splitlines()
    return rows


def write_raw_csv(folder, table):
    """Raw file as an export tool writes it: header, quotes doubled, line breaks kept."""
    path = folder / f"{table}.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(raw_schema(table).names)
        writer.writerows(["" if v is None else v for v in row] for row in RAW_ROWS[table])
    return str(path)


def test_csv_scan_cleans_like_the_frames(spark, tmp_path, tables):
    paths = {table: write_raw_csv(tmp_path, table) for table in RAW_ROWS}
    scanned = files.scan_raw_tables(spark, paths)
    message = [r.review_comment_message for r in scanned["order_reviews"].collect()][0]
    assert message == 'line one\nline "two"'
    cleaned = RetailTables.from_raw(scanned)
    for table in ("orders", "order_items", "order_payments", "order_reviews", "products"):
        ours = sorted(map(str, as_dicts(getattr(cleaned, table))))
        assert ours == sorted(map(str, as_dicts(getattr(tables, table))))


def test_csv_keeps_leading_zeros_and_nulls_malformed_cells(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("zip,n\n00123,5\n00456,five\n")
    rows = as_dicts(files.scan_csv(spark, str(path), "zip string, n int"))
    assert rows == [{"zip": "00123", "n": 5}, {"zip": "00456", "n": None}]
    inferred = files.scan_csv(spark, str(path))
    assert dict(inferred.dtypes) == {"zip": "int", "n": "string"}


def test_partitioned_parquet_round_trip(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, id % 5) as month")
    written = sink.write_parquet(df, str(tmp_path / "t"), partition_by=["month"])
    assert written.count() == 1000
    assert sorted(written.columns) == ["id", "month"]
    folders = list((tmp_path / "t").glob("month=*"))
    assert len(folders) == 6
    pruned = written.filter("month = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in pruned
    assert files.scan_parquet(spark, str(tmp_path / "t")).count() == 1000


def test_upsert_to_a_new_path(spark, tmp_path):
    now, later = str(tmp_path / "v1"), str(tmp_path / "v2")
    sink.write_parquet(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), now)
    updates = spark.createDataFrame([(2, float("nan")), (3, 3.0)], "k int, v double")
    merged = sink.write_upsert(spark, now, updates, ["k"], later)
    assert sorted(map(tuple, merged.collect())) == [(1, 1.0), (2, None), (3, 3.0)]
    assert spark.read.parquet(now).count() == 2
    with pytest.raises(ValueError):
        sink.write_upsert(spark, now, updates, ["k"], now + "/")


def test_jdbc_options():
    options = sink.jdbc_options("postgresql://h/db", "t", 100, "d")
    assert options["url"] == "jdbc:postgresql://h/db" and options["batchsize"] == "100"
    assert sink.jdbc_options("jdbc:x", "t", 1, "d")["url"] == "jdbc:x"


def test_run_log_appends_and_survives_failure(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = runlog.run_rows(spark, "als", {"rmse": 1.5, "precision_at_k": 0.1}, {"rank": 16})
    assert runlog.log_runs([rows, rows], path) == 2
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert json.loads(log.first()["params"]) == {"rank": "16"}
    blocked = tmp_path / "file"
    blocked.write_text("")
    assert runlog.log_run(rows, str(blocked / "below")) is False


def test_customer_csv(spark, tmp_path):
    rows = spark.createDataFrame(
        [("ID1", "raw", 'Customer "A"', "VIP", 12, "High", 95)],
        "id string, raw_id string, name string, segment string, ltv int, engagement string, churn_proxy int",
    )
    exports.export_customers(rows.coalesce(1), str(tmp_path / "c"))
    header, line = part_lines(tmp_path / "c", ".csv")
    assert header == '"Customer ID","Name","Segment","Lifetime Value","Engagement","Churn Probability"'
    assert line == '"ID1","Customer ""A""","VIP","12","High","95%"'


def test_trend_csv(spark, tmp_path):
    trend = spark.createDataFrame(
        [("2018-02-01", "Feb", 2.5, 0.0), ("2018-01-01", "Jan", 1.4, 3.5)],
        "month string, month_label string, actual double, predicted double",
    )
    exports.export_trend(trend.coalesce(1), str(tmp_path / "t"))
    lines = part_lines(tmp_path / "t", ".csv")
    assert [x for x in lines if not x.startswith('"Month')] == ['"Jan","1","4"', '"Feb","3",""']


def test_json_exports(spark, tmp_path):
    one = spark.range(1).select(F.lit("x").alias("name"))
    exports.export_workbench(spark, str(tmp_path / "w"), one, one, one, {"region": "All Regions"})
    (about,) = part_lines(tmp_path / "w" / "about", ".json")
    assert json.loads(about)["region"] == "All Regions" and "generated_at" in json.loads(about)
    assert part_lines(tmp_path / "w" / "kpi_summary", ".json") == ['{"name":"x"}']
    cards = spark.createDataFrame([("m", "k", "n", 0.5, "2018")], "model string, metric string, name string, raw double, trained_at string")
    shares = spark.createDataFrame([("VIP", 10, 5)], "name string, value int, customers int")
    total = spark.createDataFrame([("m", 30, 1.0, 0.5, 2.0)], "model string, n int, predicted_total double, lower double, upper double")
    exports.export_insights(spark, str(tmp_path / "i"), cards, shares, total)
    (line,) = part_lines(tmp_path / "i" / "forecast_summary", ".json")
    assert json.loads(line)["horizon_days"] == 30
