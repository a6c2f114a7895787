import datetime as dt

from podium.sources import sinks

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "name string, time string, secs int, date date")


def test_overwrite_replaces_only_days_present(spark, tmp_path):
    path = str(tmp_path / "canon")
    sinks.overwrite_partitions(_rows(spark, [("a", "0:10", 10, D1), ("b", "0:20", 20, D2)]), path)
    sinks.overwrite_partitions(_rows(spark, [("a", "0:09", 9, D1)]), path)  # compact day 1 only
    got = sorted((r.name, r.secs, r.date) for r in spark.read.parquet(path).collect())
    assert got == [("a", 9, D1), ("b", 20, D2)]


def test_append_spreads_a_day_over_writers(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = _rows(spark, [(f"p{i}", "0:10", 10, D1) for i in range(200)])
    # AQE merges small buckets (here all of them); switched off to see the spread a large day gets
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.append_results(rows, path, files_per_day=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "results" / "date=2024-01-01").glob("*.parquet"))
    assert 1 < len(files) <= 4
    assert spark.read.parquet(path).count() == 200


def test_writers_rebalance_by_day(spark, tmp_path):
    rows = _rows(spark, [(f"p{i}", "0:10", 10, D1 if i % 2 else D2) for i in range(200)])
    plan = sinks.cluster_by_day(rows, ["date"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    path = str(tmp_path / "results")
    sinks.append_results(rows, path)
    assert len(list((tmp_path / "results").glob("date=*/*.parquet"))) == 2  # small days, one file each
