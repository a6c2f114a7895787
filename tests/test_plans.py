"""Plan-shape checks: what the optimizer must (and must not) produce."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from podium.operators import ranking as rk
from podium.operators import streaks as st
from podium.plans import reports as rp
from podium.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - {"stream_ingest"}))
def test_no_cartesian_or_single_partition(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    # all work stays in the JVM: no Python UDF / pandas evaluation anywhere
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan


def test_top_ranks_limit_before_shuffle(spark):
    # winners: no window sees a day; medals: one over a day's distinct times, counted before
    plan = st.streaks(fx.league_results(spark, SF), ["league"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and "rank(secs" not in plan
    lines = rk.medal_table(fx.league_results(spark, SF), ["league"])._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "Window [rank(secs" in line)
    assert "Aggregate [" in " ".join(lines[at + 1 : at + 3])
    plan = _plan(rk.top_ranks(fx.league_results(spark, SF), ["league"], 3))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    plan = _plan(rk.fastest(fx.results(spark, SF), None, "month", 3))
    assert "WindowGroupLimit" in plan


def test_day_rank_is_not_a_whole_day_window(spark):
    plan = _plan(rk.day_rank(fx.results(spark, SF)))
    # the per-row rank comes from the aggregated histogram, not a window over all rows of a day
    assert "partial_count" in plan
    assert "rank(" not in plan


def test_filters_and_pruning_reach_scan(spark, tmp_path):
    path = str(tmp_path / "res")
    fx.results(spark, SF).write.partitionBy("date").parquet(path)
    r = spark.read.parquet(path)
    plan = _plan(rp.lookback(r, dt.date(2001, 8, 1), 90))
    assert "PartitionFilters: [isnotnull(date" in plan and "2001-05-03" in plan
    plan = _plan(rp.period_report_for(r, dt.date(2001, 8, 1), None, "month"))
    assert "2001-07-01" in plan and "2001-08-01" in plan
    plan = _plan(rk.day_rank(r).select("name", "rnk"))
    assert "ReadSchema: struct<name:string,secs:int>" in plan or "ReadSchema: struct<secs:int>" in plan


def test_checked_broadcast_both_ways(spark):
    from podium.util import checked_broadcast

    r = fx.results(spark, SF)
    want = sorted(tuple(x) for x in rk.day_rank(r).collect())
    checked = rk.day_rank(r, checked=True)
    assert sorted(tuple(x) for x in checked.collect()) == want
    assert "BroadcastHashJoin" in _plan(checked)
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(big.join(checked_broadcast(small, max_bytes=10_000), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(checked_broadcast(small, max_bytes=8), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tie_window_reuses_rank_join_shuffle(spark):
    """With no broadcasts (as at scale) the line-position window runs on the rank join's partitioning."""
    lg = fx.league_results(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = _plan(rp.daily_message(lg, ["league"])).split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    i = next(i for i, l in enumerate(lines) if "Window [row_number()" in l)
    below = " ".join(lines[i + 1 : i + 4])
    assert "SortMergeJoin" in below and "Exchange" not in below


def test_checked_daily_same_rows_and_broadcast(spark):
    r = fx.league_results(spark, SF)
    want = sorted((tuple(x) for x in rp.daily_standings(r, ["league"]).collect()), key=str)
    checked = rp.daily_standings(r, ["league"], checked=True)
    assert sorted((tuple(x) for x in checked.collect()), key=str) == want
    assert _plan(checked).count("BroadcastHashJoin") >= 2


def test_no_window_over_a_whole_period(spark):
    """Period-wide orders come from histograms of few distinct values, never from a window over all rows of a period."""
    import re

    from podium.operators import ranking as rk
    from podium.operators import streaks as st

    r = fx.league_results(spark, SF)
    for df in (rk.period_wins(r, ["league"], "month"), rk.medal_table(r, ["league"], "week"), st.longest_streak(r, ["league"], "year")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for window in re.findall(r"Window \[(.*?)\], \[(.*?)\], \[(.*?)\]", plan):
            assert "row_number" not in window[0] or window[1].count("#") > 2, window
