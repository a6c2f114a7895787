"""Skew probe: one league-day holding a third of all rows.

Full day rank two ways (window vs histogram join), and top-3 per day with and
without the partial ``WindowGroupLimit`` before the shuffle.

Builds results from the driver's ``orders`` + ``customer`` (every order a player;
every third order moved onto one hot day), then runs the full day rank as a
``rank()`` window and as the histogram join of :func:`podium.operators.ranking.day_rank`,
with broadcasting off so the join back is a shuffle join as it would be at
scale.  Per-task shuffle records come from Spark's event log, written to a
scratch folder.  Prints one JSON line per method: rows, and the largest /
median task input (records read from shuffle) of the heaviest stage.

``tied`` lets all rows of the hot day win it; ``positions`` numbers a million
players of one win in one league-month.

Usage: python tools/skew_probe.py [sf_dir [kind ...]]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _task_reads(log_dir: str, group: str) -> dict[int, list[int]]:
    """Shuffle records read per task, per stage, for the jobs of one job group."""
    events = []
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isdir(f):
            with open(f) as fh:
                events += [json.loads(line) for line in fh]
    stages = set()
    for ev in events:
        if ev.get("Event") == "SparkListenerJobStart" and (ev.get("Properties") or {}).get("spark.jobGroup.id") == group:
            stages |= set(ev.get("Stage IDs", []))
    per_stage: dict[int, list[int]] = {}
    for ev in events:
        if ev.get("Event") == "SparkListenerTaskEnd" and ev["Stage ID"] in stages:
            m = ev.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            per_stage.setdefault(ev["Stage ID"], []).append(recs)
    return per_stage


def main(argv):
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from podium.functions.timefmt import format_secs
    from pyspark.sql import Window

    from podium.operators import medians as med
    from podium.operators import ranking as rk

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="podium-skew-")
    out = {}
    runs = [("rank:window", {}), ("rank:histogram", {}),
            ("top3:limit-before-shuffle", {}), ("top3:no-limit", {"spark.sql.optimizer.windowGroupLimitThreshold": "-1"}),
            ("median:aggregate", {}), ("median:window", {}),
            ("tied:window", {}), ("tied:values", {}), ("positions:window", {}), ("positions:range", {})]
    if len(argv) > 2:
        runs = [r for r in runs if r[0].split(":")[0] in argv[2:]]
    for method, extra in runs:
        log_dir = os.path.join(scratch, f"events-{method.replace(':', '-')}")
        os.makedirs(log_dir)
        spark = (
            SparkSession.builder.master("local[8]")
            .appName(f"skew-{method}")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
            .config("spark.sql.shuffle.partitions", "16")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
            .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
            .config("spark.sql.autoBroadcastJoinThreshold", "-1")
            .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        )
        for k, v in extra.items():
            spark = spark.config(k, v)
        spark = spark.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        o = spark.read.parquet(f"{sf_dir}/orders.parquet")
        c = spark.read.parquet(f"{sf_dir}/customer.parquet")
        hot = F.pmod(F.col("o_orderkey"), F.lit(3)) == 0
        if method.startswith("median:"):
            # one player with a third of all rows, all in one month (a single hot median group)
            hot_day = F.make_date(F.lit(1998), F.lit(1), (F.pmod(F.col("o_orderkey"), F.lit(28)) + 1).cast("int"))
            name = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")))
            date = F.when(hot, hot_day).otherwise(F.col("o_orderdate").cast("date"))
        else:
            name = F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))
            date = F.when(hot, F.lit("1998-01-01").cast("date")).otherwise(F.col("o_orderdate").cast("date"))
        res = (
            o.join(c, o.o_custkey == c.c_custkey)
            .select(
                F.when(hot, F.lit("HOT")).otherwise(F.col("c_mktsegment")).alias("league"),
                name.alias("name"),
                date.alias("date"),
                (F.lit(20) + F.floor(F.col("o_totalprice") / F.lit(1000))).cast("int").alias("secs"),
            )
            .withColumn("time", format_secs("secs"))
        )
        path = os.path.join(scratch, f"results-{method.replace(':', '-')}")
        res.write.parquet(path)
        r = spark.read.parquet(path)
        if method.startswith("rank:"):
            out_df = rk.day_rank(r, ["league"], method=method.split(":")[1])
        elif method == "median:aggregate":
            out_df = med.median_times(r, ["league"], "month")
        elif method == "median:window":
            # the exact median by sorting each player's rows (what a window-based median does)
            g = ["league", "m", "name"]
            x = r.withColumn("m", F.trunc("date", "month"))
            w = Window.partitionBy(*g).orderBy("secs")
            x = x.withColumn("i", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*g)))
            mid = (F.col("i") == F.floor((F.col("n") + 1) / 2)) | (F.col("i") == F.floor(F.col("n") / 2) + 1)
            out_df = x.where(mid).groupBy(*g).agg(F.avg("secs").alias("median"))
        else:
            out_df = rk.top_ranks(r, ["league"], 3, method="window")
        if method.startswith("tied:"):
            # the hot day's rows all have one time, that of the day's winners
            tied = r.withColumn("secs", F.when(F.col("league") == "HOT", F.lit(20)).otherwise(F.col("secs")))
            tied.write.parquet(path + "-tied")
            out_df = rk.top_ranks(spark.read.parquet(path + "-tied"), ["league"], 3, method=method.split(":")[1])
        elif method.startswith("positions:"):
            # a million players of one win in one league-month, half as many others
            ids = spark.range(1_500_000).withColumn("hot", F.pmod("id", F.lit(3)) < 2)
            won = ids.select(
                F.when(F.col("hot"), "HOT").otherwise(F.concat(F.lit("l"), F.pmod("id", F.lit(50)))).alias("league"),
                F.lit("1998-01-01").cast("date").alias("period_start"),
                F.sha1(F.col("id").cast("string")).alias("name"),
                F.when(F.col("hot"), F.lit(1)).otherwise(F.pmod("id", F.lit(7))).cast("bigint").alias("n"),
            )
            won.write.parquet(path + "-won")
            r = spark.read.parquet(path + "-won")
            spark.sparkContext.setJobGroup("measured", method)
            spark.sparkContext.setCheckpointDir(scratch)
            out_df = rk.ranked_position(r, ["league", "period_start"], "n", "name", True, "pos", False, "rnk", checked=method.endswith("range"))
        spark.sparkContext.setJobGroup("measured", method)
        out_df.write.format("noop").mode("overwrite").save()
        n = r.count()
        spark.stop()
        stages = _task_reads(log_dir, "measured")
        heavy = max(stages.values(), key=lambda v: max(v) if v else 0)
        out[method] = {
            "rows": n,
            "hot_day_rows": 2 * n // 3 if method.startswith("positions:") else n // 3,
            "heaviest_stage_max_task_records": max(heavy),
            "heaviest_stage_median_task_records": int(statistics.median(heavy)),
            "heaviest_stage_tasks": len(heavy),
            "total_shuffle_records": sum(sum(v) for v in stages.values()),
        }
        print(json.dumps({"method": method, **out[method]}))


if __name__ == "__main__":
    main(sys.argv)
