"""Bench: headline reports over whole tables; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the median run is reported).

The fixture views are first written once as tables (as a stored results table
would be), then each query is executed in full with the ``noop`` sink, so
nothing is collected to the driver and every stage runs.
"""

from __future__ import annotations

import json
import os
import sys

# importable when loaded by file path from another working directory
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import os
import statistics
import sys
import time

from podium.operators import ingest as ing
from podium.operators import medians as med
from podium.operators import ranking as rk
from podium.operators import streaks as st
from podium.plans import reports as rp
from podium.session import get_session, scratch_path
from podium.sources import fixtures as fx

LEAGUE = ["league"]


def _sf(sf_dir: str):
    tag = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(tag)
    except ValueError:
        return tag


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)

    res_path = scratch_path(spark, "bench-results")
    lg_path = scratch_path(spark, "bench-league-results")
    t0 = time.time()
    fx.results(spark, sf_dir).write.parquet(res_path)
    fx.league_results(spark, sf_dir).write.parquet(lg_path)
    prep = time.time() - t0
    res = spark.read.parquet(res_path)
    lg = spark.read.parquet(lg_path)

    queries = {
        "ingest": lambda: ing.ingest(fx.sheet(spark, sf_dir), fx.incoming(spark, sf_dir)),
        "day_rank": lambda: rk.day_rank(lg, LEAGUE),
        "daily_standings": lambda: rp.daily_standings(res),
        "daily_message_league": lambda: rp.daily_message(lg, LEAGUE),
        "medal_table_league": lambda: rk.medal_table(lg, LEAGUE, "week"),
        "report_text_week": lambda: rp.weekly_message(res),
        "longest_streak_month": lambda: st.longest_streak(res, None, "month"),
        "broken_streaks_league": lambda: st.broken_streaks(lg, LEAGUE),
        "median_times_month_league": lambda: med.median_times(lg, LEAGUE, "month"),
        "weekday_medians": lambda: med.weekday_medians(res, None, "year"),
        "report_text_month": lambda: rp.period_message(res, None, "month"),
        "report_text_month_league": lambda: rp.period_message(lg, LEAGUE, "month"),
        "report_text_year": lambda: rp.period_message(res, None, "year"),
    }
    only = sys.argv[1:]
    timings = {}
    for name, build in queries.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeat):
            t = time.time()
            _run(build())
            runs.append(time.time() - t)
        timings[name] = round(statistics.median(runs), 3)
    out = {
        "metric": "total_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "repeat": repeat,
        "fixture_prep_sec": round(prep, 3),
        "rows": {"results": res.count(), "league_results": lg.count()},
    }
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
