import datetime as dt
import json

from pyspark.sql import functions as F

from podium.plans import jobs
from podium.streaming.board_stream import start_board_stream


def _land(folder, day, entries):
    folder.mkdir(parents=True, exist_ok=True)
    doc = {"data": [{"userID": i, "name": n, "rank": str(i), "me": False, "score": ({"secondsSpentSolving": s} if s is not None else {})}
                    for i, (n, s) in enumerate(entries)]}
    (folder / f"{day}.json").write_text(json.dumps(doc))


def _boards(tmp_path):
    boards = tmp_path / "boards"
    _land(boards, "2024-01-01", [("a", 30), ("b", 45), ("c", None)])
    _land(boards, "2024-01-02", [("a", 31), ("b", 40)])
    _land(boards, "2024-01-03", [("a", 20), ("b", 50), ("c", 65)])
    return boards


def test_ingest_files_twice_equals_once(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    first = sorted(tuple(r) for r in jobs.read_stored(spark, table).collect())
    jobs.run_ingest(spark, str(boards), table)
    assert sorted(tuple(r) for r in jobs.read_stored(spark, table).collect()) == first
    assert len(first) == 7  # c's unsolved entry on day 1 is not a result
    assert ("a", "0:20", 20, dt.date(2024, 1, 3)) in first
    # a corrected time is appended; the canonical view keeps the fastest
    _land(boards, "2024-01-03", [("a", 19)])
    jobs.run_ingest(spark, str(boards), table)
    canon = {(r.name, r.date.day): r.secs for r in jobs.read_canonical(spark, table).collect()}
    assert canon[("a", 3)] == 19 and len(canon) == 7


def test_daily_and_month_jobs(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    out, marker = str(tmp_path / "messages"), str(tmp_path / "marker")
    jobs.run_daily(spark, table, out, marker, dt.date(2024, 1, 3))
    jobs.run_daily(spark, table, out, marker, dt.date(2024, 1, 3))  # rerun: replaced, not duplicated
    msg = spark.read.json(out)
    assert {r.kind for r in msg.collect()} == {"daily"} and msg.count() == 1
    text = "".join(r.text for r in msg.orderBy("seq", "page").collect())
    assert text == "*Wednesday, January 03*\na: 0:20 :first_place_medal: (3-day streak)\nb: 0:50 :second_place_medal: \nc: 1:05 :third_place_medal: \n"
    assert jobs.read_marker(spark, marker).collect()[0].latest_date == dt.date(2024, 1, 3)
    month = str(tmp_path / "month")
    jobs.run_period(spark, table, month, "month", dt.date(2024, 2, 10))
    parts = spark.read.json(month).orderBy("message", "seq", "page").collect()
    whole = "".join(p.text for p in parts)
    assert whole.startswith("*January results*\n\n*Wins*\na: 3 :crown:\n")
    assert whole.endswith("*Longest streak*\na: 3, ending on Wed, Jan 03\n")


def test_stream_ingest_replay_safe(spark, tmp_path):
    boards, table, ckpt = _boards(tmp_path), str(tmp_path / "table"), str(tmp_path / "ckpt")
    start_board_stream(spark, str(boards), table, ckpt).awaitTermination()
    n = jobs.read_stored(spark, table).count()
    # a second stream with a fresh checkpoint replays every file: nothing is added twice
    start_board_stream(spark, str(boards), table, str(tmp_path / "ckpt2")).awaitTermination()
    assert jobs.read_stored(spark, table).count() == n == 7


def test_week_report_for_as_of(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    parts = jobs.period_report_for(jobs.read_canonical(spark, table), dt.date(2024, 1, 3), None, "week").collect()
    assert parts[0].text.startswith("*Week 1 wins*\na: :first_place_medal::first_place_medal::first_place_medal:\n")


def test_incremental_streaks_equal_full(spark, tmp_path):
    from podium.operators import streaks as st
    from tests.conftest import results_df

    rows = []
    for day in range(1, 11):
        winner = "a" if day not in (4, 8) else "b"
        rows += [(winner, f"2024-01-{day:02d}", 10), ("c", f"2024-01-{day:02d}", 90)]
    r = results_df(spark, rows)
    path = str(tmp_path / "streaks")
    seen = {}
    for day in range(1, 11):
        got = jobs.update_streaks(spark, r, path, dt.date(2024, 1, day))
        for x in got.collect():
            seen[(x.name, x.date)] = x.streak
    jobs.update_streaks(spark, r, path, dt.date(2024, 1, 10))  # rerun: nothing added
    full = {(x.name, x.date): x.streak for x in st.streaks(r).collect()}
    assert seen == full
    gen = jobs.streak_state(spark, path).generation
    assert spark.read.parquet(f"{path}/{gen}").count() == len(full)


def test_daily_with_streak_table(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    for day in (1, 2, 3):
        out = str(tmp_path / f"m{day}")
        jobs.run_daily(spark, table, out, None, dt.date(2024, 1, day), None, str(tmp_path / "streaks"))
    text = "".join(r.text for r in spark.read.json(str(tmp_path / "m3")).orderBy("seq", "page").collect())
    assert "a: 0:20 :first_place_medal: (3-day streak)\n" in text


def test_stream_small_batches_and_repeats(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    # the same day's board landed twice (two polls)
    _land(tmp_path / "boards", "2024-01-03b", [("a", 20), ("b", 50), ("c", 65)])
    (tmp_path / "boards" / "2024-01-03b.json").rename(tmp_path / "boards" / "2024-01-03.json.1")
    start_board_stream(spark, str(boards), table, str(tmp_path / "ckpt"), max_files_per_trigger=1).awaitTermination()
    assert jobs.read_stored(spark, table).count() == 7


def test_late_results_recompute_only_later_days(spark, tmp_path):
    from podium.operators import streaks as st
    from tests.conftest import results_df

    def rows(day5_winner):
        out = []
        for day in range(1, 11):
            w = day5_winner if day == 5 else ("a" if day not in (8,) else "b")
            out += [(w, f"2024-01-{day:02d}", 10), ("c", f"2024-01-{day:02d}", 90)]
        return out

    path = str(tmp_path / "streaks")
    before = results_df(spark, rows("a"))
    for day in range(1, 11):
        jobs.update_streaks(spark, before, path, dt.date(2024, 1, day))
    after = results_df(spark, rows("c"))  # a late, faster result changes day 5's winner
    jobs.update_streaks(spark, after, path, dt.date(2024, 1, 10), late_from=dt.date(2024, 1, 5))
    gen = jobs.streak_state(spark, path).generation
    got = {(x.name, x.date): x.streak for x in spark.read.parquet(f"{path}/{gen}").collect()}
    want = {(x.name, x.date): x.streak for x in st.streaks(after).collect()}
    assert got == want


def test_cli_and_month_from_streak_table(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    streaks, daily, month = str(tmp_path / "streaks"), str(tmp_path / "daily"), str(tmp_path / "month")
    jobs.main(["ingest", "--table", table, "--boards", str(boards)])
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        jobs.main(["daily", "--table", table, "--messages", daily, "--as-of", day, "--streaks", streaks])
    assert {r.period_start.day for r in spark.read.json(daily).select(F.to_date("period_start").alias("period_start")).collect()} == {1, 2, 3}
    jobs.main(["month", "--table", table, "--messages", month, "--as-of", "2024-02-10", "--streaks", streaks])
    whole = "".join(p.text for p in spark.read.json(month).orderBy("message", "seq", "page").collect())
    assert whole.endswith("*Longest streak*\na: 3, ending on Wed, Jan 03\n")
    assert spark.read.json(month).select("title").distinct().collect()[0].title == "January"


def test_compacted_canonical_table(spark, tmp_path):
    boards, table, canon = _boards(tmp_path), str(tmp_path / "table"), str(tmp_path / "canonical")
    jobs.run_ingest(spark, str(boards), table, canonical_path=canon)
    _land(boards, "2024-01-03", [("a", 19)])  # a correction for one day
    jobs.run_ingest(spark, str(boards), table, canonical_path=canon)
    want = sorted((r.name, r.date, r.secs, r.time) for r in jobs.read_canonical(spark, table).collect())
    got = sorted((r.name, r.date, r.secs, r.time) for r in jobs.read_canonical(spark, table, canonical_path=canon).collect())
    assert got == want and ("a", dt.date(2024, 1, 3), 19, "0:19") in got
    out = str(tmp_path / "daily")
    jobs.run_daily(spark, table, out, None, dt.date(2024, 1, 3), canonical_path=canon)
    assert "a: 0:19 :first_place_medal: (3-day streak)\n" in "".join(r.text for r in spark.read.json(out).collect())


def test_leagues_from_folders_batch_and_stream(spark, tmp_path):
    boards = tmp_path / "boards"
    _land(boards / "league=east", "2024-01-01", [("a", 30), ("b", 40)])
    _land(boards / "league=east", "2024-01-02", [("a", 31), ("b", 20)])
    _land(boards / "league=west", "2024-01-01", [("a", 50), ("z", 10)])
    table = str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table, ["league"])
    got = sorted((r.league, r.name, r.date.day, r.secs) for r in jobs.read_stored(spark, table, ["league"]).collect())
    assert got == [("east", "a", 1, 30), ("east", "a", 2, 31), ("east", "b", 1, 40), ("east", "b", 2, 20),
                   ("west", "a", 1, 50), ("west", "z", 1, 10)]
    stream_table = str(tmp_path / "stream_table")
    start_board_stream(spark, str(boards), stream_table, str(tmp_path / "ckpt"), ["league"]).awaitTermination()
    assert sorted(tuple(r) for r in jobs.read_stored(spark, stream_table, ["league"]).collect()) == sorted(
        tuple(r) for r in jobs.read_stored(spark, table, ["league"]).collect()
    )
    out = str(tmp_path / "daily")
    jobs.run_daily(spark, table, out, None, dt.date(2024, 1, 1), ["league"])
    texts = {r.league: r.text for r in spark.read.json(out).collect()}
    assert texts["west"] == "*Monday, January 01*\nz: 0:10 :first_place_medal: \na: 0:50 :second_place_medal: \n"


def test_stored_side_pruned_to_batch_days(spark, tmp_path):
    boards, table = _boards(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    batch = spark.createDataFrame([("a", 20, dt.date(2024, 1, 3))], "name string, secs int, date date")
    pruned = jobs._on_days(jobs.read_stored(spark, table), batch, None)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan and "Join" not in plan
    assert {r.date.day for r in pruned.collect()} == {3}


def test_marker_keeps_other_leagues(spark, tmp_path):
    boards = tmp_path / "boards"
    _land(boards / "league=east", "2024-01-01", [("a", 30)])
    _land(boards / "league=east", "2024-01-02", [("a", 31)])
    _land(boards / "league=west", "2024-01-01", [("z", 10)])
    table, marker = str(tmp_path / "table"), str(tmp_path / "marker")
    jobs.run_ingest(spark, str(boards), table, ["league"])
    jobs.run_daily(spark, table, str(tmp_path / "d1"), marker, dt.date(2024, 1, 1), ["league"])
    jobs.run_daily(spark, table, str(tmp_path / "d2"), marker, dt.date(2024, 1, 2), ["league"])
    got = {r.league: r.latest_date.day for r in jobs.read_marker(spark, marker, ["league"]).collect()}
    assert got == {"east": 2, "west": 1}


def _text(spark, path, day):
    rows = spark.read.json(path).where(F.to_date("period_start") == F.lit(day)).orderBy("seq", "page").collect()
    return "".join(r.text for r in rows)


def test_second_poll_corrects_streaks(spark, tmp_path):
    boards, table = tmp_path / "boards", str(tmp_path / "table")
    streaks, kept, full = str(tmp_path / "streaks"), str(tmp_path / "kept"), str(tmp_path / "full")
    for day in (1, 2, 3):
        _land(boards, f"2024-01-0{day}", [("a", 30), ("c", 90)])
        jobs.run_ingest(spark, str(boards), table)
        jobs.run_daily(spark, table, kept, None, dt.date(2024, 1, day), streak_path=streaks)
    _land(boards, "2024-01-03", [("a", 30), ("b", 20), ("c", 90)])  # a later poll makes b the winner of day 3
    jobs.run_ingest(spark, str(boards), table)
    _land(boards, "2024-01-04", [("a", 30), ("c", 90)])
    jobs.run_ingest(spark, str(boards), table)
    day = dt.date(2024, 1, 4)
    jobs.run_daily(spark, table, kept, None, day, streak_path=streaks)
    jobs.run_daily(spark, table, full, None, day)
    assert _text(spark, kept, day) == _text(spark, full, day)
    assert "(4-day streak)" not in _text(spark, kept, day)
    # at most the generation in use and the one before it are kept
    import os

    assert len([x for x in os.listdir(streaks) if x.startswith("gen-")]) <= 2


def test_a_missed_day_is_caught_up_without_a_rebuild(spark, tmp_path):
    from podium.operators import streaks as st
    from tests.conftest import results_df

    r = results_df(spark, [(w, f"2024-01-{d:02d}", 10) for d, w in enumerate("aaabbbaa", 1)])
    path = str(tmp_path / "streaks")
    jobs.update_streaks(spark, r, path, dt.date(2024, 1, 2))
    first = jobs.streak_state(spark, path).generation
    jobs.update_streaks(spark, r, path, dt.date(2024, 1, 8))
    assert jobs.streak_state(spark, path).generation == first
    key = lambda df: sorted((x.name, x.date, x.streak) for x in df.collect())
    assert key(jobs.read_streaks(spark, path)) == key(st.streaks(r))


def test_period_report_with_absent_stale_and_current_streak_tables(spark, tmp_path):
    import pytest

    boards, table = tmp_path / "boards", str(tmp_path / "table")
    for day in range(1, 7):
        _land(boards, f"2024-01-0{day}", [("a", 30), ("b", 45)])
    jobs.run_ingest(spark, str(boards), table)
    as_of, streaks = dt.date(2024, 2, 10), str(tmp_path / "streaks")
    with pytest.raises(FileNotFoundError):
        jobs.run_period(spark, table, str(tmp_path / "m0"), "month", as_of, streak_path=streaks)
    results = jobs.read_canonical(spark, table)
    for through in (3, 6):  # stale, current
        jobs.update_streaks(spark, results, streaks, dt.date(2024, 1, through), table_path=table)
        out = str(tmp_path / f"m{through}")
        jobs.run_period(spark, table, out, "month", as_of, streak_path=streaks)
        whole = "".join(p.text for p in spark.read.json(out).orderBy("message", "seq", "page").collect())
        assert whole.endswith("*Longest streak*\na: 6, ending on Sat, Jan 06\n")


def test_rows_without_a_date_are_kept_as_rejects_once(spark, tmp_path):
    boards, table = tmp_path / "boards", str(tmp_path / "table")
    _land(boards, "undated", [("a", 30), ("b", 45)])
    _land(boards, "2024-01-02", [("a", 31)])
    for _ in range(3):
        jobs.run_ingest(spark, str(boards), table)
    start_board_stream(spark, str(boards), table, str(tmp_path / "ckpt")).awaitTermination()
    assert [(r.name, r.secs) for r in jobs.read_stored(spark, table).collect()] == [("a", 31)]
    assert sorted((r.name, r.secs, r.date) for r in jobs.read_rejects(spark, table).collect()) == [("a", 30, None), ("b", 45, None)]


def test_reports_of_a_missing_table_fail(spark, tmp_path):
    import pytest

    missing = str(tmp_path / "nowhere")
    for run in (
        lambda: jobs.run_daily(spark, missing, str(tmp_path / "m"), None, dt.date(2024, 1, 1)),
        lambda: jobs.run_period(spark, missing, str(tmp_path / "m"), "month", dt.date(2024, 2, 1)),
        lambda: jobs.run_daily(spark, missing, str(tmp_path / "m"), None, dt.date(2024, 1, 1), canonical_path=missing),
    ):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            run()


def test_reconcile_lists_corrected_rows(spark, tmp_path):
    boards, table, out = tmp_path / "boards", str(tmp_path / "table"), str(tmp_path / "orphans")
    _land(boards, "2024-01-01", [("a", 30), ("b", 45)])
    jobs.run_ingest(spark, str(boards), table)
    _land(boards, "2024-01-01", [("a", 28), ("b", 45)])
    jobs.run_ingest(spark, str(boards), table)
    jobs.main(["reconcile", "--table", table, "--boards", str(boards), "--messages", out])
    assert [(r.name, r.secs) for r in spark.read.parquet(out).collect()] == [("a", 30)]


def test_lookback_cuts_streaks(spark):
    from tests.conftest import results_df

    r = results_df(spark, [("a", str(dt.date(2024, 1, 1) + dt.timedelta(days=i)), 10) for i in range(121)])
    as_of = dt.date(2024, 5, 1)
    last = lambda days: [p.text for p in jobs.period_report_for(r, as_of, None, "month", lookback_days=days).where("section = 'streak'").collect()][0]
    assert "a: 121, ending on Tue, Apr 30" in last(None) and "a: 89, ending on Tue, Apr 30" in last(90)
