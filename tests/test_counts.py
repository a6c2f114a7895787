import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import results_df
from podium import versions
from podium.operators import counts as ct
from podium.operators import medians as med
from podium.operators import ranking as rk
from podium.plans import count_table, jobs

BY = ["league"]


def _rows(df):
    return sorted((tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in df.collect()), key=repr)


def _poll(rng, days, players=6):
    return [
        (rng.choice(["x", "y", None]), f"p{rng.randrange(players)}", (dt.date(2024, 1, 25) + dt.timedelta(days=d)).isoformat(), rng.randrange(20, 40))
        for d in days
        for _ in range(rng.randrange(1, 9))
    ]


def _same(spark, table, path, by, period, as_of):
    canon = jobs.read_canonical(spark, table, by)
    start, end = jobs.period_range(as_of, period)
    local = canon.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end)))
    counts = count_table.read_counts(spark, path, as_of, period, 0, by)
    pairs = [
        (ct.median_times(counts, by), med.median_times(local, by, period)),
        (ct.weekday_medians(counts, by), med.weekday_medians(local, by, period)),
        (ct.period_wins(counts, by), rk.period_wins(local, by, period)),
        (ct.medal_table(counts, by), rk.medal_table(local, by, period)),
        (ct.rank_distribution(counts, by), rk.rank_distribution(local, by, period)),
    ]
    for ours, plain in pairs:
        assert ours.columns == plain.columns and [f.dataType for f in ours.schema] == [f.dataType for f in plain.schema]
        assert _rows(ours) == _rows(plain)


def test_random_polls_keep_the_counts_of_the_rows(spark, tmp_path):
    rng, table, path = random.Random(1), str(tmp_path / "table"), str(tmp_path / "counts")
    for days in (range(0, 14), [3], [2, 9], [13, 14]):
        polled = results_df(spark, _poll(rng, days), league=True)
        jobs.append_new_rows(polled.drop("time"), table, BY)
        jobs.update_counts(spark, table, path, BY)
    for period, as_of in (("month", dt.date(2024, 1, 31)), ("year", dt.date(2024, 6, 1)), ("week", dt.date(2024, 1, 30))):
        _same(spark, table, path, BY, period, as_of)


def test_a_months_counts_are_dealt_to_several_writers(spark, tmp_path, monkeypatch):
    """No task sorts a whole month: with many counts its players lie in several files, one after the other."""
    monkeypatch.setattr(count_table, "FILE_ROWS", 100)
    table, path = str(tmp_path / "table"), str(tmp_path / "counts")
    rows = [(f"p{i:03d}", f"2024-01-{d:02d}", 30 + (i * d) % 50) for d in (3, 4) for i in range(200)]
    for part in (rows[:300], rows[300:]):
        jobs.append_new_rows(results_df(spark, part).drop("time"), table)
        jobs.update_counts(spark, table, path)
    files = count_table.read_counts(spark, path, dt.date(2024, 1, 31)).groupBy(F.input_file_name()).agg(F.min("name"), F.max("name"), F.count("*")).collect()
    assert len(files) > 1 and max(r[3] for r in files) < 400
    ends = sorted((r[1], r[2]) for r in files)
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    _same(spark, table, path, None, "month", dt.date(2024, 1, 31))


def _stored(spark, tmp_path, days=3):
    table, path = str(tmp_path / "table"), str(tmp_path / "counts")
    rows = [(n, f"2024-01-{d:02d}", 30 + i) for d in range(1, days + 1) for i, n in enumerate("abc")]
    jobs.append_new_rows(results_df(spark, rows).drop("time"), table)
    return table, path


def test_a_poll_rewrites_its_day_and_month_only(spark, tmp_path):
    table, path = _stored(spark, tmp_path)
    jobs.append_new_rows(results_df(spark, [("a", "2024-02-01", 30)]).drop("time"), table)
    first = jobs.update_counts(spark, table, path).state
    assert jobs.update_counts(spark, table, path).state == first  # nothing polled
    jobs.append_new_rows(results_df(spark, [("c", "2024-01-02", 20)]).drop("time"), table)
    second = jobs.update_counts(spark, table, path).state
    assert [d for d in second["days"] if second["days"][d] != first["days"][d]] == ["2024-01-02"]
    assert [m for m in second["months"] if second["months"][m] != first["months"][m]] == ["2024-01-01"]
    counts = count_table.read_counts(spark, path, dt.date(2024, 1, 5))
    assert {(r.name, r.n) for r in ct.period_wins(counts).collect()} == {("a", 2), ("c", 1)}
    # a value that nobody has any more leaves no row
    assert counts.where("kind = 'time' AND name = 'c' AND dow = 3").select("value", "n").collect() == [(20, 1)]


def test_an_update_reads_the_touched_partitions_of_the_table_only(spark, tmp_path):
    table, path = _stored(spark, tmp_path)
    jobs.update_counts(spark, table, path)
    # a day the update has no need of is unreadable
    for f in (tmp_path / "table" / "date=2024-01-01").glob("*.parquet"):
        f.write_bytes(b"no parquet file at all")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    jobs.append_new_rows(results_df(spark, [("c", "2024-01-02", 20)]).drop("time"), table)
    out = str(tmp_path / "messages")
    jobs.run_period(spark, table, out, "month", dt.date(2024, 2, 3), counts_path=path)
    text = "".join(r.text for r in spark.read.json(out).orderBy("seq", "page").collect())
    assert text.startswith("*January results*\n\n*Wins*\na: 2 :crown:\nc: 1 \n")


@pytest.mark.parametrize("period", ["week", "month", "year"])
def test_reports_from_counts_equal_those_from_rows(spark, tmp_path, period):
    table, path = _stored(spark, tmp_path, 12)
    jobs.append_new_rows(results_df(spark, [("d", "2024-01-09", 30), ("b", "2024-01-10", 29)]).drop("time"), table)
    as_of = {"week": dt.date(2024, 1, 9), "month": dt.date(2024, 2, 9), "year": dt.date(2025, 1, 9)}[period]
    texts = []
    for n, counts in enumerate([None, path]):
        out = str(tmp_path / f"messages{n}")
        jobs.run_period(spark, table, out, period, as_of, counts_path=counts)
        texts.append(sorted((r.message, r.seq, r.page, r.text) for r in spark.read.json(out).collect()))
    assert texts[0] == texts[1] and texts[0]


def test_an_update_that_dies_leaves_the_state_before(spark, tmp_path, monkeypatch):
    table, path = _stored(spark, tmp_path)
    jobs.update_counts(spark, table, path)
    before = _rows(count_table.read_counts(spark, path, dt.date(2024, 1, 5)))
    jobs.append_new_rows(results_df(spark, [("c", "2024-01-02", 20)]).drop("time"), table)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)
        with pytest.raises(RuntimeError):
            jobs.update_counts(spark, table, path)
    assert _rows(count_table.read_counts(spark, path, dt.date(2024, 1, 5))) == before
    jobs.update_counts(spark, table, path)
    _same(spark, table, path, None, "month", dt.date(2024, 1, 5))


def test_a_batch_counted_before_it_was_marked_is_counted_once(spark, tmp_path, monkeypatch):
    table, path = _stored(spark, tmp_path)
    jobs.update_counts(spark, table, path)
    jobs.append_new_rows(results_df(spark, [("c", "2024-01-02", 20)]).drop("time"), table)
    with monkeypatch.context() as m:
        m.setattr(count_table, "_seen_path", lambda p: "/proc/nowhere")
        with pytest.raises(Exception):
            jobs.update_counts(spark, table, path)
    jobs.update_counts(spark, table, path)
    jobs.update_counts(spark, table, path)
    _same(spark, table, path, None, "month", dt.date(2024, 1, 5))


def test_no_state_is_an_error_and_an_empty_period_is_empty(spark, tmp_path):
    table, path = _stored(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        count_table.read_counts(spark, path, dt.date(2024, 1, 5))
    jobs.update_counts(spark, table, path)
    assert count_table.read_counts(spark, path, dt.date(2023, 1, 5)).isEmpty()
    assert count_table.read_days(spark, path, dt.date(2023, 1, 1), dt.date(2023, 2, 1)).isEmpty()
    with pytest.raises(ValueError):
        ct.rolled_up(count_table.read_counts(spark, path, dt.date(2024, 1, 5)), "week")
