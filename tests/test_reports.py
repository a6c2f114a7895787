import datetime as dt

from pyspark.sql import functions as F

from podium.plans import reports as rp
from tests.conftest import message_text, results_df


def _day_rows():
    # a wins 3 days running, then b wins on the 4th while a plays
    rows = []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        rows += [("a", day, 30), ("b", day, 45), ("c", day, 70)]
    rows += [("b", "2024-01-04", 20), ("a", "2024-01-04", 20), ("c", "2024-01-04", 80), ("d", "2024-01-04", 90)]
    return rows


def test_daily_message_text(spark):
    r = results_df(spark, _day_rows())
    text = {x.date.day: x.text for x in message_text(rp.daily_message(r), period_key="date")}
    assert text[3] == (
        "*Wednesday, January 03*\n"
        "a: 0:30 :first_place_medal: (3-day streak)\n"
        "b: 0:45 :second_place_medal: \n"
        "c: 1:10 :third_place_medal: \n"
    )
    # day 4: a and b tie at rank 1; first by name is a (streak 4): nothing broken
    assert text[4] == (
        "*Thursday, January 04*\n"
        "a: 0:20 :first_place_medal: (4-day streak)\n"
        "b: 0:20 :first_place_medal: \n"
        "c: 1:20 :third_place_medal: \n"
        "d: 1:30  \n"
    )


def test_broken_streak_line(spark):
    rows = _day_rows()[:9] + [("b", "2024-01-04", 20), ("a", "2024-01-04", 25)]
    s = {x.name: x.line for x in rp.daily_standings(results_df(spark, rows)).where(F.col("date") == dt.date(2024, 1, 4)).collect()}
    assert s["a"] == "a: 0:25 :second_place_medal: (3-day streak broken)\n"
    assert s["b"] == "b: 0:20 :first_place_medal: \n"


def test_paging_keeps_all_lines(spark):
    rows = [(f"p{i:03d}", "2024-01-01", 100 + i) for i in range(23)]
    parts = rp.daily_message(results_df(spark, rows), page_size=5).collect()
    assert sorted(p.page for p in parts) == [0, 1, 2, 3, 4]
    whole = "".join(p.text for p in sorted(parts, key=lambda p: p.page))
    assert whole.startswith("*Monday, January 01*\np000: 1:40 :first_place_medal: \n")
    assert whole.count("\n") == 24


def test_month_report_layout(spark):
    rows = _day_rows()
    text = message_text(rp.period_message(results_df(spark, rows), None, "month"))[0].text
    assert text.startswith("*January results*\n\n*Wins*\na: 4 :crown:\nb: 1 \n\n*Fastest times*\n")
    assert "\n*Median times*\na: 0:30\nb: 0:45\nc: 1:10\nd: 1:30\n" in text
    assert text.endswith("\n*Longest streak*\na: 4, ending on Thu, Jan 04\n")


def test_month_without_long_streak_ends_blank(spark):
    rows = [("a", "2024-01-01", 10), ("b", "2024-01-02", 10)]
    text = message_text(rp.period_message(results_df(spark, rows), None, "month"))[0].text
    assert text.endswith("*Median times*\na: 0:10\nb: 0:10\n\n")


def test_year_report_three_messages(spark):
    msgs = {x.message: x.text for x in message_text(rp.period_message(results_df(spark, _day_rows()), None, "year"))}
    assert msgs[1].startswith("*2024 results*\n\n*Wins*\n")
    assert msgs[2].startswith("*Median times*\n")
    assert msgs[3].startswith("*Fastest times*\n") and "\n*Longest streak*\n" in msgs[3]


def test_week_report(spark):
    text = message_text(rp.weekly_message(results_df(spark, _day_rows())))[0].text
    assert text.startswith("*Week 1 wins*\na: :first_place_medal::first_place_medal::first_place_medal::first_place_medal:\n")


def test_text_bar(spark):
    rows = [("a", "2024-01-01", 35), ("b", "2024-01-01", 70)]
    got = {r.name: (r.relative, r.bar) for r in rp.text_bar(results_df(spark, rows)).collect()}
    assert got["b"] == (7, "━" * 7 + "　")
    assert got["a"] == (3, "━" * 3 + "　" * 5)


def test_lookback_strict_and_period_report(spark):
    rows = [("a", "2001-05-03", 10), ("a", "2001-05-04", 10), ("a", "2001-07-31", 10)]
    r = results_df(spark, rows)
    assert rp.lookback(r, dt.date(2001, 8, 1), 90).count() == 2  # 2001-05-03 is exactly 90 days before
    parts = rp.period_report_for(r, dt.date(2001, 8, 1), None, "month").collect()
    assert {p.period_start for p in parts} == {dt.date(2001, 7, 1)}


def test_plot_data_order(spark):
    rows = [("a", "2024-01-01", 10), ("b", "2024-01-01", 20), ("c", "2024-01-01", 20)]
    got = {r.name: (r.name_order, r.medal) for r in rp.daily_plot_data(results_df(spark, rows)).collect()}
    assert got == {"a": (3, "1"), "b": (2, "2"), "c": (1, "2")}
