import datetime as dt

from podium.operators import streaks as st
from tests.conftest import results_df


def _winner_rows(days_names):
    """days_names: list of (date, winner) -> results where winner is fastest and 'z' second."""
    rows = []
    for day, name in days_names:
        rows.append((name, day, 10))
        rows.append(("z", day, 99))
    return rows


def test_streak_crosses_month_end(spark):
    r = results_df(spark, _winner_rows([("2024-01-30", "a"), ("2024-01-31", "a"), ("2024-02-01", "a"), ("2024-02-03", "a")]))
    got = {r.date.isoformat(): r.streak for r in st.streaks(r).collect()}
    assert got == {"2024-01-30": 1, "2024-01-31": 2, "2024-02-01": 3, "2024-02-03": 1}
    best = st.longest_streak(r, None, "month").collect()
    assert [(x.period_start.month, x.name, x.streak) for x in best] == [(2, "a", 3)]
    assert best[0].line == "a: 3, ending on Thu, Feb 01\n"


def test_streak_property(spark):
    days = [("2024-01-%02d" % d, "ab"[d % 3 == 0]) for d in range(1, 29)]
    s = {(r.name, r.date): r.streak for r in st.streaks(results_df(spark, _winner_rows(days))).collect()}
    for (name, day), k in s.items():
        prev = s.get((name, day - dt.timedelta(days=1)))
        assert k == (1 if prev is None else prev + 1)


def test_tied_winners_both_streak(spark):
    rows = [("a", "2024-01-01", 5), ("b", "2024-01-01", 5), ("a", "2024-01-02", 5), ("b", "2024-01-02", 6)]
    got = {(r.name, r.date.day): r.streak for r in st.streaks(results_df(spark, rows)).collect()}
    assert got == {("a", 1): 1, ("b", 1): 1, ("a", 2): 2}


def test_broken_streak_rules(spark):
    rows = _winner_rows([("2024-01-01", "a"), ("2024-01-02", "a"), ("2024-01-03", "a"), ("2024-01-04", "b")])
    rows.append(("a", "2024-01-04", 50))  # a played, lost
    r = results_df(spark, rows)
    got = [(x.date.day, x.name, x.broken_streak) for x in st.broken_streaks(r).collect()]
    assert got == [(4, "a", 3)]


def test_no_rows_yesterday_no_break(spark):
    r = results_df(spark, _winner_rows([("2024-01-01", "a"), ("2024-01-02", "a"), ("2024-01-05", "b")]))
    assert st.broken_streaks(r).count() == 0


def test_first_winner_by_name_among_ties(spark):
    # day 2: a and b tie; a (first by name) has streak 1 via no day-1 win; b held 2 -> "broken" by the D9 rule
    rows = [("b", "2023-12-31", 1), ("b", "2024-01-01", 1), ("a", "2024-01-01", 9), ("a", "2024-01-02", 3), ("b", "2024-01-02", 3)]
    got = [(x.date.day, x.name, x.broken_streak) for x in st.broken_streaks(results_df(spark, rows)).collect()]
    assert got == [(2, "b", 2)]


def test_league_keys_separate(spark):
    rows = [("x", "a", "2024-01-01", 1), ("y", "a", "2024-01-02", 1), ("x", "a", "2024-01-02", 1)]
    got = sorted((r.league, r.date.day, r.streak) for r in st.streaks(results_df(spark, rows, league=True), ["league"]).collect())
    assert got == [("x", 1, 1), ("x", 2, 2), ("y", 2, 1)]
