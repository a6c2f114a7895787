from podium.operators import medians as med
from tests.conftest import results_df


def test_median_half_even(spark):
    # {1,4} -> 2.5 -> 2 ; {3,4} -> 3.5 -> 4 ; one hour and more keeps minutes
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-02", 4), ("b", "2024-01-01", 3), ("b", "2024-01-02", 4),
            ("c", "2024-01-01", 3700), ("c", "2024-01-02", 3702)]
    got = {r.name: (r.median_secs, r.median_time, r.pos) for r in med.median_times(results_df(spark, rows), None, "month").collect()}
    assert got == {"a": (2, "0:02", 1), "b": (4, "0:04", 2), "c": (3701, "61:41", 3)}


def test_weekday_medians_labels(spark):
    rows = [("a", "2024-01-06", 60), ("a", "2024-01-13", 90), ("a", "2024-01-07", 30)]  # Sat, Sat, Sun
    got = {(r.weekday, r.weekday_order, r.dow): r.median_minutes for r in med.weekday_medians(results_df(spark, rows)).collect()}
    assert got == {("Sa", 6, 7): 1.25, ("Su", 7, 1): 0.5}


def test_name_order_slowest_first(spark):
    rows = [("a", "2024-01-01", 10), ("b", "2024-01-01", 50), ("c", "2024-01-01", 50)]
    got = {r.name: r.name_order for r in med.name_order(results_df(spark, rows)).collect()}
    assert got == {"c": 1, "b": 2, "a": 3}
    pts = med.time_points(results_df(spark, rows)).collect()
    assert {p.name: p.name_order for p in pts} == got


def test_extent_and_saturday(spark):
    rows = [("a", "2024-01-06", 60), ("b", "2024-01-08", 30)]
    e = med.minutes_extent(results_df(spark, rows)).collect()[0]
    assert (e.min_minutes, e.max_minutes) == (0.5, 1.0)
    s = {r.name: r.saturday_check for r in med.saturday_split(results_df(spark, rows)).collect()}
    assert s == {"a": "Saturday", "b": "Non-Saturday"}
