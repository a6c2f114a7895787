import random

from hypothesis import given, settings
from hypothesis import strategies as hs

from podium.operators import ranking as rk
from tests.conftest import results_df


def _ranks(df):
    return {(r.name, r.date.isoformat()): r.rnk for r in df.collect()}


def test_competition_rank_with_gaps_and_nulls(spark):
    r = results_df(
        spark,
        [("a", "2024-01-01", 30), ("b", "2024-01-01", 30), ("c", "2024-01-01", 40), ("d", "2024-01-01", None), ("e", "2024-01-02", 99)],
    )
    for method in ("histogram", "window"):
        got = _ranks(rk.day_rank(r, method=method))
        assert got == {
            ("a", "2024-01-01"): 1,
            ("b", "2024-01-01"): 1,
            ("c", "2024-01-01"): 3,
            ("d", "2024-01-01"): None,
            ("e", "2024-01-02"): 1,
        }


def test_all_tied_and_one_player(spark):
    r = results_df(spark, [("a", "2024-01-01", 5), ("b", "2024-01-01", 5), ("c", "2024-01-01", 5), ("z", "2024-01-02", 9)])
    assert set(_ranks(rk.day_rank(r)).values()) == {1}
    assert rk.winners(r).count() == 4


@settings(max_examples=15, deadline=None)
@given(hs.lists(hs.tuples(hs.sampled_from("abcdef"), hs.integers(0, 3), hs.integers(0, 6)), min_size=1, max_size=40))
def test_rank_is_one_plus_strictly_faster(spark, rows):
    seen, uniq = set(), []
    for n, day, s in rows:
        if (n, day) not in seen:
            seen.add((n, day))
            uniq.append((n, f"2024-01-0{day + 1}", s))
    random.Random(0).shuffle(uniq)
    r = results_df(spark, uniq)
    got = _ranks(rk.day_rank(r))
    for n, day, s in uniq:
        faster = sum(1 for m, d2, t in uniq if d2 == day and t < s)
        assert got[(n, day)] == 1 + faster


def test_medal_table_counts_null_when_none(spark):
    # week of 2024-01-01 (Mon) .. 01-07
    rows = [
        ("a", "2024-01-01", 10), ("b", "2024-01-01", 20), ("c", "2024-01-01", 30), ("d", "2024-01-01", 40),
        ("b", "2024-01-02", 10), ("a", "2024-01-02", 20), ("c", "2024-01-02", 20),
    ]
    t = {r.name: r for r in rk.medal_table(results_df(spark, rows)).collect()}
    assert set(t) == {"a", "b", "c"}
    assert (t["a"].firsts, t["a"].silvers, t["a"].thirds) == (1, 1, None)
    assert (t["c"].firsts, t["c"].silvers, t["c"].thirds) == (None, 1, 1)
    assert t["a"].placements == ":first_place_medal::second_place_medal:"
    assert [r.name for r in sorted(t.values(), key=lambda r: r.pos)] == ["a", "b", "c"]


def test_uncount_zero_gives_no_row(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "name string, n bigint")
    assert sorted(r.name for r in rk.uncount(df).collect()) == ["a", "a", "c"]


def test_period_wins_crown_ties(spark):
    rows = [("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-01-02", 5), ("a", "2024-02-01", 1)]
    got = {(r.period_start.month, r.name): (r.n, r.rnk, r.mark) for r in rk.period_wins(results_df(spark, rows), None, "month").collect()}
    assert got == {(1, "a"): (1, 1, ":crown:"), (1, "b"): (1, 1, ":crown:"), (2, "a"): (1, 1, ":crown:")}


def test_fastest_exactly_three(spark):
    rows = [(n, "2024-01-0%d" % (i % 5 + 1), 10) for i, n in enumerate("abcdefgh")]
    f = rk.fastest(results_df(spark, rows), None, "month", 3).collect()
    assert [r.pos for r in sorted(f, key=lambda r: r.pos)] == [1, 2, 3]
    assert f[0].line.endswith("\n") and " by " in f[0].line


def test_rank_distribution_sums_to_rows(spark):
    rows = [(n, "2024-01-0%d" % d, (d * 7 + i * 3) % 5) for d in range(1, 6) for i, n in enumerate("abcd")]
    r = results_df(spark, rows)
    dist = rk.rank_distribution(r, None, "year").collect()
    assert sum(x.n for x in dist) == len(rows)


@settings(max_examples=10, deadline=None)
@given(hs.lists(hs.tuples(hs.sampled_from("xy"), hs.text("abcdef", min_size=1, max_size=3), hs.one_of(hs.none(), hs.integers(0, 4))), min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1])))
def test_ranked_position_equals_row_number(spark, rows):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "g string, name string, v int")
    for desc in (False, True):
        got = {(r.g, r.name): r.pos for r in rk.ranked_position(df, ["g"], "v", "name", descending=desc).collect()}
        if desc:
            order = [F.col("v").desc_nulls_last(), F.col("name").desc_nulls_last()]
        else:
            order = [F.col("v").asc_nulls_last(), F.col("name").asc_nulls_last()]
        want = {(r.g, r.name): r.pos for r in df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order))).collect()}
        assert got == want


def _random_results(spark, seed, n=400):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(seed)
    rows = [(rng.choice([None, "e", "w"]), rng.choice(["a", "b", "c", "d", "e", "f", None]), f"2024-01-{rng.randrange(1, 6):02d}", rng.choice([None, 20, 20, 20, 21, 30])) for _ in range(n)]
    r = results_df(spark, rows, league=True)
    return r.withColumn("date", F.when(F.col("date") != "2024-01-05", F.col("date")))  # and rows without a day


def test_top_ranks_by_values_equal_the_window(spark):
    r = _random_results(spark, 1)
    for k in (1, 2, 3):
        for by in (None, ["league"]):
            got = rk.top_ranks(r, by, k)
            want = rk.top_ranks(r, by, k, "window").select(*got.columns)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_positions_under_huge_ties_equal_the_window(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(rng.choice([None, "e", "w", "w", "w"]), f"p{i}" if i % 50 else None, rng.choice([None, 1, 1, 1, 1, 2, 5])) for i in range(1500)]
    df = spark.createDataFrame(rows, "league string, name string, n int").repartition(4).dropDuplicates()
    for down in (False, True):
        args = (df, ["league"], "n", "name", down, "pos", None, "rnk")
        key = lambda d: sorted(map(tuple, d.select("league", "name", "n", "pos", "rnk").collect()), key=str)
        want = key(rk.ranked_position(*args))
        assert key(rk.ranked_position(*args, checked=True)) == want
        with monkeypatch.context() as m:
            m.setattr(rk, "TIE_ROWS", 10)
            m.setattr(rk, "positions_by_range", (lambda whole: lambda *a: called.append(1) or whole(*a))(rk.positions_by_range))
            called = []
            assert key(rk.ranked_position(*args, checked=True)) == want and called


def test_reports_with_huge_ties_are_the_same(spark, monkeypatch):
    from podium.plans import reports as rp

    r = _random_results(spark, 5).where("name IS NOT NULL AND date IS NOT NULL").dropDuplicates(["league", "name", "date"])
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    want = key(rp.period_message(r, ["league"])), key(rp.weekly_message(r, ["league"]))
    monkeypatch.setattr(rk, "TIE_ROWS", 0)
    assert (key(rp.period_message(r, ["league"], checked=True)), key(rp.weekly_message(r, ["league"], checked=True))) == want
