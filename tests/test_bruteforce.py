"""Daily and monthly messages against a plain-Python brute force on small random inputs."""

import datetime as dt
from statistics import median

from hypothesis import given, settings
from hypothesis import strategies as hs

from podium.operators import streaks as st
from podium.plans import reports as rp
from tests.conftest import message_text, results_df

DAY0 = dt.date(2024, 1, 29)

rows_strategy = hs.lists(
    hs.tuples(hs.sampled_from("abcde"), hs.integers(0, 9), hs.integers(1, 4)),
    min_size=1,
    max_size=40,
    unique_by=lambda t: (t[0], t[1]),
)


def _fmt(s):
    return f"{s // 60}:{s % 60:02d}"


def _brute_daily(rows):
    by_day = {}
    for n, d, s in rows:
        by_day.setdefault(DAY0 + dt.timedelta(days=d), []).append((n, s))
    rank = {}
    winners = {}
    for day, rs in by_day.items():
        for n, s in rs:
            rank[(n, day)] = 1 + sum(1 for _, t in rs if t < s)
        winners[day] = sorted(n for n, s in rs if rank[(n, day)] == 1)
    streak = {}
    for day in sorted(by_day):
        for n in winners[day]:
            streak[(n, day)] = streak.get((n, day - dt.timedelta(days=1)), 0) + 1
    first = {day: (winners[day][0], streak[(winners[day][0], day)]) for day in by_day}
    texts = {}
    for day, rs in by_day.items():
        broken = {}
        prev = day - dt.timedelta(days=1)
        if prev in first and first[prev][1] > first[day][1]:
            broken[first[prev][0]] = first[prev][1]
        lines = []
        for n, s in sorted(rs, key=lambda x: (x[1], x[0])):
            r = rank[(n, day)]
            medal = {1: ":first_place_medal:", 2: ":second_place_medal:", 3: ":third_place_medal:"}.get(r, "")
            k = streak.get((n, day))
            note = f"({k}-day streak)" if r == 1 and k >= 3 else ""
            b = broken.get(n)
            bnote = f"({b}-day streak broken)" if b is not None and b > 2 else ""
            lines.append(f"{n}: {_fmt(s)} {medal} {note}{bnote}\n")
        texts[day] = f"*{day:%A, %B %d}*\n" + "".join(lines)
    return texts


@settings(max_examples=8, deadline=None)
@given(rows_strategy)
def test_daily_message_matches_brute_force(spark, rows):
    r = results_df(spark, [(n, (DAY0 + dt.timedelta(days=d)).isoformat(), s) for n, d, s in rows])
    got = {m.date: m.text for m in message_text(rp.daily_message(r), period_key="date")}
    assert got == _brute_daily(rows)


@settings(max_examples=5, deadline=None)
@given(rows_strategy)
def test_month_medians_and_wins_match_brute_force(spark, rows):
    r = results_df(spark, [(n, (DAY0 + dt.timedelta(days=d)).isoformat(), s) for n, d, s in rows])
    parts = rp.period_message(r, None, "month").collect()
    by_month = {}
    for n, d, s in rows:
        by_month.setdefault((DAY0 + dt.timedelta(days=d)).replace(day=1), []).append((n, DAY0 + dt.timedelta(days=d), s))
    for month, rs in by_month.items():
        text = {p.section: p.text for p in parts if p.period_start == month and p.page == 0}
        meds = {}
        for n, _, s in rs:
            meds.setdefault(n, []).append(s)
        rounded = {n: round(median(v)) for n, v in meds.items()}  # Python round is half-even
        want = "".join(f"{n}: {_fmt(m)}\n" for n, m in sorted(rounded.items(), key=lambda x: (x[1], x[0])))
        assert text["medians"] == "\n*Median times*\n" + want
        days = {}
        for n, d, s in rs:
            days.setdefault(d, []).append((n, s))
        wins = {}
        for d, ds in days.items():
            best = min(s for _, s in ds)
            for n, s in ds:
                if s == best:
                    wins[n] = wins.get(n, 0) + 1
        top = max(wins.values())
        lines = "".join(f"{n}: {k} {':crown:' if k == top else ''}\n" for n, k in sorted(wins.items(), key=lambda x: (-x[1], x[0])))
        assert text["wins"] == f"*{month:%B} results*\n\n*Wins*\n" + lines


@settings(max_examples=6, deadline=None)
@given(hs.lists(hs.sampled_from("abc"), min_size=3, max_size=12), hs.integers(1, 10))
def test_streaks_from_late_day_equals_full(spark, winners, cut):
    rows = [(w, (DAY0 + dt.timedelta(days=i)).isoformat(), 1) for i, w in enumerate(winners)]
    rows += [("z", (DAY0 + dt.timedelta(days=i)).isoformat(), 9) for i in range(len(winners))]
    r = results_df(spark, rows)
    full = {(x.name, x.date): x.streak for x in st.streaks(r).collect()}
    start = DAY0 + dt.timedelta(days=min(cut, len(winners) - 1))
    carried = st.streaks(r).where(f"date = date'{(start - dt.timedelta(days=1)).isoformat()}'")
    redo = {(x.name, x.date): x.streak for x in st.streaks_from(r, carried, start).collect()}
    assert redo == {k: v for k, v in full.items() if k[1] >= start}


@settings(max_examples=6, deadline=None)
@given(rows_strategy)
def test_week_message_matches_brute_force(spark, rows):
    r = results_df(spark, [(n, (DAY0 + dt.timedelta(days=d)).isoformat(), s) for n, d, s in rows])
    got = {m.period_start: m.text for m in message_text(rp.weekly_message(r))}
    medals = {1: ":first_place_medal:", 2: ":second_place_medal:", 3: ":third_place_medal:"}
    by_day = {}
    for n, d, s in rows:
        by_day.setdefault(DAY0 + dt.timedelta(days=d), []).append((n, s))
    weeks = {}
    for day, rs in by_day.items():
        week = day - dt.timedelta(days=day.weekday())
        counts = weeks.setdefault(week, {})
        for n, s in rs:
            rank = 1 + sum(1 for _, t in rs if t < s)
            if rank <= 3:
                counts.setdefault(n, {1: 0, 2: 0, 3: 0})[rank] += 1
    want = {}
    for week, counts in weeks.items():
        def key(item):  # golds, silvers, bronzes descending, none last, then name
            n, c = item
            return tuple(-c[k] if c[k] else 1 for k in (1, 2, 3)) + (n,)
        lines = "".join(f"{n}: {''.join(medals[k] * c[k] for k in (1, 2, 3))}\n" for n, c in sorted(counts.items(), key=key))
        want[week] = f"*Week {week.isocalendar()[1]} wins*\n" + lines
    assert got == want


@settings(max_examples=5, deadline=None)
@given(rows_strategy)
def test_year_fastest_and_streak_message_matches_brute_force(spark, rows):
    r = results_df(spark, [(n, (DAY0 + dt.timedelta(days=d)).isoformat(), s) for n, d, s in rows])
    got = {(m.period_start, m.message): m.text for m in message_text(rp.period_message(r, None, "year"))}
    by_day = {}
    for n, d, s in rows:
        by_day.setdefault(DAY0 + dt.timedelta(days=d), []).append((n, s))
    streak = {}
    for day in sorted(by_day):
        best = min(s for _, s in by_day[day])
        for n in sorted(n for n, s in by_day[day] if s == best):
            streak[(n, day)] = streak.get((n, day - dt.timedelta(days=1)), 0) + 1
    for year in {day.year for day in by_day}:
        ys = dt.date(year, 1, 1)
        rs = sorted(((s, day, n) for day, v in by_day.items() if day.year == year for n, s in v))[:3]
        fast = "".join(f"{_fmt(s)} by {n} on {day:%a, %b %d}\n" for s, day, n in rs)
        ss = {k: v for k, v in streak.items() if k[1].year == year}
        top = max(ss.values())
        tail = ""
        if top >= 3:
            tail = "*Longest streak*\n" + "".join(
                f"{n}: {v}, ending on {day:%a, %b %d}\n" for (n, day), v in sorted(ss.items(), key=lambda x: (x[0][1], x[0][0])) if v == top
            )
        assert got[(ys, 3)] == "*Fastest times*\n" + fast + "\n" + tail
