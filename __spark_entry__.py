"""

``entry(spark)`` runs the flagship report on sf0.001; ``queries()`` maps each
gives the same result as DuckDB SQL over the driver's tables.  Fixture views
(FIXTURES.md) are inlined in the SQL as CTEs.  Where the reference computes a
thing in a particular way (streaks by lag / start flag / running sum), the
oracle does it that way, independently of the Spark formulation.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

# importable when loaded by file path from another working directory
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.texts import DAILY_TITLE
from podium.functions.timefmt import format_secs, format_secs_unpadded, parse_time, repair_time
from podium.operators import ingest as ing
from podium.operators import medians as med
from podium.operators import ranking as rk
from podium.operators import streaks as st
from podium.plans import reports as rp
from podium.plans import jobs
from podium.plans import stored_runs as sr
from podium.sources import fixtures as fx
from podium.sources.tables import parse_board_text
from podium.streaming import board_stream

try:  # the corpus operators and their pipeline are optional
    import corpus_pipeline
    from podium.llm import queries as corpus
except ImportError:
    corpus = None

AS_OF = dt.date(2001, 8, 1)
LEAGUE = ["league"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly report parts (wins, fastest, medians, streaks) for every month."""
    return rp.period_message(fx.results(spark, "/root/testdata/sf0.001"), None, "month")


# -- Spark side ------------------------------------------------------------------


def _stored(spark, d):
    return ing.clean_stored(fx.sheet(spark, d))


def _parse_time(spark, d):
    s = fx.sheet(spark, d).withColumn("time", repair_time("time"))
    return s.select("name", "time", "date", parse_time("time").alias("secs"))


def _format(fn):
    def q(spark, d):
        b = fx.board_flat(spark, d).where(F.col("secs").isNotNull())
        return b.select("date", "name", "secs", fn("secs").alias("time"))

    return q


def _repair(spark, d):
    return fx.sheet(spark, d).withColumn("time", repair_time("time"))


def _flatten(spark, d):
    return ing.flatten_board(fx.board_docs(spark, d))


def _new_rows(spark, d):
    return ing.new_rows(fx.incoming(spark, d), _stored(spark, d))


def _orphans(spark, d):
    return ing.orphan_rows(_stored(spark, d), fx.incoming(spark, d))


def _append(spark, d):
    stored = _stored(spark, d)
    return ing.append_rows(stored, ing.new_rows(fx.incoming(spark, d), stored))


def _ingest(spark, d):
    return ing.ingest(fx.sheet(spark, d), fx.incoming(spark, d))


def _res(fn, league=False):
    def q(spark, d):
        if league:
            return fn(fx.league_results(spark, d), LEAGUE)
        return fn(fx.results(spark, d), None)

    return q


def _uncount(spark, d):
    return rk.uncount(rk.medal_counts(fx.results(spark, d), None, "week"))


def _stream(spark, d):
    return board_stream.stream_board_fixture(spark, d)


def _positional(spark, d):
    """Boards delivered as two parallel arrays, solved entries first (the positional form)."""
    docs = fx.board_docs(spark, d).select(
        "date", F.array_sort(F.col("data"), lambda a, b: F.when(a.score.secondsSpentSolving.isNull() & b.score.secondsSpentSolving.isNotNull(), 1)
                             .when(a.score.secondsSpentSolving.isNotNull() & b.score.secondsSpentSolving.isNull(), -1)
                             .otherwise(0)).alias("data")
    )
    arrays = docs.select(
        "date",
        F.transform("data", lambda x: x["name"]).alias("names"),
        F.filter(F.transform("data", lambda x: x["score"]["secondsSpentSolving"]), lambda t: t.isNotNull()).alias("times"),
    )
    return ing.pair_positional(arrays, "names", "times")


def _board_text(spark, d):
    """Boards held as JSON text (e.g. response bodies) parsed with the declared schema."""
    text = fx.board_docs(spark, d).select(F.to_json(F.struct("date", "data")).alias("value"))
    return ing.flatten_board(parse_board_text(text))


def _as_of(build):
    def q(spark, d):
        return build(fx.results(spark, d))

    return q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # ingest and cleaning
        "parse_time": _parse_time,
        "format_time": _format(format_secs),
        "format_time_unpadded": _format(format_secs_unpadded),
        "repair_time": _repair,
        "time_rejects": lambda s, d: ing.rejects(fx.sheet(s, d)),
        "dedupe_keep_first": lambda s, d: _stored(s, d),
        "flatten_board": _flatten,
        "pair_positional": _positional,
        "parse_board_json": _board_text,
        "new_rows": _new_rows,
        "orphan_rows": _orphans,
        "append_rows": _append,
        "ingest": _ingest,
        "progress_marker": _res(lambda r, by: ing.progress_marker(r, by), league=True),
        "stream_ingest": _stream,
        # filters
        "lookback_90d": _res(lambda r, by: rp.lookback(r, AS_OF, 90)),
        "publish_guard": _res(lambda r, by: rp.publish_guard(r, by, "month")),
        "saturday_split": _res(med.saturday_split),
        # ranking
        "day_rank": _res(rk.day_rank),
        "day_rank_league": _res(rk.day_rank, league=True),
        "participants": _res(rk.participants),
        "medal_counts": _res(lambda r, by: rk.medal_counts(r, by, "week")),
        "uncount": _uncount,
        "medal_table": _res(lambda r, by: rk.medal_table(r, by, "week")),
        "medal_table_league": _res(lambda r, by: rk.medal_table(r, by, "week"), league=True),
        "rank_distribution": _res(lambda r, by: rk.rank_distribution(r, by, "year")),
        # streaks
        "streaks": _res(st.streaks),
        "streaks_league": _res(st.streaks, league=True),
        "results_with_streaks": _res(st.results_with_streaks),
        "broken_streaks": _res(st.broken_streaks),
        "broken_streaks_league": _res(st.broken_streaks, league=True),
        # medians and plot tables
        "weekday_medians": _res(lambda r, by: med.weekday_medians(r, by, "year")),
        "name_order": _res(lambda r, by: med.name_order(r, by, "month")),
        "time_points": _res(lambda r, by: med.time_points(r, by, "month")),
        "minutes_extent": _res(lambda r, by: med.minutes_extent(r, by, "month")),
        # daily
        "daily_standings": _res(rp.daily_standings),
        "daily_standings_league": _res(rp.daily_standings, league=True),
        "daily_message": _res(rp.daily_message),
        "daily_plot_data": _res(rp.daily_plot_data),
        "text_bar": _res(rp.text_bar),
        # weekly / monthly / annual reports
        "report_text_week": _res(rp.weekly_message),
        "report_text_month": _res(lambda r, by: rp.period_message(r, by, "month")),
        "report_text_year": _res(lambda r, by: rp.period_message(r, by, "year")),
        "report_text_month_league": _res(lambda r, by: rp.period_message(r, by, "month"), league=True),
        # one period, as the scheduled scripts post it (date-range filters reach the scan)
        "daily_message_as_of": _as_of(lambda r: jobs.daily_report_for(r, AS_OF)),
        "report_text_this_week": _as_of(lambda r: jobs.period_report_for(r, AS_OF, None, "week")),
        "report_text_last_month": _as_of(lambda r: jobs.period_report_for(r, AS_OF, None, "month")),
        "report_text_last_year": _as_of(lambda r: jobs.period_report_for(r, AS_OF, None, "year")),
        "report_text_last_month_lookback": _as_of(lambda r: jobs.period_report_for(r, AS_OF, None, "month", lookback_days=90)),
        # the jobs on stored tables
        "board_from_files": sr.board_from_files,
        "stamped_rows": sr.stamped_rows,
        "sheet_from_csv": sr.sheet_from_csv,
        "appended_and_overwritten": sr.appended_and_overwritten,
        "write_order": sr.write_order,
        "messages_written": sr.messages_written,
        "days_in_zone": sr.days_in_zone,
        "ingest_rejects": sr.rejected_rows,
        "rejects_classified": sr.classified_rejects,
        "polls_by_ledger": sr.polls_by_ledger,
        "marker_after_crash": sr.marker_after_crash,
        "reconciled_orphans": sr.reconciled,
        "daily_message_incremental": sr.daily_after_second_poll,
        "report_month_from_streaks": sr.month_from_streak_table,
        "report_month_from_counts": sr.month_from_counts,
        "rank_distribution_from_counts": sr.year_ranks_from_counts,
        "weekday_medians_from_counts": sr.year_weekdays_from_counts,
    }
    for p in ("week", "month", "year"):
        q[f"period_wins_{p}"] = _res(lambda r, by, p=p: rk.period_wins(r, by, p))
        q[f"fastest_three_{p}"] = _res(lambda r, by, p=p: rk.fastest(r, by, p, 3))
    for p in ("month", "year"):
        q[f"median_times_{p}"] = _res(lambda r, by, p=p: med.median_times(r, by, p))
        q[f"longest_streak_{p}"] = _res(lambda r, by, p=p: st.longest_streak(r, by, p, 3))
    q["period_wins_month_league"] = _res(lambda r, by: rk.period_wins(r, by, "month"), league=True)
    q["daily_message_league"] = _res(rp.daily_message, league=True)
    q["participants_league"] = _res(rk.participants, league=True)
    q["publish_guard_league"] = _res(lambda r, by: rp.publish_guard(r, by, "month"), league=True)
    q["results_with_streaks_league"] = _res(st.results_with_streaks, league=True)
    q["period_wins_year_league"] = _res(lambda r, by: rk.period_wins(r, by, "year"), league=True)
    q["median_times_year_league"] = _res(lambda r, by: med.median_times(r, by, "year"), league=True)
    q["report_text_year_league"] = _res(lambda r, by: rp.period_message(r, by, "year"), league=True)
    for p in ("week", "year"):
        q[f"time_points_{p}"] = _res(lambda r, by, p=p: med.time_points(r, by, p))
        q[f"minutes_extent_{p}"] = _res(lambda r, by, p=p: med.minutes_extent(r, by, p))
    q["rank_distribution_league"] = _res(lambda r, by: rk.rank_distribution(r, by, "year"), league=True)
    q["medal_counts_league"] = _res(lambda r, by: rk.medal_counts(r, by, "week"), league=True)
    q["text_bar_league"] = _res(rp.text_bar, league=True)
    q["fastest_three_month_league"] = _res(lambda r, by: rk.fastest(r, by, "month", 3), league=True)
    q["longest_streak_month_league"] = _res(lambda r, by: st.longest_streak(r, by, "month", 3), league=True)
    q["weekday_medians_league"] = _res(lambda r, by: med.weekday_medians(r, by, "year"), league=True)
    q["median_times_month_league"] = _res(lambda r, by: med.median_times(r, by, "month"), league=True)
    if corpus is not None:
        q.update(corpus.QUERIES)
        q["pipeline"] = corpus_pipeline.run
    return q


# -- DuckDB side -------------------------------------------------------------------

NL = "chr(10)"


def _fmt(x: str) -> str:
    return f"concat(cast(cast(floor({x} / 60) as bigint) as varchar), ':', printf('%02d', cast({x} % 60 as bigint)))"


def _fmt_unpadded(x: str) -> str:
    return f"concat(cast(cast(floor({x} / 60) as bigint) as varchar), ':', cast(cast({x} % 60 as bigint) as varchar))"


def _trunc(p: str, x: str = "date") -> str:
    return f"cast(date_trunc('{p}', {x}) as date)"


def _label(p: str, x: str = "period_start") -> str:
    return {
        "week": f"concat('Week ', cast(weekofyear({x}) as varchar))",
        "month": f"strftime({x}, '%B')",
        "year": f"strftime({x}, '%Y')",
    }[p]


_SECS = "cast(20 + floor(o_totalprice / 1000) as integer)"
_CUSTOMER = "concat('player_', cast(o_custkey as varchar))"
_DAY = "(case when o_orderkey % 5 = 0 then cast(date_trunc('year', o_orderdate) as date) else cast(o_orderdate as date) end)"
_WEEK = f"cast(floor(({_DAY} - date '1990-01-01') / 7) as bigint)"
_PLAYER = f"(case when o_orderkey % 2 = 0 then concat('regular_', cast({_WEEK} % 8 as varchar)) else {_CUSTOMER} end)"
_RESULT_SECS = f"(case when o_orderkey % 2 = 0 then cast(20 + floor(o_totalprice / 8000) as integer) else {_SECS} end)"

RESULTS = f"""results as (
  select name, date, secs, {_fmt('secs')} as time from (
    select {_PLAYER} as name, {_DAY} as date, min({_RESULT_SECS}) as secs
    from orders group by 1, 2) r0
)"""

LEAGUE_RESULTS = f"""results as (
  select league, name, date, secs, {_fmt('secs')} as time from (
    select case when o_custkey % 101 <> 0 then c_mktsegment end as league,
           case when o_custkey % 499 <> 0 or o_orderkey % 2 = 0 then {_PLAYER} end as name,
           {_DAY} as date, min({_RESULT_SECS}) as secs
    from orders join customer on o_custkey = c_custkey group by 1, 2, 3) r0
)"""

SHEET = f"""sheet as (
  select o_orderdate + to_seconds(o_orderkey % 86400) as submitted_at,
         case when o_orderkey % 503 <> 0 then {_CUSTOMER} end as name,
         case when o_orderkey % 509 = 0 then 'dnf'
              else concat(case when m = 0 then '' else cast(m as varchar) end, ':', printf('%02d', s % 60)) end as time,
         cast(o_orderdate as date) as date
  from (select *, {_SECS} as s, cast(floor({_SECS} / 60) as bigint) as m from orders) o
)"""

INCOMING = f"""incoming as (
  select distinct {_CUSTOMER} as name, {_fmt('s')} as time, cast(o_orderdate as date) as date
  from (select *, {_SECS} - case when o_orderpriority = '1-URGENT' then 7 else 0 end as s
        from orders where o_orderpriority in ('1-URGENT', '2-HIGH')) o
)"""

BOARD_FLAT = """board_flat as (
  select cast(ts as date) as date, concat('player_', cast(user_id as varchar)) as name,
         min(case when event_type <> 'error' then 10 + cast(floor(value) as integer) end) as secs
  from events group by 1, 2
)"""


def _parse(x: str) -> str:
    t = f"trim({x})"
    return (
        f"(case when regexp_full_match({t}, '[0-9]+:[0-9]+') then "
        f"try_cast(split_part({t}, ':', 1) as integer) * 60 + try_cast(split_part({t}, ':', 2) as integer) end)"
    )


_REPAIR = "case when starts_with(time, ':') then concat('0', time) else time end"

REPAIRED = f"""repaired as (select submitted_at, name, {_REPAIR} as time, date from sheet)"""
STORED = """stored as (select min(submitted_at) as submitted_at, name, time, date from repaired group by name, time, date)"""
NEW_ROWS = f"""new_rows as (
  select i.name, i.time, i.date from incoming i
  where not exists (select 1 from stored s where s.name is not distinct from i.name
                    and s.date is not distinct from i.date and {_parse('s.time')} is not distinct from {_parse('i.time')})
)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _ranked(part: str = "date") -> str:
    return f"ranked as (select *, cast(rank() over (partition by {part} order by secs) as bigint) as rnk from results)"


def _streaks_cte(by: str = "") -> list[str]:
    """The reference's own streak formulation: lag, start flag, running sum, row number."""
    b = f"{by}, " if by else ""
    return [
        _ranked(f"{b}date"),
        f"won as (select {b}name, date from ranked where rnk = 1)",
        f"lagged as (select {b}name, date, lag(date) over (partition by {b}name order by date) as lag_date from won)",
        f"flags as (select {b}name, date, case when lag_date is null or lag_date <> date - 1 then 1 else 0 end as start_id from lagged)",
        f"ids as (select {b}name, date, sum(start_id) over (partition by {b}name order by date rows between unbounded preceding and current row) as streak_id from flags)",
        f"streaks as (select {b}name, date, cast(row_number() over (partition by {b}name, streak_id order by date) as bigint) as streak from ids)",
    ]


def _broken_cte(by: str = "") -> list[str]:
    b = f"{by}, " if by else ""
    on = f"y.{by} is not distinct from t.{by} and " if by else ""
    sel = f"t.{by}, " if by else ""
    return [
        f"firsts as (select {b}date, min(name) as name, arg_min(streak, name) as streak from streaks group by {b}date)",
        f"""broken as (select {sel}t.date, y.name, y.streak as broken_streak from firsts t join firsts y
             on {on}y.date = t.date - 1 where y.streak > t.streak)""",
    ]


def _wins_cte(p: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""wins as (
  select {b}period_start, name, n,
         cast(rank() over (partition by {b}period_start order by n desc) as bigint) as rnk,
         cast(row_number() over (partition by {b}period_start order by n desc, name) as bigint) as pos
  from (select {b}{_trunc(p)} as period_start, name, count(*) as n from ranked where rnk = 1 group by all) w0
)"""


def _fastest_cte(p: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""fast as (
  select * from (
    select {b}{_trunc(p)} as period_start,
           cast(row_number() over (partition by {b}{_trunc(p)} order by secs, date, name) as bigint) as pos,
           name, date, secs, time,
           concat(time, ' by ', coalesce(name, 'NA'), ' on ', strftime(date, '%a, %b %d'), {NL}) as line
    from results) f0 where pos <= 3
)"""


def _median_cte(p: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""med as (
  select {b}period_start, name, median_secs, {_fmt('median_secs')} as median_time,
         cast(row_number() over (partition by {b}period_start order by median_secs, name) as bigint) as pos,
         concat(coalesce(name, 'NA'), ': ', {_fmt('median_secs')}, {NL}) as line
  from (select {b}period_start, name, cast(round_even(m, 0) as bigint) as median_secs
        from (select {b}{_trunc(p)} as period_start, name, median(secs) as m from results group by all) m0) m1
)"""


def _longest_cte(p: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""longest as (
  select {b}period_start, name, streak, date,
         concat(coalesce(name, 'NA'), ': ', cast(streak as varchar), ', ending on ', strftime(date, '%a, %b %d'), {NL}) as line,
         cast(row_number() over (partition by {b}period_start order by date, name) as bigint) as pos
  from (select {b}{_trunc(p)} as period_start, name, streak, date,
               rank() over (partition by {b}{_trunc(p)} order by streak desc) as r from streaks) l0
  where r = 1 and streak >= 3
)"""


def _parts_sql(periods: str, spec: str, heads_case: str, key: str = "period_start", by: str = "") -> str:
    ks = [by, key] if by else [key]
    sel_p = ", ".join(f"p.{k}" for k in ks)
    sel_h = ", ".join(f"h.{k}" for k in ks)
    on = " and ".join(f"pg.{k} is not distinct from h.{k}" for k in [*ks, "section"])
    return f"""pages as (
  select {", ".join(ks)}, section, cast(floor((pos - 1) / 50) as bigint) as page, string_agg(line, '' order by pos, o1, o2) as body
  from lines group by all
),
periods as ({periods}),
spec as (select * from (values {spec}) v(message, seq, section, always)),
heads as (select {sel_p}, s.message, s.seq, s.section, s.always, {heads_case} as header from periods p cross join spec s)
select {sel_h}, h.message, h.seq, h.section, coalesce(pg.page, 0) as page,
       concat(case when coalesce(pg.page, 0) = 0 and h.seq > 1 then {NL} else '' end,
              case when coalesce(pg.page, 0) = 0 and (pg.body is not null or h.always) then h.header else '' end,
              coalesce(pg.body, '')) as text
from heads h left join pages pg on {on}"""


def _report_sql(p: str) -> str:
    spec = (
        "(1, 1, 'wins', true), (2, 1, 'medians', true), (3, 1, 'fastest', true), (3, 2, 'streak', false)"
        if p == "year"
        else "(1, 1, 'wins', true), (1, 2, 'fastest', true), (1, 3, 'medians', true), (1, 4, 'streak', false)"
    )
    heads = (
        f"case s.section when 'wins' then concat('*', {_label(p, 'p.period_start')}, ' results*', {NL}, {NL}, '*Wins*', {NL})"
        f" when 'fastest' then concat('*Fastest times*', {NL}) when 'medians' then concat('*Median times*', {NL})"
        f" else concat('*Longest streak*', {NL}) end"
    )
    lines = f"""lines as (
  select period_start, 'wins' as section, pos, cast(null as bigint) as o1, cast(null as varchar) as o2,
         concat(coalesce(name, 'NA'), ': ', cast(n as varchar), ' ', case when rnk = 1 then ':crown:' else '' end, {NL}) as line from wins
  union all select period_start, 'fastest', pos, null, null, line from fast
  union all select period_start, 'medians', pos, null, null, line from med
  union all select period_start, 'streak', pos, null, null, line from longest
)"""
    return _with(
        RESULTS, *_streaks_cte(), _wins_cte(p), _fastest_cte(p), _median_cte(p), _longest_cte(p), lines
    ) + ", " + _parts_sql(f"select distinct {_trunc(p)} as period_start from results", spec, heads)


def _medal_table_sql(by: str = "") -> str:
    b = f"{by}, " if by else ""
    return _with(
        RESULTS if not by else LEAGUE_RESULTS,
        _ranked(f"{b}date"),
        f"""c as (select {b}{_trunc('week')} as period_start, name,
                 cast(sum(case when rnk = 1 then 1 end) as bigint) as firsts,
                 cast(sum(case when rnk = 2 then 1 end) as bigint) as silvers,
                 cast(sum(case when rnk = 3 then 1 end) as bigint) as thirds
          from ranked where rnk <= 3 group by all)""",
    ) + f"""select {b}period_start, name,
  concat(repeat(':first_place_medal:', coalesce(firsts, 0)), repeat(':second_place_medal:', coalesce(silvers, 0)),
         repeat(':third_place_medal:', coalesce(thirds, 0))) as placements,
  firsts, silvers, thirds,
  cast(row_number() over (partition by {b}period_start order by firsts desc nulls last, silvers desc nulls last,
                          thirds desc nulls last, name) as bigint) as pos
from c"""


def _standings_cte(by: str = "") -> str:
    b = f"{by}, " if by else ""
    on_b = f"s.{by} is not distinct from r.{by} and " if by else ""
    on_k = f"k.{by} is not distinct from r.{by} and " if by else ""
    sel = f"r.{by}, " if by else ""
    return f"""standings as (
  select {sel}r.date, r.name, r.time, r.secs, r.rnk,
         s.streak, k.broken_streak,
         case when r.rnk = 1 then ':first_place_medal:' when r.rnk = 2 then ':second_place_medal:'
              when r.rnk = 3 then ':third_place_medal:' else '' end as medal,
         case when r.rnk = 1 and s.streak >= 3 then concat('(', cast(s.streak as varchar), '-day streak)') else '' end as streak_text,
         case when k.broken_streak > 2 then concat('(', cast(k.broken_streak as varchar), '-day streak broken)') else '' end as broken_text
  from ranked r
  left join streaks s on {on_b}s.name is not distinct from r.name and s.date = r.date
  left join broken k on {on_k}k.date = r.date and k.name is not distinct from r.name
)"""


def _line_sql() -> str:
    return f"concat(coalesce(name, 'NA'), ': ', coalesce(time, 'NA'), ' ', medal, ' ', streak_text, broken_text, {NL})"


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["parse_time"] = _with(SHEET) + f"select name, {_REPAIR} as time, date, {_parse(_REPAIR)} as secs from sheet"
    o["format_time"] = _with(BOARD_FLAT) + f"select date, name, secs, {_fmt('secs')} as time from board_flat where secs is not null"
    o["format_time_unpadded"] = (
        _with(BOARD_FLAT) + f"select date, name, secs, {_fmt_unpadded('secs')} as time from board_flat where secs is not null"
    )
    o["repair_time"] = _with(SHEET, REPAIRED) + "select * from repaired"
    o["time_rejects"] = _with(SHEET) + f"""select submitted_at, name, time, date, {_parse('time')} as secs from sheet
where name is null or date is null or {_parse('time')} is null"""
    o["dedupe_keep_first"] = _with(SHEET, REPAIRED, STORED) + "select * from stored"
    o["flatten_board"] = _with(BOARD_FLAT) + "select date, name, secs from board_flat where secs is not null"
    o["new_rows"] = _with(SHEET, REPAIRED, STORED, INCOMING, NEW_ROWS) + "select * from new_rows"
    o["orphan_rows"] = _with(SHEET, REPAIRED, STORED, INCOMING) + f"""select s.* from stored s
where s.date in (select date from incoming)
  and not exists (select 1 from incoming i where i.name is not distinct from s.name and i.date is not distinct from s.date
                  and {_parse('i.time')} is not distinct from {_parse('s.time')})"""
    o["append_rows"] = (
        _with(SHEET, REPAIRED, STORED, INCOMING, NEW_ROWS)
        + "select * from stored union all select null as submitted_at, name, time, date from new_rows"
    )
    o["ingest"] = _with(SHEET, REPAIRED, STORED, INCOMING, NEW_ROWS) + f"""select name, date, secs, {_fmt('secs')} as time from (
  select name, date, min(secs) as secs from (
    select name, date, {_parse('time')} as secs from stored
    union all select name, date, {_parse('time')} from new_rows) u
  where name is not null and date is not null and secs is not null group by name, date) m"""
    o["progress_marker"] = _with(LEAGUE_RESULTS) + "select league, max(date) as latest_date from results group by league"
    o["stream_ingest"] = o["flatten_board"]
    o["pair_positional"] = o["flatten_board"]
    o["parse_board_json"] = o["flatten_board"]
    o["lookback_90d"] = _with(RESULTS) + f"select * from results where date > date '{AS_OF.isoformat()}' - 90"
    o["publish_guard"] = (
        _with(RESULTS) + f"select {_trunc('month')} as period_start, count(*) as rows, max(date) as latest_date from results group by 1"
    )
    o["saturday_split"] = _with(RESULTS) + """select name, date, secs / cast(60 as double) as minutes,
  cast(dayofweek(date) + 1 as integer) as weekday,
  case when dayofweek(date) = 6 then 'Saturday' else 'Non-Saturday' end as saturday_check from results"""
    o["day_rank"] = _with(RESULTS, _ranked()) + "select * from ranked"
    o["day_rank_league"] = _with(LEAGUE_RESULTS, _ranked("league, date")) + "select * from ranked"
    o["participants"] = _with(RESULTS) + "select date, count(*) as players from results group by date"
    o["medal_counts"] = (
        _with(RESULTS, _ranked())
        + f"select {_trunc('week')} as period_start, name, rnk, count(*) as n from ranked where rnk <= 3 group by all"
    )
    o["uncount"] = (
        _with(RESULTS, _ranked())
        + f"select {_trunc('week')} as period_start, name, rnk from ranked where rnk <= 3"
    )
    o["medal_table"] = _medal_table_sql()
    o["medal_table_league"] = _medal_table_sql("league")
    o["rank_distribution"] = (
        _with(RESULTS, _ranked()) + f"select {_trunc('year')} as period_start, name, rnk, count(*) as n from ranked group by all"
    )
    o["streaks"] = _with(RESULTS, *_streaks_cte()) + "select * from streaks"
    o["streaks_league"] = _with(LEAGUE_RESULTS, *_streaks_cte("league")) + "select * from streaks"
    o["results_with_streaks"] = (
        _with(RESULTS, *_streaks_cte())
        + "select r.name, r.date, r.secs, r.time, s.streak from results r left join streaks s on s.name = r.name and s.date = r.date"
    )
    o["broken_streaks"] = _with(RESULTS, *_streaks_cte(), *_broken_cte()) + "select * from broken"
    o["broken_streaks_league"] = _with(LEAGUE_RESULTS, *_streaks_cte("league"), *_broken_cte("league")) + "select * from broken"
    o["weekday_medians"] = _with(RESULTS) + f"""select period_start, name, dow, weekday, weekday_order,
  median(secs) / cast(60 as double) as median_minutes
from (select {_trunc('year')} as period_start, name, cast(dayofweek(date) + 1 as integer) as dow,
             ['Su', 'M', 'Tu', 'W', 'Th', 'F', 'Sa'][dayofweek(date) + 1] as weekday,
             cast((dayofweek(date) + 6) % 7 + 1 as integer) as weekday_order, secs from results) w
group by all"""
    o["name_order"] = _with(RESULTS, _name_order_cte("month")) + "select * from no"
    for p, suffix in (("month", ""), ("week", "_week"), ("year", "_year")):
        o[f"time_points{suffix}"] = _with(RESULTS, _name_order_cte(p)) + f"""select p.period_start, p.name, p.date, p.minutes, p.saturday_check, no.name_order
from (select {_trunc(p)} as period_start, name, date, secs / cast(60 as double) as minutes,
             case when dayofweek(date) = 6 then 'Saturday' else 'Non-Saturday' end as saturday_check from results) p
left join no on no.period_start = p.period_start and no.name = p.name"""
        o[f"minutes_extent{suffix}"] = _with(RESULTS) + f"""select {_trunc(p)} as period_start, min(secs / cast(60 as double)) as min_minutes,
  max(secs / cast(60 as double)) as max_minutes from results group by 1"""
    o["daily_standings"] = (
        _with(RESULTS, *_streaks_cte(), *_broken_cte(), _standings_cte()) + f"select *, {_line_sql()} as line from standings"
    )
    o["daily_standings_league"] = (
        _with(LEAGUE_RESULTS, *_streaks_cte("league"), *_broken_cte("league"), _standings_cte("league"))
        + f"select *, {_line_sql()} as line from standings"
    )
    o["daily_message"] = _with(
        RESULTS, *_streaks_cte(), *_broken_cte(), _standings_cte(), f"""lines as (select date, 'standings' as section,
             rnk + row_number() over (partition by date, secs order by name) - 1 as pos,
             cast(null as bigint) as o1, cast(null as varchar) as o2, {_line_sql()} as line from standings)"""
    ) + ", " + _parts_sql(
        "select distinct date from results",
        "(1, 1, 'standings', true)",
        f"concat('*', strftime(p.date, '%A, %B %d'), '*', {NL})",
        key="date",
    )
    o["daily_message_league"] = _with(
        LEAGUE_RESULTS,
        *_streaks_cte("league"),
        *_broken_cte("league"),
        _standings_cte("league"),
        f"""lines as (select league, date, 'standings' as section,
             rnk + row_number() over (partition by league, date, secs order by name) - 1 as pos,
             cast(null as bigint) as o1, cast(null as varchar) as o2, {_line_sql()} as line from standings)""",
    ) + ", " + _parts_sql(
        "select distinct league, date from results",
        "(1, 1, 'standings', true)",
        f"concat('*', strftime(p.date, '%A, %B %d'), '*', {NL})",
        key="date",
        by="league",
    )
    o["participants_league"] = _with(LEAGUE_RESULTS) + "select league, date, count(*) as players from results group by all"
    o["publish_guard_league"] = (
        _with(LEAGUE_RESULTS)
        + f"select league, {_trunc('month')} as period_start, count(*) as rows, max(date) as latest_date from results group by all"
    )
    o["results_with_streaks_league"] = _with(LEAGUE_RESULTS, *_streaks_cte("league")) + """select r.league, r.name, r.date, r.secs, r.time, s.streak
from results r left join streaks s on s.league is not distinct from r.league and s.name is not distinct from r.name and s.date = r.date"""
    o["period_wins_year_league"] = _with(LEAGUE_RESULTS, _ranked("league, date"), _wins_cte("year", "league")) + (
        "select league, period_start, name, n, rnk, pos, case when rnk = 1 then ':crown:' else '' end as mark from wins"
    )
    o["median_times_year_league"] = _with(LEAGUE_RESULTS, _median_cte("year", "league")) + "select * from med"
    o["report_text_year_league"] = _league_report_sql("year")
    o["rank_distribution_league"] = (
        _with(LEAGUE_RESULTS, _ranked("league, date"))
        + f"select league, {_trunc('year')} as period_start, name, rnk, count(*) as n from ranked group by all"
    )
    o["medal_counts_league"] = (
        _with(LEAGUE_RESULTS, _ranked("league, date"))
        + f"select league, {_trunc('week')} as period_start, name, rnk, count(*) as n from ranked where rnk <= 3 group by all"
    )
    o["text_bar_league"] = _with(LEAGUE_RESULTS) + """select league, date, name, secs, relative,
  concat(repeat('━', relative), repeat('　', 8 - relative)) as bar
from (select r.league, r.date, r.name, r.secs,
             cast(floor(cast(7 as double) / cast(m.max_secs as double) * cast(r.secs as double)) as integer) as relative
      from results r join (select league, date, max(secs) as max_secs from results group by all) m
        on m.league is not distinct from r.league and m.date = r.date) t"""
    o["fastest_three_month_league"] = _with(LEAGUE_RESULTS, _fastest_cte("month", "league")) + "select * from fast"
    o["longest_streak_month_league"] = (
        _with(LEAGUE_RESULTS, *_streaks_cte("league"), _longest_cte("month", "league")) + "select * from longest"
    )
    o["weekday_medians_league"] = _with(LEAGUE_RESULTS) + f"""select league, period_start, name, dow, weekday, weekday_order,
  median(secs) / cast(60 as double) as median_minutes
from (select league, {_trunc('year')} as period_start, name, cast(dayofweek(date) + 1 as integer) as dow,
             ['Su', 'M', 'Tu', 'W', 'Th', 'F', 'Sa'][dayofweek(date) + 1] as weekday,
             cast((dayofweek(date) + 6) % 7 + 1 as integer) as weekday_order, secs from results) w
group by all"""
    o["daily_plot_data"] = _with(RESULTS, *_streaks_cte(), *_broken_cte(), _standings_cte()) + """select s.date, s.name,
  cast(n.players - (s.rnk + row_number() over (partition by s.date, s.secs order by s.name) - 1) + 1 as bigint) as name_order,
  s.secs, s.time,
  case when s.rnk = 1 then '1' when s.rnk = 2 then '2' when s.rnk = 3 then '3' else '' end as medal,
  case when s.rnk = 1 and s.streak >= 3 then concat(cast(s.streak as varchar), '-day streak') end as streak_text
from standings s join (select date, count(*) as players from results group by date) n on n.date = s.date"""
    o["text_bar"] = _with(RESULTS) + """select date, name, secs, relative,
  concat(repeat('━', relative), repeat('　', 8 - relative)) as bar
from (select r.date, r.name, r.secs,
             cast(floor(cast(7 as double) / cast(m.max_secs as double) * cast(r.secs as double)) as integer) as relative
      from results r join (select date, max(secs) as max_secs from results group by date) m on m.date = r.date) t"""
    o["report_text_week"] = _with(
        RESULTS,
        _ranked(),
        f"""c as (select {_trunc('week')} as period_start, name,
                 cast(sum(case when rnk = 1 then 1 end) as bigint) as firsts,
                 cast(sum(case when rnk = 2 then 1 end) as bigint) as silvers,
                 cast(sum(case when rnk = 3 then 1 end) as bigint) as thirds
          from ranked where rnk <= 3 group by all)""",
        f"""lines as (select period_start, 'wins' as section,
            cast(row_number() over (partition by period_start order by firsts desc nulls last, silvers desc nulls last,
                                    thirds desc nulls last, name) as bigint) as pos,
            cast(null as bigint) as o1, cast(null as varchar) as o2,
            concat(coalesce(name, 'NA'), ': ', repeat(':first_place_medal:', coalesce(firsts, 0)),
                   repeat(':second_place_medal:', coalesce(silvers, 0)), repeat(':third_place_medal:', coalesce(thirds, 0)), {NL}) as line
          from c)""",
    ) + ", " + _parts_sql(
        f"select distinct {_trunc('week')} as period_start from results",
        "(1, 1, 'wins', true)",
        f"concat('*', {_label('week', 'p.period_start')}, ' wins*', {NL})",
    )
    o["report_text_month"] = _report_sql("month")
    o["report_text_year"] = _report_sql("year")
    o["report_text_month_league"] = _league_report_sql("month")
    for p in ("week", "month", "year"):
        o[f"period_wins_{p}"] = _with(RESULTS, _ranked(), _wins_cte(p)) + (
            "select period_start, name, n, rnk, pos, case when rnk = 1 then ':crown:' else '' end as mark from wins"
        )
        o[f"fastest_three_{p}"] = _with(RESULTS, _fastest_cte(p)) + "select * from fast"
    for p in ("month", "year"):
        o[f"median_times_{p}"] = _with(RESULTS, _median_cte(p)) + "select * from med"
        o[f"longest_streak_{p}"] = _with(RESULTS, *_streaks_cte(), _longest_cte(p)) + "select * from longest"
    o["daily_message_as_of"] = f"select * from ({o['daily_message']}) t where date = date '{AS_OF.isoformat()}'"
    o["report_text_this_week"] = f"select * from ({o['report_text_week']}) t where period_start = date '2001-07-30'"
    o["report_text_last_month"] = f"select * from ({o['report_text_month']}) t where period_start = date '2001-07-01'"
    o["report_text_last_year"] = f"select * from ({o['report_text_year']}) t where period_start = date '2000-01-01'"
    o["period_wins_month_league"] = _with(LEAGUE_RESULTS, _ranked("league, date"), _wins_cte("month", "league")) + (
        "select league, period_start, name, n, rnk, pos, case when rnk = 1 then ':crown:' else '' end as mark from wins"
    )
    o["median_times_month_league"] = _with(LEAGUE_RESULTS, _median_cte("month", "league")) + "select * from med"
    recent = RESULTS.replace("from orders group by", f"from orders where {_DAY} > date '{AS_OF.isoformat()}' - 90 group by")
    o["report_text_last_month_lookback"] = (
        f"select * from ({o['report_text_month'].replace(RESULTS, recent)}) t where period_start = date '2001-07-01'"
    )
    board = BOARD_FLAT + f""",
results as (select name, date, secs, {_fmt('secs')} as time from board_flat where secs is not null)"""
    daily = o["daily_message"].replace(RESULTS, board)
    o["board_from_files"] = o["flatten_board"]
    o["stamped_rows"] = _with(BOARD_FLAT) + f"select name, {_fmt('secs')} as time, date from board_flat where secs is not null"
    o["sheet_from_csv"] = _with(SHEET) + "select * from sheet"
    o["appended_and_overwritten"] = _with(BOARD_FLAT) + f"""select name, {_fmt('s')} as time, s as secs, date
from (select name, date, secs - case when date >= date '{sr.REWRITTEN.isoformat()}' then 1 else 0 end as s from board_flat where secs is not null) t"""
    o["write_order"] = _with(BOARD_FLAT) + "select date, count(*) as rows, 0 as out_of_order from board_flat where secs is not null group by date"
    o["messages_written"] = f"""select 'daily' as kind, date as period_start, '{DAILY_TITLE}' as title, message, seq, section, page, text
from ({daily}) t"""
    # all events fall in January, six hours behind UTC in the zone
    o["days_in_zone"] = "select cast(ts - interval 6 hour as date) as date, count(*) as events from events group by 1"
    o["ingest_rejects"] = _with(BOARD_FLAT) + f"""select distinct case when secs % 11 <> 1 then name end as name, {_fmt('secs')} as time, secs,
  case when secs % 11 <> 0 then date end as date from board_flat where secs % 11 in (0, 1)"""
    user = "cast(substr(name, 8) as bigint)"
    reason = f"case when {user} % 13 = 0 then 'bad time' when {user} % 11 = 1 then 'nameless' else 'dateless' end"
    undated = f"date = date '{sr.REWRITTEN.isoformat()}'"
    o["rejects_classified"] = _with(BOARD_FLAT) + f"""select distinct case when {user} % 11 <> 1 then name end as name,
  case when {user} % 13 <> 0 then {_fmt('secs')} end as time, case when {user} % 13 <> 0 then secs end as secs,
  case when not {undated} then date end as date, {reason} as reason, case when {user} % 13 = 0 then concat(secs, 'x') end as detail
from board_flat where secs is not null and ({user} % 13 = 0 or {user} % 11 = 1 or {undated})
union all select null, null, null, null, 'unreadable', concat('{{"data": [{{"name": "', d) from (select distinct cast(date as varchar) as d from board_flat) t"""
    polled = f"date '{sr.POLLED.isoformat()}'"
    o["polls_by_ledger"] = _with(BOARD_FLAT) + f"""select cast(case when date <= {polled} then 1 else 2 end as integer) as poll, date, count(*) as rows
from board_flat where secs is not null and date <= {polled} + 1 group by all"""
    o["marker_after_crash"] = _with(BOARD_FLAT) + f"""select step, max(date) as latest_date
from board_flat, (values ('before', {polled}), ('table written', {polled}), ('commit cut short', {polled}), ('next run', null)) t(step, upto)
where secs is not null and (upto is null or date <= upto) group by step"""
    o["reconciled_orphans"] = _with(BOARD_FLAT) + f"""select name, {_fmt('(secs + 3)')} as time, secs + 3 as secs, date
from board_flat where secs % 7 = 0"""
    o["daily_message_incremental"] = f"select * from ({o['messages_written']}) t where period_start = date '{sr.POLLED.isoformat()}' + 1"
    o["report_month_from_streaks"] = f"""select 'month' as kind, period_start, 'January' as title, message, seq, section, page, text
from ({o['report_text_month'].replace(RESULTS, board)}) t"""
    o["report_month_from_counts"] = o["report_month_from_streaks"] + " where period_start = date '2024-01-01'"
    for name in ("rank_distribution", "weekday_medians"):
        o[f"{name}_from_counts"] = f"select * from ({o[name].replace(RESULTS, board)}) t where period_start = date '2024-01-01'"
    if corpus is not None:
        o.update(corpus.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o


def _name_order_cte(p: str) -> str:
    return f"""no as (
  select period_start, name, median_secs,
         cast(row_number() over (partition by period_start order by median_secs desc, name desc) as bigint) as name_order
  from (select {_trunc(p)} as period_start, name, median(secs) as median_secs from results group by all) n0
)"""


def _league_report_sql(p: str) -> str:
    """Monthly report per league (every CTE carries the league key)."""
    fast = f"""fast as (
  select * from (
    select league, {_trunc(p)} as period_start,
           cast(row_number() over (partition by league, {_trunc(p)} order by secs, date, name) as bigint) as pos,
           name, date, secs, time, concat(time, ' by ', coalesce(name, 'NA'), ' on ', strftime(date, '%a, %b %d'), {NL}) as line
    from results) f0 where pos <= 3
)"""
    longest = f"""longest as (
  select league, period_start, name, streak, date,
         concat(coalesce(name, 'NA'), ': ', cast(streak as varchar), ', ending on ', strftime(date, '%a, %b %d'), {NL}) as line,
         cast(row_number() over (partition by league, period_start order by date, name) as bigint) as pos
  from (select league, {_trunc(p)} as period_start, name, streak, date,
               rank() over (partition by league, {_trunc(p)} order by streak desc) as r from streaks) l0
  where r = 1 and streak >= 3
)"""
    lines = f"""lines as (
  select league, period_start, 'wins' as section, pos, cast(null as bigint) as o1, cast(null as varchar) as o2,
         concat(coalesce(name, 'NA'), ': ', cast(n as varchar), ' ', case when rnk = 1 then ':crown:' else '' end, {NL}) as line from wins
  union all select league, period_start, 'fastest', pos, null, null, line from fast
  union all select league, period_start, 'medians', pos, null, null, line from med
  union all select league, period_start, 'streak', pos, null, null, line from longest
)"""
    spec = (
        "(1, 1, 'wins', true), (2, 1, 'medians', true), (3, 1, 'fastest', true), (3, 2, 'streak', false)"
        if p == "year"
        else "(1, 1, 'wins', true), (1, 2, 'fastest', true), (1, 3, 'medians', true), (1, 4, 'streak', false)"
    )
    heads = (
        f"case s.section when 'wins' then concat('*', {_label(p, 'p.period_start')}, ' results*', {NL}, {NL}, '*Wins*', {NL})"
        f" when 'fastest' then concat('*Fastest times*', {NL}) when 'medians' then concat('*Median times*', {NL})"
        f" else concat('*Longest streak*', {NL}) end"
    )
    body = f"""pages as (
  select league, period_start, section, cast(floor((pos - 1) / 50) as bigint) as page,
         string_agg(line, '' order by pos, o1, o2) as body
  from lines group by all
),
periods as (select distinct league, {_trunc(p)} as period_start from results),
spec as (select * from (values {spec}) v(message, seq, section, always)),
heads as (select p.league, p.period_start, s.message, s.seq, s.section, s.always, {heads} as header
          from periods p cross join spec s)
select h.league, h.period_start, h.message, h.seq, h.section, coalesce(pg.page, 0) as page,
       concat(case when coalesce(pg.page, 0) = 0 and h.seq > 1 then {NL} else '' end,
              case when coalesce(pg.page, 0) = 0 and (pg.body is not null or h.always) then h.header else '' end,
              coalesce(pg.body, '')) as text
from heads h left join pages pg
  on pg.league is not distinct from h.league and pg.period_start = h.period_start and pg.section = h.section"""
    return _with(
        LEAGUE_RESULTS, *_streaks_cte("league"), _wins_cte(p, "league"), fast, _median_cte(p, "league"), longest, lines
    ) + ", " + body
