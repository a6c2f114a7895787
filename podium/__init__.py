"""podium: leaderboard analytics on Spark DataFrames.

Facts are (league…, name, date, secs) rows: who finished which daily puzzle and
in what time.  Every public operator is ``DataFrame -> DataFrame`` and takes
``by`` (extra partition keys such as ``["league"]``) so that one call answers
every league, and every day / week / month / year, at once.
"""

from podium.operators.ingest import canonical, dedupe_keep_first, flatten_board, ingest, new_rows, orphan_rows
from podium.operators.medians import median_times, name_order, time_points, weekday_medians
from podium.operators.ranking import day_rank, fastest, medal_table, period_wins, rank_distribution, top_ranks
from podium.operators.streaks import broken_streaks, longest_streak, streaks
from podium.plans.jobs import run_daily, run_ingest, run_period
from podium.plans.reports import daily_message, daily_standings, period_message, weekly_message
from podium.session import checkpoint_dir, get_session

__all__ = [
    "broken_streaks",
    "canonical",
    "checkpoint_dir",
    "daily_message",
    "daily_standings",
    "day_rank",
    "dedupe_keep_first",
    "fastest",
    "flatten_board",
    "get_session",
    "ingest",
    "longest_streak",
    "medal_table",
    "median_times",
    "name_order",
    "new_rows",
    "orphan_rows",
    "period_message",
    "period_wins",
    "rank_distribution",
    "run_daily",
    "run_ingest",
    "run_period",
    "streaks",
    "time_points",
    "top_ranks",
    "weekday_medians",
    "weekly_message",
]
