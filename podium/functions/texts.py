"""Report wording and formats, and a helper to fill them from columns.

Everything a reader of the messages sees is here, so the wording can be
checked (or localised) in one place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.util import as_col

# The reports' wording and formats (they must read as the reference's messages do).
MEDALS = {1: ":first_place_medal:", 2: ":second_place_medal:", 3: ":third_place_medal:"}
PLOT_MEDALS = {1: "1", 2: "2", 3: "3"}
CROWN = ":crown:"
DAILY_TITLE = "Leaderboard"
DAILY_HEADER = "*{day}*\n"
DAILY_LINE = "{name}: {time} {medal} {streak_note}{broken_note}\n"
STREAK_NOTE = "({n}-day streak)"
BROKEN_NOTE = "({n}-day streak broken)"
PLOT_STREAK_NOTE = "{n}-day streak"
WEEK_LABEL = "Week {n}"
WEEK_HEADER = "*{label} wins*\n"
MEDAL_LINE = "{name}: {placements}\n"
RESULTS_HEADER = "*{label} results*\n\n*Wins*\n"
WINS_LINE = "{name}: {n} {mark}\n"
FASTEST_HEADER = "*Fastest times*\n"
FASTEST_LINE = "{time} by {name} on {day}\n"
MEDIANS_HEADER = "*Median times*\n"
MEDIAN_LINE = "{name}: {time}\n"
STREAK_HEADER = "*Longest streak*\n"
STREAK_LINE = "{name}: {streak}, ending on {day}\n"
TIME_FORMAT = "%d:%02d"
TIME_FORMAT_UNPADDED = "%d:%d"
DATE_SHORT = "EEE, MMM dd"
DATE_LONG = "EEEE, MMMM dd"
MONTH_NAME = "MMMM"
SATURDAY = "Saturday"
NON_SATURDAY = "Non-Saturday"
BAR_CELL = "━"
BAR_BLANK = "　"
BAR_SCALE = 7
BAR_WIDTH = 8
STREAK_SHOWN_FROM = 3
MISSING = "NA"
SECTION_SEPARATOR = "\n"
# weekday labels for dayofweek 1..7 (1 = Sunday … 7 = Saturday), and their display order, Monday first
WEEKDAY_LABELS = ["Su", "M", "Tu", "W", "Th", "F", "Sa"]
WEEKDAY_DISPLAY_ORDER = ["M", "Tu", "W", "Th", "F", "Sa", "Su"]

_FIELD = re.compile(r"\{(\w+)\}")


def fill(template: str, **values) -> Column:
    """``concat`` of the template's literal pieces and the given columns (``{name}`` placeholders).

    Values may be column names, columns or Python literals; a null value is rendered ``NA``.
    """
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        v = values[m.group(1)]
        value = as_col(v) if isinstance(v, (str, Column)) else F.lit(v)
        parts.append(F.coalesce(value.cast("string"), F.lit(MISSING)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*[p.cast("string") for p in parts])
