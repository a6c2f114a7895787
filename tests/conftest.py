import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from podium.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, app="podium-tests")
    yield s
    s.stop()


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def results_df(spark, rows, league=False):
    """rows: (name, 'YYYY-MM-DD', secs) or (league, name, date, secs)."""
    from podium.functions.timefmt import format_secs

    if league:
        df = spark.createDataFrame([(lg, n, d(x), s) for lg, n, x, s in rows], "league string, name string, date date, secs int")
    else:
        df = spark.createDataFrame([(n, d(x), s) for n, x, s in rows], "name string, date date, secs int")
    return df.withColumn("time", format_secs("secs"))


class _Msg:
    def __init__(self, **kw):
        self.__dict__.update(kw)


def message_text(parts, by=None, period_key="period_start"):
    """Whole message text per message, joined from its parts in (seq, page) order (small test outputs only)."""
    groups = {}
    for r in parts.collect():
        key = tuple(getattr(r, k) for k in [*(by or []), period_key, "message"])
        groups.setdefault(key, []).append((r.seq, r.page, r.text))
    out = []
    for key, items in groups.items():
        names = [*(by or []), period_key, "message"]
        out.append(_Msg(**dict(zip(names, key)), text="".join(t for _, _, t in sorted(items))))
    return out
