"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    # optional operators bring tests of their own for what SQL cannot express
    optional = set(entry.corpus.QUERIES) | {"pipeline"} if entry.corpus else set()
    assert set(entry.queries()) - optional == set(entry.oracle_sql()) - optional


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["period_start", "message", "seq", "section", "page", "text"]


def test_ingest_equals_fastest_of_all_orders(spark, con):
    """Every order is in the sheet or the incoming rows, so ingest gives each player's fastest order of the day."""
    from podium.operators import ingest as ing
    from podium.sources import fixtures as fx

    got = ing.ingest(fx.sheet(spark, SF), fx.incoming(spark, SF))
    secs = "cast(20 + floor(o_totalprice / 1000) as integer)"
    want = con.execute(f"""select name, date, min(secs) as secs from (
      select concat('player_', o_custkey) as name, cast(o_orderdate as date) as date, {secs} as secs
      from orders where o_orderkey % 503 <> 0 and o_orderkey % 509 <> 0
      union all
      select concat('player_', o_custkey), cast(o_orderdate as date), {secs} - case when o_orderpriority = '1-URGENT' then 7 else 0 end
      from orders where o_orderpriority in ('1-URGENT', '2-HIGH')) t group by 1, 2""").fetchall()
    assert Counter((r.name, r.date, r.secs) for r in got.collect()) == Counter(want)
