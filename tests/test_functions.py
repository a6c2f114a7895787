import datetime as dt

from pyspark.sql import functions as F

from podium.functions import calendar as cal
from podium.functions.timefmt import format_secs, format_secs_unpadded, minutes, parse_time, repair_time


def test_parse_time_cases(spark):
    cases = {
        "0:45": 45,
        "1:5": 65,
        "1:05": 65,
        "0:00": 0,
        "75:10": 4510,
        "1:75": 135,
        ":45": None,  # only after repair
        "x:05": None,
        "105": None,
        "": None,
        None: None,
        "99999999999:00": None,  # overflow -> null, never an error
        " 1:05 ": 65,  # surrounding spaces from a sheet export
        "1:05:00": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.s for r in df.select("t", parse_time("t").alias("s")).collect()}
    assert got == cases


def test_repair_time(spark):
    df = spark.createDataFrame([(":45",), ("1:05",), (None,), (":",)], "t string")
    got = [r.x for r in df.select(repair_time("t").alias("x")).collect()]
    assert got == ["0:45", "1:05", None, "0:"]


def test_format_secs(spark):
    df = spark.createDataFrame([(45,), (65,), (4510,), (0,), (None,)], "s int")
    rows = df.select(format_secs("s").alias("p"), format_secs_unpadded("s").alias("u"), minutes("s").alias("m")).collect()
    assert [r.p for r in rows] == ["0:45", "1:05", "75:10", "0:00", None]
    assert [r.u for r in rows] == ["0:45", "1:5", "75:10", "0:0", None]
    assert rows[1].m == 65 / 60.0


def test_calendar_labels(spark):
    days = ["2024-12-30", "2021-01-03", "2001-08-04", "2001-08-05", "2001-08-06"]
    df = spark.createDataFrame([(dt.date.fromisoformat(x),) for x in days], "d date")
    rows = df.select(
        F.weekofyear("d").alias("w"),
        cal.period_col("d", "week").alias("wk"),
        cal.weekday_label("d").alias("lab"),
        cal.weekday_order("d").alias("ord"),
        cal.saturday_check("d").alias("sat"),
        cal.date_text_short("d").alias("short"),
        cal.date_text_long("d").alias("long"),
    ).collect()
    assert [r.w for r in rows] == [1, 53, 31, 31, 32]
    assert rows[0].wk == dt.date(2024, 12, 30)
    assert [r.lab for r in rows[2:]] == ["Sa", "Su", "M"]
    assert [r.ord for r in rows[2:]] == [6, 7, 1]
    assert [r.sat for r in rows[2:]] == ["Saturday", "Non-Saturday", "Non-Saturday"]
    assert rows[2].short == "Sat, Aug 04"
    assert rows[2].long == "Saturday, August 04"


def test_period_range_wraps():
    assert cal.period_range(dt.date(2001, 1, 15), "month", -1) == (dt.date(2000, 12, 1), dt.date(2001, 1, 1))
    assert cal.period_range(dt.date(2001, 8, 1), "year", -1) == (dt.date(2000, 1, 1), dt.date(2001, 1, 1))
    assert cal.period_range(dt.date(2001, 8, 1), "week") == (dt.date(2001, 7, 30), dt.date(2001, 8, 6))
    assert cal.period_range(dt.date(2001, 8, 1), "day", -1) == (dt.date(2001, 7, 31), dt.date(2001, 8, 1))


def test_in_period_and_offsets(spark):
    df = spark.createDataFrame([(dt.date(2001, 6, 30),), (dt.date(2001, 7, 1),), (dt.date(2001, 7, 31),), (dt.date(2001, 8, 1),)], "d date")
    got = [r.d.isoformat() for r in df.where(cal.in_period("d", dt.date(2001, 8, 1), "month", -1)).collect()]
    assert got == ["2001-07-01", "2001-07-31"]
    assert cal.period_range(dt.date(2001, 8, 1), "week", -1) == (dt.date(2001, 7, 23), dt.date(2001, 7, 30))
