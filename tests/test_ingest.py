import datetime as dt


from podium.operators import ingest as ing
from podium.schemas import LEADERBOARD, RESULTS_RAW

D = dt.date(2024, 1, 11)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RESULTS_RAW)


def test_flatten_drops_unsolved(spark):
    docs = spark.createDataFrame(
        [
            (
                D,
                [
                    (1, "a", "1", False, (45,)),
                    (2, "b", None, True, None),
                    (3, None, "2", False, (50,)),
                    (4, "c", "3", False, (None,)),
                ],
            )
        ],
        LEADERBOARD,
    )
    got = [tuple(r) for r in ing.flatten_board(docs).collect()]
    assert got == [(D, "a", 45)]


def test_positional_pairing(spark):
    df = spark.createDataFrame([(D, ["a", "b", "c"], [10, 20])], "date date, names array<string>, times array<bigint>")
    got = [tuple(r) for r in ing.pair_positional(df, "names", "times").collect()]
    assert got == [(D, "a", 10), (D, "b", 20)]


def test_dedupe_keeps_earliest_and_nulls_group(spark):
    t1, t2 = dt.datetime(2024, 1, 11, 8), dt.datetime(2024, 1, 11, 9)
    raw = _raw(spark, [(t2, "a", "1:05", D), (t1, "a", "1:05", D), (None, "a", "1:05", D), (t1, None, "0:50", D), (t2, None, "0:50", D)])
    got = {(r.name, r.time): r.submitted_at for r in ing.dedupe_keep_first(raw).collect()}
    assert got == {("a", "1:05"): t1, (None, "0:50"): t1}


def test_new_rows_null_safe_and_by_seconds(spark):
    stored = _raw(spark, [(None, None, "0:45", D), (None, "a", "1:5", D)])
    incoming = spark.createDataFrame([(None, "0:45", D), ("a", "1:05", D), ("b", "2:00", D)], "name string, time string, date date")
    new = [tuple(r) for r in ing.new_rows(incoming, stored).collect()]
    assert new == [("b", "2:00", D)]  # null names match; 1:5 == 1:05


def test_orphans_only_on_loaded_days(spark):
    other = dt.date(2024, 1, 10)
    stored = _raw(spark, [(None, "a", "1:00", D), (None, "z", "3:00", D), (None, "y", "4:00", other)])
    incoming = spark.createDataFrame([("a", "1:00", D)], "name string, time string, date date")
    got = [r.name for r in ing.orphan_rows(stored, incoming).collect()]
    assert got == ["z"]


def test_ingest_idempotent_and_canonical(spark):
    raw = _raw(spark, [(dt.datetime(2024, 1, 11, 8), "a", ":45", D), (None, "b", "1:10", D), (None, "b", "x:1", D)])
    incoming = spark.createDataFrame([("a", "0:45", D), ("b", "1:05", D), ("c", "2:00", D)], "name string, time string, date date")
    once = ing.ingest(raw, incoming)
    got = sorted(tuple(r) for r in once.collect())
    # b keeps the fastest of 1:10 and the corrected 1:05; unparseable x:1 is not a result
    assert got == [("a", D, 45, "0:45"), ("b", D, 65, "1:05"), ("c", D, 120, "2:00")]
    stored_after = ing.append_rows(ing.clean_stored(raw), ing.new_rows(incoming, ing.clean_stored(raw)))
    twice = ing.canonical(ing.append_rows(stored_after, ing.new_rows(incoming, stored_after)))
    assert sorted(tuple(r) for r in twice.collect()) == got
    assert ing.new_rows(incoming, stored_after).count() == 0
    assert [r.time for r in ing.rejects(ing.clean_stored(raw)).collect()] == ["x:1"]


def test_append_to_table_is_idempotent(spark, tmp_path):
    from podium.sources.sinks import append_results

    path = str(tmp_path / "results")
    rows = spark.createDataFrame([("a", "0:45", 45, D), ("b", "1:05", 65, D)], "name string, time string, secs int, date date")
    for _ in range(2):
        try:
            stored = spark.read.parquet(path)
        except Exception:
            stored = rows.limit(0)
        append_results(ing.new_rows(rows, stored), path)
    assert spark.read.parquet(path).count() == 2


def test_progress_marker(spark):
    from tests.conftest import results_df

    r = results_df(spark, [("x", "a", "2024-01-01", 5), ("x", "b", "2024-01-03", 6), ("y", "a", "2024-01-02", 7)], league=True)
    got = {r.league: r.latest_date for r in ing.progress_marker(r, ["league"]).collect()}
    assert got == {"x": dt.date(2024, 1, 3), "y": dt.date(2024, 1, 2)}


def test_read_sheet_csv_declared_types(spark, tmp_path):
    from podium.sources.tables import read_results_raw

    p = tmp_path / "sheet.csv"
    p.write_text("submitted_at,name,time,date\n2024-01-11 08:00:00,a,:45,2024-01-11\n,b,1:05,2024-01-11\n")
    df = read_results_raw(spark, str(p), fmt="csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["timestamp_ntz", "string", "string", "date"]
    got = ing.canonical(ing.clean_stored(df)).collect()
    assert sorted((r.name, r.secs, r.time) for r in got) == [("a", 45, "0:45"), ("b", 65, "1:05")]


def test_format_incoming_padded_and_not(spark):
    flat = spark.createDataFrame([(D, "a", 65), (D, "b", 600)], "date date, name string, secs int")
    padded = sorted(tuple(r) for r in ing.format_incoming(flat).collect())
    unpadded = sorted(tuple(r) for r in ing.format_incoming(flat, padded=False).collect())
    assert padded == [("a", "1:05", D), ("b", "10:00", D)]
    assert unpadded == [("a", "1:5", D), ("b", "10:0", D)]
