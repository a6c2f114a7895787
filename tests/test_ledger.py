import datetime as dt
import json
import os

import pytest

from podium.plans import jobs
from podium.session import checkpoint_dir
from podium.sources.tables import read_board_files
from podium.streaming.board_stream import start_board_stream
from tests.test_jobs import _land

DAY = dt.date(2024, 1, 5)


def _folder(tmp_path, days=5):
    boards = tmp_path / "boards"
    for d in range(1, days + 1):
        _land(boards, f"2024-01-0{d}", [("a", 30 + d), ("b", 45), ("c", None)])
    return boards


def _stored(spark, table, by=None):
    return sorted((tuple(r) for r in jobs.read_stored(spark, table, by).collect()), key=str)


def test_second_poll_reads_what_is_new(spark, tmp_path, monkeypatch):
    boards, table = _folder(tmp_path, 4), str(tmp_path / "table")
    (first,) = jobs.run_ingest(spark, str(boards), table)
    assert first.state["files"] == 4 and first.state["days"] == [f"2024-01-0{d}" for d in range(1, 5)]
    assert jobs.run_ingest(spark, str(boards), table) == []
    _land(boards, "2024-01-05", [("a", 20)])
    files = [f.path for f in jobs.new_files(spark, str(boards), table).collect()]
    assert [f.rsplit("/", 1)[1] for f in files] == ["2024-01-05.json"]
    assert len(read_board_files(spark, str(boards), files).inputFiles()) == 1  # one file is opened
    looked_at = []
    monkeypatch.setattr(jobs.ing, "new_rows", lambda good, stored, by: looked_at.append(stored) or _new_rows(good, stored, by))
    (second,) = jobs.run_ingest(spark, str(boards), table)
    assert second.state["days"] == ["2024-01-05"] and second.state["files"] == 1
    plan = looked_at[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan and "2024-01-04" not in plan  # one partition
    assert len(_stored(spark, table)) == 9


_new_rows = jobs.ing.new_rows


def test_changed_file_is_taken_in_again(spark, tmp_path):
    boards, table = _folder(tmp_path), str(tmp_path / "table")
    jobs.run_ingest(spark, str(boards), table)
    _land(boards, "2024-01-02", [("a", 9), ("b", 45), ("d", 71)])
    (again,) = jobs.run_ingest(spark, str(boards), table)
    assert again.state["days"] == ["2024-01-02"]
    assert {(r.name, r.secs) for r in jobs.read_canonical(spark, table).collect() if r.date.day == 2} == {("a", 9), ("b", 45), ("d", 71)}


def test_one_load_date(spark, tmp_path):
    boards, table = _folder(tmp_path), str(tmp_path / "table")
    (boards / "2024-01-04.json").write_text("not opened")
    jobs.main(["ingest", "--table", table, "--boards", str(boards), "--load-date", "2024-01-05"])
    assert {r.date for r in jobs.read_stored(spark, table).collect()} == {DAY}
    assert jobs.read_rejects(spark, table).count() == 0
    jobs.main(["ingest", "--table", table, "--boards", str(boards), "--since", "2024-01-03"])
    assert {r.date.day for r in jobs.read_stored(spark, table).collect()} == {3, 5}
    assert [r.reason for r in jobs.read_rejects(spark, table).collect()] == ["unreadable"]


@pytest.mark.parametrize("step", ["append_results", "_taken_in"])
def test_a_run_that_died_is_taken_up(spark, tmp_path, monkeypatch, step):
    boards, table = _folder(tmp_path), str(tmp_path / "table")
    with monkeypatch.context() as m:
        whole = getattr(jobs, step)
        m.setattr(jobs, step, lambda *a, **k: (step == "append_results" and whole(*a, **k), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            jobs.run_ingest(spark, str(boards), table)
    (made,) = jobs.run_ingest(spark, str(boards), table)
    assert made.state["files"] == 5
    once = str(tmp_path / "once")
    jobs.run_ingest(spark, str(boards), once)
    assert _stored(spark, table) == _stored(spark, once)
    assert jobs.run_ingest(spark, str(boards), table) == []


def test_many_polls_and_small_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "LEDGER_FOLDERS", 2)
    monkeypatch.setattr(jobs, "FILES_PER_BATCH", 2)
    boards, table = tmp_path / "boards", str(tmp_path / "table")
    for d in range(1, 6):
        _land(boards / f"league=e[{d % 2}]*", f"2024-01-0{d}", [("a", d)])  # names, not patterns
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    assert [c.state["files"] for c in jobs.run_ingest(spark, str(boards), table, ["league"])] == [2, 2, 1]
    # a small batch leaves nothing behind in the shared folder
    left = {n for n in set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before if n.split("-")[0] in ("incoming", "rejects", "fresh")}
    assert left == set()
    assert jobs.read_ledger(spark, table).count() == 5 and len(jobs.versions.latest(spark, table + "/_files").state["folders"]) <= 2
    assert [(r.league, r.secs) for r in jobs.read_stored(spark, table, ["league"]).orderBy("date").collect()] == [
        (f"e[{d % 2}]*", d) for d in range(1, 6)
    ]


FAULTY = {
    "data": [
        {"name": "a", "score": {"secondsSpentSolving": 31}},
        {"name": None, "score": {"secondsSpentSolving": 32}},
        {"name": "c", "score": {"secondsSpentSolving": "soon"}},
        {"name": "d", "score": {"secondsSpentSolving": 30.5}},
        {"name": "e", "score": {"secondsSpentSolving": 33.0}},
        {"name": "f", "score": {}},
        {"name": "g"},
        {"score": {}},
        None,
    ]
}


def _faulty(tmp_path):
    boards = tmp_path / "boards"
    boards.mkdir()
    (boards / "2024-01-05.json").write_text(json.dumps(FAULTY) + '\n{"data": [{"name": "z", "sco')
    (boards / "undated.json").write_text('{"data": [{"name": "y", "score": {"secondsSpentSolving": 40}}]}')
    (boards / "odd-date.json").write_text('{"date": "yesterday", "data": [{"name": "w", "score": {"secondsSpentSolving": 41}}]}')
    return boards


WANT = {
    ("unreadable", None, None, '{"data": [{"name": "z", "sco'),
    ("nameless", None, 32, None),
    ("bad time", "c", None, "soon"),
    ("bad time", "d", None, "30.5"),
    ("dateless", "y", 40, None),
    ("dateless", "w", 41, None),
}


def test_each_fault_is_a_reject_once(spark, tmp_path):
    boards, table = _faulty(tmp_path), str(tmp_path / "table")
    for n in range(3):
        for f in boards.iterdir():
            os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))  # every poll takes every file in again
        jobs.run_ingest(spark, str(boards), table)
    got = [(r.reason, r.name, r.secs, r.detail) for r in jobs.read_rejects(spark, table).collect()]
    assert len(got) == len(WANT) and set(got) == WANT
    assert [(r.name, r.secs) for r in jobs.read_stored(spark, table).orderBy("name").collect()] == [("a", 31), ("e", 33)]


def test_the_stream_keeps_the_same_rejects(spark, tmp_path):
    boards, table = _faulty(tmp_path), str(tmp_path / "table")
    start_board_stream(spark, str(boards), table, str(tmp_path / "ckpt")).awaitTermination()
    assert {(r.reason, r.name, r.secs, r.detail) for r in jobs.read_rejects(spark, table).collect()} == WANT
    assert [(r.name, r.secs) for r in jobs.read_stored(spark, table).orderBy("name").collect()] == [("a", 31), ("e", 33)]
