import datetime as dt
import os

import pytest

from podium import versions
from podium.plans import jobs
from tests.conftest import results_df


def _numbers(path):
    return sorted(int(n[:20]) for n in os.listdir(f"{path}/_log") if n.endswith(".json"))


def test_commits_build_on_the_latest(spark, tmp_path):
    path = str(tmp_path / "state")
    assert versions.latest(spark, path) is None
    one = versions.commit(spark, path, {"a": 1}, None)
    two = versions.commit(spark, path, {"a": 2, "é": [1]}, one)
    assert versions.latest(spark, path) == two and two.state == {"a": 2, "é": [1]}
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, {"a": 3}, one)  # someone else committed since
    with pytest.raises(versions.Conflict):
        versions._create(spark, versions._file(path, two.number), b"x")
    assert versions.latest(spark, path) == two


def test_update_tries_again_on_top_of_another_writer(spark, tmp_path):
    path, seen = str(tmp_path / "state"), []

    def change(now):
        seen.append(now and now.state["n"])
        if len(seen) == 1:  # another writer is faster
            versions.commit(spark, path, {"n": 10}, now)
        return {"n": (now.state["n"] if now else 0) + 1}

    assert versions.update(spark, path, change).state == {"n": 11} and seen == [None, 10]


@pytest.mark.parametrize("cut", [0, 1, 10, -2])
def test_a_commit_cut_short_is_passed_over(spark, tmp_path, cut):
    path = str(tmp_path / "state")
    one = versions.commit(spark, path, {"a": 1}, None)
    versions._create(spark, versions._file(path, 2), versions._signed({"a": 2})[:cut])
    assert versions.latest(spark, path) == one
    three = versions.commit(spark, path, {"a": 3}, one)
    assert three.number == 3 and versions.latest(spark, path).state == {"a": 3}


def test_expire_keeps_what_may_be_in_use(spark, tmp_path):
    path, now = str(tmp_path / "state"), None
    for i in range(4):
        os.makedirs(f"{path}/v-{i}")
        now = versions.commit(spark, path, {"table": f"v-{i}"}, now)
    os.makedirs(f"{path}/v-stray")
    refers = lambda state: [state["table"]] if state else []
    versions.expire(spark, path, refers)  # all young
    assert len(_numbers(path)) == 4 and os.path.isdir(f"{path}/v-stray")
    versions.expire(spark, path, refers, keep_seconds=0)
    assert _numbers(path) == [4] and sorted(n for n in os.listdir(path) if n.startswith("v-")) == ["v-3"]
    assert versions.latest(spark, path).state == {"table": "v-3"}


class _Died(Exception):
    pass


def _dies(monkeypatch, module, name, when):
    """The named step runs not at all, or wholly, and then the writer is gone."""
    step = getattr(module, name)

    def run(*args, **kw):
        if when == "after":
            step(*args, **kw)
        if when == "amid":  # half a commit file
            step(*args[:2], args[2][: len(args[2]) // 2])
        raise _Died

    monkeypatch.setattr(module, name, run)


STEPS = [(jobs, "write_marker", "before"), (jobs, "write_marker", "after"), (versions, "_create", "before"), (versions, "_create", "amid"),
         (versions, "_create", "after"), (versions, "expire", "before"), (versions, "delete_path", "before"), (versions, "delete_path", "after")]


@pytest.mark.parametrize("module, name, when", STEPS)
def test_a_valid_marker_after_a_writer_died_at_any_step(spark, tmp_path, monkeypatch, module, name, when):
    path, league = str(tmp_path / "marker"), ["league"]
    day = lambda n: results_df(spark, [("east", "a", f"2024-01-0{n}", 30)], league=True)
    jobs.update_marker(spark, results_df(spark, [("east", "a", "2024-01-01", 30), ("west", "b", "2024-01-01", 9)], league=True), path, league)
    jobs.update_marker(spark, day(2), path, league)
    with monkeypatch.context() as m:
        if name == "delete_path":  # superseded versions are deleted at once, and the writer dies at the first
            m.setattr(versions.expire, "__defaults__", ("v", 0))
        _dies(m, module, name, when)
        with pytest.raises(_Died):
            jobs.update_marker(spark, day(3), path, league)
    got = {r.league: r.latest_date.day for r in jobs.read_marker(spark, path, league).collect()}
    committed = (name, when) == ("_create", "after") or name in ("expire", "delete_path")
    assert got == {"east": 3 if committed else 2, "west": 1}
    jobs.update_marker(spark, day(4), path, league)
    assert {r.league: r.latest_date.day for r in jobs.read_marker(spark, path, league).collect()} == {"east": 4, "west": 1}


def test_streaks_are_readable_after_a_writer_died(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "streaks")
    r = results_df(spark, [("a", f"2024-01-0{d}", 10) for d in range(1, 6)])
    jobs.update_streaks(spark, r, path, dt.date(2024, 1, 2))
    for when in ("before", "amid"):
        with monkeypatch.context() as m:
            _dies(m, versions, "_create", when)
            with pytest.raises(_Died):
                jobs.update_streaks(spark, r, path, dt.date(2024, 1, 4))
        assert {x.date.day: x.streak for x in jobs.read_streaks(spark, path).collect()} == {1: 1, 2: 2}
    jobs.update_streaks(spark, r, path, dt.date(2024, 1, 5))
    assert {x.date.day: x.streak for x in jobs.read_streaks(spark, path).collect()} == {d: d for d in range(1, 6)}
