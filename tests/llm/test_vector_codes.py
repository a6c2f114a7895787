import hashlib
import math
import random

import numpy as np
import pytest

from podium.llm import vector_codes as vc

INF, NAN = math.inf, math.nan


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """The query's rows in plain Python integers, every entry tried for every part."""
    ok = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in ok if len(v) == len(ok[0][1])]
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    book = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, v, _ in kept:
                mine.setdefault(nearest(cut(v, p), p)[1], []).append(cut(v, p))
            book[p] = [[sum(c) // len(mine[i]) for c in zip(*mine[i])] if i in mine else e for i, e in enumerate(book[p])]
    digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, label in kept:
        found = [nearest(cut(v, p), p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    return [(i, code, error, by_label[label], digest) for i, code, error, label in out]


def query(spark, rows, tmp_path):
    data = [(*r, "x", 1, 2, 3) for r in rows]
    schema = "vec_id long, embedding array<float>, label int, code string, error int, _key int, _salt int"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    return [tuple(r) for r in vc.op11_vector_codes(spark, str(tmp_path)).collect()]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def vector(rng, n=64, step=64):
    return [rng.randrange(-step, step) / 64 for _ in range(n)]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, vector(rng), rng.choice([None, 1, 1, 1, 2])) for i in range(150)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(60)]  # copies of one vector
    rows += [(7, rows[9][1], 2), (7, rows[9][1], 2), (None, vector(rng), None)]  # repeated and null ids
    rows += [(-1, None, 1), (-2, [], 1), (-3, [None] * 64, 1), (-4, [NAN] * 64, 1), (-5, [INF] + [0.0] * 63, 1), (-6, [0.0] * 63 + [-INF], 2)]
    rows += [(2000, [0.5] * 16, 1), (2001, [0.5] * 63, 1)]  # of another length, and no multiple of the parts
    want = brute(rows)
    assert len(want) == 213
    assert sorted(query(spark, rows, tmp_path), key=key) == sorted(want, key=key)


def test_fewer_vectors_than_entries(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, vector(rng, 32), i % 2) for i in range(5)] + [(9, vector(rng, 32), 0)]
    assert sorted(query(spark, rows, tmp_path)) == sorted(brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [NAN] * 64, None), (3, [], 2)]])
def test_no_vectors(spark, tmp_path, rows):
    assert query(spark, rows, tmp_path) == []


@pytest.mark.parametrize("size, spread", [(1, 3), (2, 40), (4, 200), (4, 60_000_000), (7, 30)])
def test_cells_leave_the_nearest(monkeypatch, size, spread):
    monkeypatch.setattr(vc, "CELLS", 50)  # the table begins anew many times
    rng = np.random.default_rng(size)
    entry = rng.integers(-spread, spread, (40, size))
    entry[7] = entry[3]  # a tie
    cells = vc.Cells(entry)
    for _ in range(5):
        x = np.vstack((rng.integers(-2 * spread, 2 * spread, (300, size)), entry))
        index, best = cells.nearest(x)
        d = ((x[:, None] - entry[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (index == d.argmin(axis=1)).all()


def test_cells_spare_evaluations():
    rng = np.random.default_rng(4)
    entry = rng.normal(0, 32, (64, 4)).astype(np.int64)
    cells = vc.Cells(entry)
    for _ in range(10):
        cells.nearest(rng.normal(0, 32, (2000, 4)).astype(np.int64))
    assert cells.evaluated < 0.5 * 64 * 20_000


def test_too_large_components_are_an_error():
    with pytest.raises(ValueError, match="beyond"):
        vc.whole(np.array([[1e30]]), 256)


def test_decode_gives_the_entries_back(spark):
    rng = random.Random(5)
    rows = [(i, vector(rng, 8), "a") for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    books = vc.fit(df, parts=2, entries=16)
    got = vc.decode(vc.encode(df, books), books).collect()
    for r in got:
        x = np.floor(np.array(rows[r.vec_id][1]) * 256)
        assert int(((x - np.array(r.decoded) * 256) ** 2).sum()) == r.error
