import math
from collections import defaultdict

import pytest

from podium.llm import mixing
from podium.llm.common import WORD
import re

ROWS = (
    [(i, "w " * (i % 17 + 1), "hot") for i in range(200)]
    + [(1000 + i, "a b c " * (i % 5), "b") for i in range(40)]
    + [(2000, None, None), (2001, "one two", None), (2002, "", "empty"), (2003, "x y z", "é"), (None, "p q", "b"), (7, "dup dup", "b"), (7, "dup dup", "b")]
)


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        level = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level >= cap * sizes[s]]
        if not over:
            return fixed | {s: w[s] * level for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def mixed(spark, rows, schema="doc_id long, text string, source string"):
    df = spark.createDataFrame(rows, schema)
    return mixing.mix(mixing.sized(df)).select("row.*", "size", "source_size", "target", "copies", "taken").collect()


def test_targets_and_copies(spark):
    got = mixed(spark, ROWS)
    assert len(got) == len(ROWS)
    sizes = defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len(re.findall(WORD, text or ""))
    want = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(re.findall(WORD, r.text or "")) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        if r.source_size:
            rate = r.target / r.source_size
            assert math.floor(rate) <= r.copies <= math.ceil(rate)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_reruns_and_partitioning_agree(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    key = lambda rows: sorted((r.id is None, r.id or 0, r.taken) for r in rows)
    one = mixing.mix(mixing.sized(df.repartition(3))).selectExpr("row.doc_id as id", "taken").collect()
    two = mixing.mix(mixing.sized(df.repartition(7))).selectExpr("row.doc_id as id", "taken").collect()
    assert key(one) == key(two)


def test_clashing_columns_and_emission(spark):
    rows = [(i, "a b", "s", "keep", 9) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, copies int")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == 15 and all(r["size"] == "keep" and r["copies"] == 9 for r in got)


def test_empty(spark):
    assert mixed(spark, []) == []
    assert mixed(spark, [(1, None, "a")])[0].taken == 0
