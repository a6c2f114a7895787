import random
import re

import pytest

from podium.llm import jaccard_join as jj
from podium.llm.common import WORD


def sets(text, k):
    w = re.findall(WORD, "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, num, den):
    s = [sets(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and den * len(s[i] & s[j]) >= num * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(s[i]), least[find(i)] if s[i] else doc) for i, (doc, _) in enumerate(rows))


def near_copies(seed):
    """Groups of near copies of every closeness, sharing common passages, one large group, exact copies, short and empty texts."""
    random.seed(seed)
    vocab = [f"w{i}" for i in range(400)]
    passages = [[random.choice(vocab) for _ in range(30)] for _ in range(3)]
    rows = []
    for g in range(25):
        base = [random.choice(vocab) for _ in range(random.choice([6, 12, 40, 80, 200]))]
        if g % 3 == 0:
            base = base + random.choice(passages)
        for _ in range(random.choice([1, 2, 4, 8]) if g else 90):
            t = list(base)
            for _ in range(random.randrange(0, max(2, len(t) // 12))):
                t[random.randrange(len(t))] = random.choice(vocab)
            if random.random() < 0.2:
                t = random.choice(passages) + t
            rows.append(" ".join(t))
    rows += [" ".join(p) for p in passages for _ in range(3)] + rows[:5] + ["", None, " ", "one", "One", "one two three", "a b c d", "a b c d", "x " * 50]
    random.shuffle(rows)
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "k", "num"), [(1, 4, 85), (2, 5, 80), (3, 3, 60)])
def test_against_all_pairs(spark, monkeypatch, seed, k, num):
    monkeypatch.setattr(jj, "SHORT", 3)  # so that lists are skipped
    rows = near_copies(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jj.join(docs, k, num, 100).collect())
    assert got == brute(rows, k, num, 100)


def test_later_rounds_search_for_undone_classes_only(spark, monkeypatch):
    """Pairs of near copies are tried in the first round, so no list is searched again; a large group's classes are, by themselves."""
    searched, candidates = [], jj._candidates

    def counted(lists, bits, num, den, best, undone=None):
        searched.append((lists.select("node").distinct().count(), undone and undone.count()))
        return candidates(lists, bits, num, den, best, undone)

    monkeypatch.setattr(jj, "_candidates", counted)
    random.seed(4)
    word = lambda: f"w{random.randrange(500)}"
    shared, rows = " ".join(word() for _ in range(12)), []
    for g in range(40):
        base = [word() for _ in range(80)]
        rows += [(len(rows) + i, " ".join([*base[: 78 + i], shared])) for i in (1, 2)]
    pairs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.join(pairs).collect()) == brute(rows, 4, 85, 100)
    assert len(searched) == 1 and searched[0][1] is None
    searched.clear()
    base = [word() for _ in range(120)]
    for i in range(60):  # a chain: neighbours differ in few words, the ends in many
        base[2 * i] = f"x{i}"
        rows.append((len(rows) + 1, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.join(docs).collect()) == brute(rows, 4, 85, 100)
    assert len(searched) > 1 and all(0 < undone <= 60 and nodes <= 60 for nodes, undone in searched[1:])


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(7, text), (7, text), (3, text + " more"), (None, text), (9, "other words entirely here now"), (9, text + " and more"), (None, "alone " * 3 + "z"), (None, "")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jj.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(7, 57, 3), (3, 58, 3), (None, 57, 3), (9, 2, 9), (9, 59, 3), (None, 1, None), (None, 0, None)}
    out = jj.keep_one(spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, component_id string"))
    assert out.columns == ["doc_id", "text", "component_id"]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == [-1, -1, 3, 9]


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    text, other = " ".join(f"t{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [
        (None, text, "copy without id"), (None, text, "copy without id"), (5, text, "least id"), (8, text + " more", "near copy"),
        (8, other, "same id, other text"), (None, other + " more", "near copy without id"),
        (None, "only here " * 30, "alone"), (None, "only here " * 30, "alone"), (None, None, "no text"), (4, "", "empty"), (4, " ", "blank"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = sorted(r._row for r in jj.keep_one(docs).collect())
    assert got == ["alone", "blank", "empty", "least id", "no text", "same id, other text"]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jj.join(none).collect() == [] and jj.keep_one(none).collect() == []
