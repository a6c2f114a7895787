import random

import numpy as np

from podium.llm import license_scan as ls


def lcs(a, b, low, high):
    best = {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i == 0 or j == 0:
                best[i, j] = 0
                continue
            options = [best[i - 1, j], best[i, j - 1]]
            if a[i - 1] == b[j - 1] and low <= j - i <= high:
                options.append(best[i - 1, j - 1] + 1)
            best[i, j] = max(options)
    return best[len(a), len(b)]


def test_banded_alignment_is_a_longest_common_subsequence():
    random.seed(1)
    for _ in range(200):
        a = np.array([random.randrange(6) for _ in range(random.randint(1, 12))])
        b = np.array([random.randrange(6) for _ in range(random.randint(1, 16))])
        pairs = ls.banded_lcs(a, b, -20, 20)
        assert len(pairs) == lcs(a, b, -20, 20)
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)
        narrow = ls.banded_lcs(a, b, -2, 2)
        assert all(-2 <= j - i <= 2 and a[i] == b[j] for i, j in narrow) and len(narrow) <= len(pairs)


def test_winnowing_keeps_one_of_every_window():
    random.seed(2)
    for n in range(0, 40):
        h = np.array([random.randrange(100) for _ in range(n)], np.uint64)
        kept = set(ls.winnow(h).tolist())
        for i in range(n - ls.WINDOW + 1):
            assert kept & set(range(i, i + ls.WINDOW))
        assert bool(kept) == (n > 0)


MIT = ls.TEMPLATES[2][1]
CASES = [
    (1, "Intro é\nReleased under the MIT License.\nmore", {"MIT"}),
    (2, "LICENSED under the   apache license, version 2.0", {"Apache-2.0"}),
    (3, "nothing here " * 100, set()),
    (4, None, set()), (5, "", set()), (6, "the license", set()),
    (7, "😀 " + MIT.replace("free of charge,", "free of any charge") + " end", {"MIT"}),
    (8, "This work is licensed under the GNU General Public License, version 3. " * 3, {"GPL-3.0"}),
    (9, MIT[: len(MIT) // 3], set()),
    (10, "word " * 30000 + "Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
]


def test_scan(spark):
    docs = spark.createDataFrame([(*c[:2], "x") for c in CASES], "doc_id long, text string, license string")
    got = ls.scan(docs).collect()
    for i, text, names in CASES:
        assert {r.license for r in got if r.doc_id == i} == names
    spans = {(r.doc_id, r.start): CASES[r.doc_id - 1][1][r.start : r.end] for r in got}
    assert "Released under the MIT License." in spans.values()
    assert [t for (i, _), t in spans.items() if i == 10] == ["Licensed under CC BY-NC 4.0."]
    assert sum(r.doc_id == 8 for r in got) == 3 and all(r.coverage == 1 for r in got if r.doc_id != 7)
    assert [r.start for r in got if r.doc_id == 7] == [2] and [0.95 < r.coverage <= 1 for r in got if r.doc_id == 7] == [True]


def spans(text):
    index = ls.build_index()
    (w,) = ls.tk.words(ls.pa.array([text]), plain=True)
    h, at = w.shingles(ls.K)
    hits = [(int(t), int(a), int(p)) for x, a in zip(h, at) for f, t, p in zip(index.fingerprint, index.template, index.at) if f == x]
    return [(text[w.start[a] : w.end[z]], round(c, 2)) for c, _, _, a, z in ls.best_of(ls.matches(w.hash, hits, index), index)]


def test_short_notices_repeated_in_a_row():
    for notice in ("Licensed under the MIT License.", "All rights reserved.", "Licensed under CC BY-NC 4.0."):
        for n in (1, 2, 3, 7, 300):
            assert spans(f"{notice}\n" * n) == [(notice, 1.0)] * n
    assert spans("All rights reserved. Copyright 2021 Y All rights reserved.") == [("All rights reserved.", 1.0)] * 2
    edited, notice = "Licensed under the MIT", "Licensed under the MIT License."
    assert spans(" ".join([f"{edited} Y", notice] * 4 + [f"{edited} Y"] * 3)) == [(edited, 0.8), (notice, 1.0)] * 4 + [(edited, 0.8)] * 3


def test_a_notice_that_drifts_is_one_occurrence():
    words = MIT.split()
    text = " ".join(x + (" x y z" if i % 12 == 11 else "") for i, x in enumerate(words))
    assert [c for _, c in spans(f"{text} {text}")] == [1.0, 1.0]


def test_counted_subsequence():
    random.seed(3)
    for _ in range(200):
        a = np.array([random.randrange(6) for _ in range(random.randint(1, 12))])
        b = np.array([random.randrange(6) for _ in range(random.randint(0, 16))])
        assert ls.in_common(ls.word_mask(a), len(a), b.tolist()) == lcs(a, b, -20, 20)


def test_wide_bands_are_cut_into_pieces_that_hold_every_drift():
    for low, high, size in [(0, 0, 5), (3, 12, 5), (-40, 100, 7), (0, 11, 5)]:
        pieces = ls.cut([(low, high)], size)
        assert pieces[0][0] == low and pieces[-1][1] == high and all(z - a <= 2 * size for a, z in pieces)
        assert all(any(a <= d and min(high, d + size) <= z for a, z in pieces) for d in range(low, high + 1))


def test_a_long_text_of_one_indexed_run():
    index = ls.build_index()
    where = int(index.at[index.template == 2].min())
    run, noise = " ".join(MIT.split()[where : where + ls.K]) + " ", "Licensed under the MIT License."
    assert spans(run * 33000) == []
    edited = MIT.replace("free of charge,", "free of any charge")
    got = spans(run * 5000 + edited + " " + run * 5000 + noise + " " + run * 5000)
    assert [t for t, _ in got if t == noise] == [noise] and len(got) == 2
    assert got[0][1] >= 0.95 and edited.split()[-1].strip(".") in got[0][0].split()[-1]


def test_empty(spark):
    assert ls.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
