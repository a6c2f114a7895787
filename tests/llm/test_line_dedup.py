import random
import re

import numpy as np

from podium.llm import line_dedup as ld
from podium.llm.common import WORD

random.seed(6)


def lines_of(text):
    low = "".join(c.lower() if c < "\x80" else c for c in text)
    return [tuple(re.findall(WORD, x)) for x in low.split("\n")]


def line(n):
    return " ".join(random.choice("abcdefgh") + str(random.randrange(50)) for _ in range(n))


def corpus():
    passages = [[line(random.randint(3, 30)) for _ in range(random.randint(1, 8))] for _ in range(6)] + [[line(70)]]
    rows = [None, "", "\n\n", "short", "short"]
    for _ in range(60):
        t = []
        for _ in range(random.randint(0, 4)):
            t += random.choice(passages) if random.random() < 0.6 else [line(random.randint(0, 20)) for _ in range(3)]
        rows.append("\n".join(t))
    p = passages[0] + passages[1]
    rows.append("\n".join(p + ["between"] + p))  # repeated inside one text
    rows.append("\n".join(["Same line of Words"] * 40))
    return [(i, t) for i, t in enumerate(rows)]


def must_go(rows):
    """Lines of the shortest 50-word runs that occur earlier."""
    seen, out = set(), {}
    for i, t in rows:
        l, gone = lines_of(t or ""), set()
        for a in range(len(l)):
            n = 0
            for b in range(a, len(l) if l[a] else a):
                n += len(l[b])
                if n >= ld.MIN_WORDS:
                    k = tuple(l[a : b + 1])
                    if k in seen:
                        gone.update(range(a, b + 1))
                    seen.add(k)
                    break
        out[i] = gone
    return out


def test_every_repeated_run_goes_and_a_copy_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, lines string, id int")
    got = {r.row.doc_id: r for r in ld.dedup(docs).collect()}
    want, earlier = must_go(rows), set()
    assert len(got) == len(rows) and got[0].text is None
    for i, t in rows[1:]:
        g, l = got[i], lines_of(t)
        gone = {j for r in g.removed for j in range(r.start, r.end)}
        assert g.text == "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone)
        assert (g.n_lines, g.n_removed) == (len(l), len(gone))
        # nothing a window covers is missed, up to the ends that another earliest copy cuts off; nothing unseen goes
        assert len(want[i] - gone) <= 0.02 * max(1, len(want[i]))
        first = {}
        for j, x in enumerate(l):
            first.setdefault(x, j)
        assert all(not l[j] or l[j] in earlier or first[l[j]] < j for j in gone)
        earlier.update(l)
    assert sum(map(len, want.values())) > 100


def test_repeated_rows_null_ids_and_empty(spark):
    text = "\n".join(line(20) for _ in range(5))
    docs = spark.createDataFrame([(None, text), (4, text), (4, text), (9, "new\n" + text + "\nend"), (4, None)], "doc_id long, text string")
    got = [(r.row.doc_id, r.n_removed, r.text) for r in ld.dedup(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, 0, text), (4, 5, ""), (4, 5, ""), (9, 5, "new\nend"), (4, 0, None)], key=str)
    assert ld.dedup(docs.limit(0)).collect() == []


def test_extend():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 2, 3, 4, 8, 8])
    assert ld.extend(a, 2, b, 2) == (1, 4)
    assert ld.extend(a, 0, a, 0) == (0, 5)


def test_a_frequent_line_before_different_lines_hides_no_run(spark):
    common = [line(30) for _ in range(5)]
    passages = [f"{random.choice(common)}\n{line(30)}" for _ in range(40)]
    rows = list(enumerate(passages * 2))
    # the run goes on behind the window that an earlier text shares, by less than a window
    start, end = f"{line(30)}\n{line(30)}", line(5)
    rows += [(i, f"{start}\n{x}") for i, x in enumerate(("other", end, end), len(rows))]
    got = {r.row.doc_id: r for r in ld.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, gone in must_go(rows[:-1]).items():
        assert got[i].n_removed == len(gone)
    assert [got[i].n_removed for i in range(40, 80)] == [2] * 40
    assert [got[i].text for i in range(80, 83)] == [f"{start}\nother", end, ""]


def test_every_window_that_occurs_earlier_goes(spark):
    rows = corpus()
    got = {r.row.doc_id: r for r in ld.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, want in must_go(rows).items():
        assert want <= {j for r in got[i].removed for j in range(r.start, r.end)}
