import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from podium.llm import periodic_runs as pr


def brute(words, min_words=24, times=3):
    """All runs by comparing the text with itself at every distance."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_words, times * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, q, length) for (start, length), q in found.items())


def random_text(rng):
    kinds = rng.choice([1, 2, 3, 6, 60])
    w = [rng.randrange(kinds) for _ in range(rng.randrange(0, 200))]
    for _ in range(rng.randrange(4)):
        base = [rng.randrange(kinds) for _ in range(rng.randrange(1, 50))]
        if rng.random() < 0.5:  # a period that is itself nearly periodic
            inner = [rng.randrange(kinds) for _ in range(rng.randrange(1, 6))]
            base = (inner * 12)[: rng.randrange(1, 40)] + base[: rng.randrange(1, 8)]
        at = rng.randrange(0, len(w) + 1)
        w[at:at] = (base * 8)[: rng.randrange(len(base), 6 * len(base) + 1)]
        if rng.random() < 0.3:
            w[rng.randrange(len(w))] = 99
    return [b"%d" % x for x in w]


@pytest.mark.parametrize("seed", range(8))
def test_against_every_distance(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [t for t in (random_text(rng) for _ in range(5)) if t]
        for words, got in zip(texts, pr._together(texts, 24, 3)):
            assert sorted((s, q, n) for s, n, q in got.tolist()) == brute(words)


@pytest.mark.parametrize("min_words, times", [(3, 3), (7, 3), (12, 4), (24, 3), (50, 5)])
def test_other_limits(min_words, times):
    texts = [[b"a" if x >> i & 1 else b"b" for i in range(12)] for x in range(1 << 12)]
    rng = random.Random(min_words)
    texts += [t for t in (random_text(rng) for _ in range(40)) if t]
    for words, got in zip(texts, pr._together(texts, min_words, times)):
        assert sorted((s, q, n) for s, n, q in got.tolist()) == brute(words, min_words, times)


def test_wavelet_queries():
    rng = np.random.default_rng(1)
    values = rng.permutation(300)
    tree = pr.Wavelet(values)
    lo = rng.integers(0, 300, 500)
    hi = lo + 1 + (rng.random(500) * (300 - lo - 1)).astype(int)
    x = rng.integers(0, 1200, 500)
    assert tree.below(lo, hi, x).tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(lo, hi, x)]
    k = (rng.random(500) * (hi - lo)).astype(int)
    assert tree.nth(lo, hi, k).tolist() == [int(np.sort(values[a:b])[j]) for a, b, j in zip(lo, hi, k)]


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split()) if doc_id is not None else (text or "").encode().split()
    found = brute(words)
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in found)
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    s, q, n = min(found, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if found else (None,) * 3
    return (doc_id, len(found), s, n, q, None if s is None else 1000 * n // q, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def query(spark, rows, tmp_path, schema="doc_id long, text string, runs string, w int, g int, collapsed int"):
    data = [(*r, "x", 1, 2, 3) for r in rows]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in pr.op13_periodic_runs(spark, str(tmp_path)).collect()]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, b" ".join(random_text(rng)).decode().replace(" 9", "\n9")) for i in range(150)]
    rows += [(None, "x y " * 40), (3, "again " * 30), (3, "again " * 30), (200, None), (201, ""), (202, " \n\t "), (203, "  　 " * 30)]
    got = query(spark, rows, tmp_path)
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path) == []


def test_very_long_texts():
    rng = random.Random(3)
    text = [b"%d" % rng.randrange(5000) for _ in range(100_000)]
    text += [b"a", b"b"] * 100_000 + text[:50_000] * 4
    start = time.time()
    ((*found,),) = (pr._together([text], 24, 3),)
    # the passage's copies go on from its first one, which other words follow
    assert [tuple(x) for x in found[0].tolist()] == [(100_000, 200_000, 2), (300_000, 200_000, 50_000)]
    assert time.time() - start < 60
