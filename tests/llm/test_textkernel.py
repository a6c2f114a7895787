"""The vectorised words against Python's regular expressions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from podium.llm import textkernel as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
random.seed(1)
ROWS = [None, "", " ", "a", "a b", "  a\tb\nc  ", "Ünï ß x A", "x" * 5000, "- a . b,", "\n", "\x00 \x00\x00 a"]
ROWS += ["".join(random.choice("ab .\n,Éz") for _ in range(random.randint(0, 60))) for _ in range(300)]


def lowered(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


@pytest.mark.parametrize("chunk", [1, 50, 1 << 18])
def test_words_and_shingles(chunk):
    by_hash, by_shingle = {}, {}
    for w in tk.words(pa.array(ROWS), chunk):
        for r in range(len(w.row_at) - 1):
            a, z = w.first[r], w.first[r + 1]
            assert [bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:z], w.end[a:z])] == WORD.findall(lowered(ROWS[w.row0 + r]))
        for h, s, e in zip(w.hash, w.start, w.end):
            by_hash.setdefault(int(h), set()).add(bytes(w.data[s:e]))
        h, at = w.shingles(3)
        assert len(h) == sum(max(0, n - 2) for n in np.diff(w.first))
        for x, i in zip(h, at):
            by_shingle.setdefault(int(x), set()).add(tuple(bytes(w.data[w.start[i + j] : w.end[i + j]]) for j in range(3)))
    for found in (by_hash, by_shingle):
        assert all(len(v) == 1 for v in found.values())
        assert len({x for v in found.values() for x in v}) == len(found)


def test_plain_words_ignore_punctuation():
    same = tk.words(pa.array(["Hello, (World) -- 2.0!", "hello world 20"]), plain=True)
    (w,) = same
    assert list(w.first) == [0, 3, 6]
    assert (w.hash[:3] == w.hash[3:]).all()


def test_no_rows():
    assert list(tk.words(pa.array([], pa.string()))) == []
