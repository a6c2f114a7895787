"""Line dedup by winnowing over line hashes.

A line is its words, lowered; blank lines belong to the run they stand in.  A
fingerprint is the hash of the shortest run of lines from a non-blank one that
holds ``GRAM_WORDS`` words; of all fingerprints inside each window the least is
kept.  Windows are the shortest runs of ``MIN_WORDS`` words that begin with a
line, and those that end with one, so every line of a run of ``MIN_WORDS`` words
lies in a window inside the run, also if the run is a single long line.

A kept fingerprint stands for its whole window: places are joined by it together
with the hash of the window's lines, with the earliest such place (by doc_id,
text hash, line), not with each other.  A passage in a third of all documents
makes one row per window, and an earlier text that shares the fingerprint's
lines alone hides no other.  Both texts' lines are compared from there backwards
and forwards; the equal run holds the window, and the later document loses it,
so every repeated run of ``MIN_WORDS`` words is found.  An earliest place is
never removed by its own window, so of every passage a copy stays.

Defined results: null text has no line and stays null; rows that repeat with id
and text are one document and get the same result; rows of a null id come
first; ties of a fingerprint inside a window go to its rightmost place; an
empty table gives an empty result; other columns are carried along in a struct
and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm import textkernel as tk
from podium.llm.common import mapped, salted_join, staged, table, unstage

#: words of a repeated run that is removed, and of a fingerprint
MIN_WORDS, GRAM_WORDS = 50, 25
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def line_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, hash per line, words per line) of every row; a line without words has hash 0."""
    for w in tk.words(column):
        breaks = np.flatnonzero(w.data == 10) + 1
        # a line starts at a row and after each break; rows of no bytes have one line too
        row_of_break = np.searchsorted(w.row_at, breaks - 1, "right") - 1
        n_lines = np.bincount(row_of_break, minlength=len(w.row_at) - 1) + 1
        first = np.concatenate(([0], np.cumsum(n_lines)))
        start = np.empty(first[-1], np.int64)
        start[first[:-1]] = w.row_at[:-1]
        inner = np.ones(first[-1], bool)
        inner[first[:-1]] = False
        start[inner] = breaks
        begin = np.searchsorted(w.start, start)
        # a break that ends a row starts a line at the next row's first byte, which has none of its words
        row_end = np.repeat(w.first[1:], n_lines)
        begin = np.minimum(begin, row_end)
        end = np.append(begin[1:], len(w.start))
        end = np.minimum(end, row_end)
        count = end - begin
        full = np.flatnonzero(count)
        h = np.zeros(len(start), np.uint64)
        if len(full):
            at = np.arange(len(w.hash)) - np.repeat(begin[full], count[full])
            h[full] = tk.mix64(np.add.reduceat(w.hash * _powers(_ODD, int(count.max()) + 1)[at], begin[full]) + count[full].astype(np.uint64))
        for r in range(len(n_lines)):
            yield w.row0 + r, h[first[r] : first[r + 1]], count[first[r] : first[r + 1]]


def fingerprints(h: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per window of one text, the hash of its kept fingerprint and its lines, and the line the fingerprint is at."""
    total = np.concatenate(([0], np.cumsum(words)))
    if total[-1] < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(h)
    starts = np.flatnonzero(words)
    gram_end = np.searchsorted(total, total[starts] + GRAM_WORDS)
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(_ODD, n), dtype=np.uint64)))
    inverse = _powers(_INVERSE, n)

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return tk.mix64((run[end] - run[start]) * inverse[start] + (total[end] - total[start]).astype(np.uint64))

    # a gram that the text ends in lies in no window
    gram = hashes(starts, np.minimum(gram_end, n))
    ahead = np.searchsorted(total, total[starts] + MIN_WORDS)
    back = np.searchsorted(total, total[starts + 1] - MIN_WORDS, "right") - 1
    begins, ends = ahead <= n, back >= 0
    windows = np.unique(np.stack((np.append(starts[begins], back[ends]), np.append(ahead[begins], starts[ends] + 1))), axis=1)
    # grams that end inside a window are those from its first line up to last, as gram ends never fall
    first, last = np.searchsorted(starts, windows[0]), np.searchsorted(gram_end, windows[1], "right")
    kept = np.array([z - 1 - int(np.argmin(gram[a:z][::-1])) for a, z in zip(first.tolist(), last.tolist())], np.int64)
    return tk.mix64(hashes(windows[0], windows[1]) * np.uint64(_ODD) + gram[kept]).astype(np.int64), starts[kept]


def extend(a: np.ndarray, i: int, b: np.ndarray, j: int) -> tuple[int, int]:
    """Lines [from, to) of ``b`` around ``j`` that equal those of ``a`` around ``i``."""
    back, ahead = min(i, j), min(len(a) - i, len(b) - j)
    differ = np.flatnonzero(a[i - back : i] != b[j - back : j])
    low = j - back + (int(differ[-1]) + 1 if len(differ) else 0)
    differ = np.flatnonzero(a[i : i + ahead] != b[j : j + ahead])
    return low, j + (int(differ[0]) if len(differ) else ahead)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """id, th, n_lines and removed (array of (start, end) lines) of the documents that lose lines.

    ``docs``: id, th (text hash) and text, one row per document.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, words = [b""] * len(b), [b""] * len(b)
            for r, h, n in line_hashes(b.column(2)):
                lines[r], words[r] = h.tobytes(), n.astype(np.int32).tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lines, pa.binary()), pa.array(words, pa.binary())], ["id", "th", "lines", "words"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprints(np.frombuffer(lines, np.uint64), np.frombuffer(words, np.int32)) for lines, words in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            row = np.repeat(np.arange(len(got)), [len(f) for f, _ in got])
            f, line = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*got) if got else ((), ())))
            yield pa.RecordBatch.from_arrays([pa.array(f), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(line)], ["f", "id", "th", "line"])

    lines = mapped(docs.select("id", "th", "text"), split, "id long, th long, lines binary, words binary")
    lines = staged(lines.dropDuplicates(["id", "th"]), "lines")
    places = staged(mapped(lines, keep, "f long, id long, th long, line long"), "places")
    earliest = places.groupBy("f").agg(F.min(F.struct("id", "th", "line")).alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = salted_join(places, earliest, ["f"], F.xxhash64("id", "th"), "inner").where(F.struct("id", "th", "line") != F.col("least"))
    # windows of one run lie on one diagonal; the first stands for them if the run is unbroken, so all are tried
    matched = later.groupBy("id", "th", F.col("least.id").alias("a_id"), F.col("least.th").alias("a_th")).agg(
        F.sort_array(F.collect_set(F.struct("line", F.col("least.line").alias("a_line")))).alias("at")
    )
    a = lines.select(F.col("id").alias("a_id"), F.col("th").alias("a_th"), F.col("lines").alias("a_lines"))
    used = matched.select("a_id", "a_th").distinct()
    own = matched.join(lines, ["id", "th"])
    both = salted_join(own, a.join(used, ["a_id", "a_th"]), ["a_id", "a_th"], F.xxhash64("id", "th"), "inner")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for id_, th, at, mine, words, other in zip(*(c.to_pylist() for c in b.columns)):
                x, y, n = np.frombuffer(other, np.uint64), np.frombuffer(mine, np.uint64), np.frombuffer(words, np.int32)
                done: dict[int, int] = {}  # diagonal -> end of its last run
                for p in at:
                    j, i = p["line"], p["a_line"]
                    if j < done.get(j - i, 0):
                        continue
                    low, high = extend(x, i, y, j)
                    done[j - i] = high
                    if int(n[low:high].sum()) >= MIN_WORDS:
                        rows.append((id_, th, low, high))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "th", "start", "end"])

    runs = mapped(both.select("id", "th", "at", "lines", "words", "a_lines"), grow, "id long, th long, start long, end long")
    # a document's runs are at most its lines
    out = staged(runs.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed")), "runs")
    unstage(lines, places)
    return out


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the input row), ``text`` without the removed lines, n_lines, n_removed and ``removed`` (start, end)."""
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.col(text)).alias("th"),
        F.col(text).alias("text"),
    )
    runs = repeated_runs(keyed.where("text IS NOT NULL").select("id", "th", "text"))
    # runs follow the corpus, so they are never broadcast, and the plan is the same at every size
    out = keyed.join(runs.hint("merge"), ["id", "th"], "left")
    lines = F.split("text", "\n", -1)
    gone = lambda i: F.exists("removed", lambda r: (r["start"] <= i) & (i < r["end"]))
    kept = F.filter(lines, lambda x, i: ~gone(i))
    return out.select(
        "row",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("removed").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("removed"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "n_lines", "n_removed", "removed", "text")
