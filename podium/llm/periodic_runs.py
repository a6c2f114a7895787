"""Periodic run detection by internal pattern matching.

A run of a text is a stretch of words of smallest period q (words q apart are the
same) of at least ``max(min_words, times * q)`` words that no word beside it
extends.  All runs are found, by the occurrences of a text's blocks inside the
text itself:

1. :func:`ranks`: prefix doubling gives, for every power of two 2^k up to the
   longest period, the rank of each place's 2^k words, and with the last of them a
   suffix array.  Equal ranks are equal words, never hashes of them, so the ranks
   also compare two places (:func:`ahead`, :func:`behind`), and the occurrences of
   a block are an interval of the suffix array.
2. :class:`Wavelet`: the places of an interval in order; the next place from a
   given one on is a range successor query, all blocks of a level at a time.
3. :func:`candidates`: dyadic blocks ask for their occurrences in the window next
   to them.  A run of period q holds an aligned block of L words, L <= q < 2L (or
   q < L for the least L, :func:`base`), with its copy q words on.  Occurrences
   nearer to each other than L form one progression, of the block's own period p;
   where there are three or more, q is the distance of either the starts or the
   ends of the stretches of period p that hold the block and its copies.  So a
   block gives at most three candidate periods, however many occurrences it has.
4. Each candidate is extended both ways; of stretches found with several periods
   the smallest counts.

Texts are taken in slices of about ``SLICE`` words, with a mark of its own after
each text, so no run reaches over a text's end; a longer text is a slice of its
own.  Memory follows the slice (4 bytes a word for each power of two up to a
third of the longest text, and as many for the wavelet tree).  There is no
shuffle: a row's result depends on the row alone.

Defined results: null, empty and blank texts have no words and no runs; rows are
judged one by one, so rows that repeat, and null ids, are rows like others; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import mapped, table

#: least words of a run, and least times its period
MIN_WORDS, TIMES = 24, 3
#: words processed together
SLICE = 1 << 16


def base(min_words: int) -> int:
    """Words of the smallest blocks: in every run of a period below it lies an aligned one with its copy."""
    return 1 << max(0, ((min_words + 2) // 3).bit_length() - 1)


def ranks(words: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks by the first 1, 2, 4, .. words of each place, and the places in order of the last of them.

    A rank is the number of places with less in front, so equal ranks k and the
    next rank bound an interval of the order.  Powers go up to ``longest`` words
    (the longest period), or end when all ranks differ.
    """
    n, levels, step = len(words), [], 1
    key = words.astype(np.int64)
    while True:
        order = np.argsort(key, kind="stable")
        opens = np.append(True, np.diff(key[order]) != 0)
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
        levels.append(rank)
        if opens.all() or 2 * step > longest:
            return levels, order
        following = np.append(rank[step:], np.full(min(step, n), -1, np.int32)).astype(np.int64)
        key = rank * np.int64(n + 1) + following + 1
        step *= 2


def ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i and from j on are the same (i < j; marks, each of its kind, end every text)."""
    total, again = np.zeros(len(i), np.int64), np.arange(len(i))
    top = len(levels) - 1
    while len(again):
        same = levels[top][i[again] + total[again]] == levels[top][j[again] + total[again]]
        again = again[same]
        total[again] += 1 << top
    for k in range(top - 1, -1, -1):
        total += np.where(levels[k][i + total] == levels[k][j + total], 1 << k, 0)
    return total


def behind(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before i and before j are the same (i < j)."""
    total = np.zeros(len(i), np.int64)

    def same(k, at):
        left = i[at] - total[at] - (1 << k)
        return (left >= 0) & (levels[k][np.maximum(left, 0)] == levels[k][j[at] - total[at] - (1 << k)])

    again, top = np.arange(len(i)), len(levels) - 1
    while len(again):
        again = again[same(top, again)]
        total[again] += 1 << top
    whole = np.arange(len(i))
    for k in range(top - 1, -1, -1):
        total += np.where(same(k, whole), 1 << k, 0)
    return total


class Wavelet:
    """Wavelet matrix over a permutation of 0 .. n - 1; every query takes arrays."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            self.zeros.append(np.append(0, np.cumsum(low)).astype(np.int32))
            values = np.concatenate((values[low], values[~low]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of the interval [lo, hi) are less than x."""
        count = np.where(x >> self.bits > 0, hi - lo, 0)
        for bit, z in zip(range(self.bits - 1, -1, -1), self.zeros):
            a, b, one = z[lo].astype(np.int64), z[hi].astype(np.int64), (x >> bit) & 1 == 1
            count += np.where(one & (x >> self.bits == 0), b - a, 0)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th least value (from 0) of the interval [lo, hi)."""
        value = np.zeros(len(lo), np.int64)
        for bit, z in zip(range(self.bits - 1, -1, -1), self.zeros):
            a, b = z[lo].astype(np.int64), z[hi].astype(np.int64)
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value += np.where(one, 1 << bit, 0)
            lo, hi = np.where(one, z[-1] + lo - a, a), np.where(one, z[-1] + hi - b, b)
        return value


def candidates(levels: list[np.ndarray], order: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): every run holds one of the places with its smallest period; ``least`` is the smallest block."""
    n, tree, places, periods = len(order), None, [], []

    def give(at: np.ndarray, period: np.ndarray) -> None:
        real = period > 0
        places.append(at[real])
        periods.append(period[real])

    for k in range(least.bit_length() - 1, len(levels)):
        size = 1 << k
        block = np.arange(0, n - size + 1, size)
        low = levels[k][block].astype(np.int64)
        high = low + np.bincount(levels[k], minlength=n)[low]
        again = high - low > 1
        block, low, high = block[again], low[again], high[again]
        if not len(block):
            return _joined(places, periods)
        tree = tree or Wavelet(order)
        to_near, to_far = tree.below(low, high, block + size), tree.below(low, high, block + 2 * size)
        if size == least:
            # shorter periods than the least block: occurrences this near go on with the first one's distance
            here = tree.below(low, high, block + 1)
            some = to_near > here
            give(block[some], tree.nth(low[some], high[some], here[some]) - block[some])
        some = to_far > to_near
        block, low, high, first, last = (x[some] for x in (block, low, high, to_near, to_far - 1))
        if not len(block):
            continue
        one, end = tree.nth(low, high, first), tree.nth(low, high, last)
        give(block, one - block)
        give(block[end > one], (end - block)[end > one])
        many = last - first >= 2
        block, low, high, first, one = (x[many] for x in (block, low, high, first, one))
        if len(block):
            p = tree.nth(low, high, first + 1) - one
            left = behind(levels, one, one + p) - behind(levels, block, block + p)
            right = ahead(levels, one, one + p) - ahead(levels, block, block + p)
            give(block, one - block - left)
            give(block, one - block + right)
    return _joined(places, periods)


def _joined(*lists: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.empty(0, np.int64), *x]) for x in lists)


def runs_of(words: np.ndarray, longest: int, min_words: int = MIN_WORDS, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``words``: numbers of the words, every text ended by a number of its own;
    ``longest``: the words of the longest text; ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("a run holds its period three times at least")
    levels, order = ranks(words, max(longest // times, base(min_words)))
    at, period = candidates(levels, order, base(min_words))
    left = at + period < len(words)
    at, period = at[left], period[left]
    before, after = behind(levels, at, at + period), ahead(levels, at, at + period)
    start, length = at - before, before + after + period
    good = length >= np.maximum(min_words, times * period)
    found = np.column_stack((start, length, period))[good]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1))[: len(found)]
    found = found[fresh]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _together(texts: list[list[bytes]], min_words: int, times: int) -> list[np.ndarray]:
    """The runs of each of the texts, given as words."""
    number: dict[bytes, int] = {}
    ids = [[number.setdefault(w, len(number)) for w in words] for words in texts]
    size = np.array([len(x) for x in ids])
    first = np.cumsum(size + 1) - (size + 1)
    words = np.concatenate([np.array([*x, len(number) + t], np.int64) for t, x in enumerate(ids)])
    found = runs_of(words, int(size.max()), min_words, times)
    cut = np.searchsorted(found[:, 0], np.append(first, len(words)))
    return [found[a:b] - [f, 0, 0] for a, b, f in zip(cut[:-1], cut[1:], first)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run contains after its first period, one space between."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, min_words: int = MIN_WORDS, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and collapsed text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held, n_held = [], [], 0
            for i in range(len(b)):
                text = b.column(1)[i].as_py()
                rows.append([b"" if text is None else text, np.empty((0, 3), np.int64)])
                words = rows[-1][0].split()
                if len(words) >= min_words:
                    held.append((len(rows) - 1, words))
                    n_held += len(words)
                if n_held >= SLICE or i + 1 == len(b) or len(rows) >= 4096:
                    yield _out(b.column(0).slice(i + 1 - len(rows), len(rows)), rows, held)
                    rows, held, n_held = [], [], 0

    def _out(doc_id: pa.Array, rows: list[list], held: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
        if held:
            for (r, _), found in zip(held, _together([w for _, w in held], min_words, times)):
                rows[r][1] = found
        every = np.concatenate([r[1] for r in rows])
        offsets = np.append(0, np.cumsum([len(r[1]) for r in rows])).astype(np.int32)
        struct = pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], fields=list(_RUNS.value_type))
        text = pa.array([_collapsed(r[0].split(), r[1]).decode() for r in rows], pa.string())
        return pa.RecordBatch.from_arrays([doc_id, pa.ListArray.from_arrays(pa.array(offsets), struct), text], ["doc_id", "runs", "collapsed"])

    # bytes.split() cuts at the six ASCII white-space characters, as words are defined here
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return mapped(texts, run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` with a periodic tail in each text whose id's crc32 ends in 0 (see the query's contract)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    tail = docs.where((h % 10 == 0)).select("doc_id", words.alias("w"), g.alias("g")).withColumn("n", F.size("w").cast("long"))
    tail = tail.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    again = F.expr("transform(sequence(0L, n - 1), i -> element_at(w, CAST(1 + if(i >= a, a + (i - a) % p, i) AS INT)))")
    tail = tail.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise("").alias("text"))
    return tail.unionByName(docs.where((h % 10 != 0) | h.isNull()).select("doc_id", "text"))


def _best(runs: Column) -> Column:
    """The run of the greatest length / period (exactly), then the smallest start, then period."""

    def order(x: Column, y: Column) -> Column:
        more = F.signum(y["length"] * x["period"] - x["length"] * y["period"])
        return F.when(more != 0, more).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")

    return F.get(F.array_sort(runs, order), F.lit(0))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = found.withColumn("best", F.when(F.size("runs") > 0, _best(F.col("runs"))))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000L * best.length) div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: for every distance q up to a third of a text, the stretches of words equal to the one q further on
ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda s, z: CASE WHEN s & 1 = 1 THEN xor(3988292384::BIGINT, s >> 1) ELSE s >> 1 END))) AS h
  FROM documents
), e AS (
  SELECT doc_id, l, len(l) AS n, h, h // 10 AS g, CASE WHEN len(l) > 0 THEN (h // 10) % len(l) END AS a FROM d
), f AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e
), w AS MATERIALIZED (
  SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN l[1 + a + (i - a) % p] ELSE l[1 + i] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM f)
), q AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
  WHERE 3 * (y.i - x.i) <= x.n
), s AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM q
), r AS (
  SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM s GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)
), m AS MATERIALIZED (
  SELECT doc_id, start, length, min(q) AS period FROM r GROUP BY doc_id, start, length
), t AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM m GROUP BY doc_id
), b AS (
  SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY doc_id
    ORDER BY (length::HUGEINT * 1000000000000) // period DESC, start, period) = 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM m
), c AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  ((1000 * length) // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)
"""
