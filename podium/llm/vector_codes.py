"""Vector code compression: product codes whose nearest entries come from memoised grid cells.

A vector is cut into equal parts, and each part is replaced by the number of the
nearest entry of its place's codebook.  All arithmetic is on whole numbers
(``floor(scale * x)``), so results do not depend on the order of sums.

- Grid cells: each part's coarse cell (its components divided by the place's
  ``side``) is looked up in a table.  For a cell seen first, every entry's least
  and greatest distance to the cell's box are worked out, and the entries not
  dominated across the box are kept: those whose least distance is not above
  the smallest greatest distance.  Only these are evaluated exactly, part by
  part.  The table holds ``CELLS`` cells a place and begins anew when it is full;
  that, and ``side`` (a power of two set from the entries' distances), change the
  time only.
- Training: each round is one pass; a task hands on one sum and one count for
  every entry, which Spark adds up.  Codebooks are of a fixed size (``parts`` x
  ``entries`` x components), so they pass through the driver and go to every task.

A pass is one scan of the vectors and shuffles only those sums; nothing else
meets in one task, however many copies a vector has.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped; so are rows whose vector is empty, or no multiple of
``parts`` long, or not as long as that of the smallest id left (null ids last).
Rows that repeat an id are rows like others, and of equal ids the smaller vector
comes first among the entries to start from.  With fewer vectors than entries
the codebooks have as many entries as vectors; an empty table gives an empty
result.  Null labels are one label.  Numbers beyond ``LIMIT`` after scaling are
an error, as sums of squares may not fit a long.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import mapped, salted_join, staged, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: cells remembered for each part's place
CELLS = 1 << 15
#: rows worked on together
ROWS = 4096
#: greatest size of a scaled component
LIMIT = 1 << 26


@dataclass
class Codebooks:
    """``entry[part, index]`` is a vector of whole numbers."""

    entry: np.ndarray
    scale: int

    @property
    def width(self) -> int:
        return self.entry.shape[0] * self.entry.shape[2]

    def sha256(self) -> str:
        """Digest of all components by part, entry, position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entry.reshape(-1).tolist())).encode()).hexdigest()


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as int64."""
    out = np.floor(vectors * float(scale))
    if len(out) and np.abs(out).max(initial=0) > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT} after scaling by {scale}")
    return out.astype(np.int64)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a matrix of whole numbers and the number of each row's."""
    least = rows.min(axis=0)
    span = [int(n) + 1 for n in rows.max(axis=0) - least]
    if float(np.prod(np.array(span, float))) >= 2.0**62:
        distinct, of = np.unique(rows, axis=0, return_inverse=True)
        return distinct, of.reshape(-1)
    key = np.zeros(len(rows), np.int64)
    for c, n in enumerate(span):
        key = key * n + rows[:, c] - least[c]
    _, at, of = np.unique(key, return_index=True, return_inverse=True)
    return rows[at], of


class Cells:
    """Nearest entries of one place, by remembered cells."""

    def __init__(self, entry: np.ndarray):
        self.entry = entry
        self.side = self._side()
        self.known: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _side(self) -> int:
        """A power of two at most the median distance from an entry to the one nearest to it."""
        d = ((self.entry[:, None] - self.entry[None]) ** 2).sum(axis=2).astype(float)
        np.fill_diagonal(d, np.inf)
        near = float(np.sqrt(np.median(d.min(axis=1)))) if len(d) > 1 else 1.0
        return 1 << max(0, int(near).bit_length() - 1)

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell (its least corner / side) the entries not dominated across its box, ascending."""
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if len(self.known) + len(new) > CELLS:
            self.known = {}
            new = list(range(len(keys)))
        for lo in range(0, len(new), 512):
            at = new[lo : lo + 512]
            low = cells[at][:, None] * self.side
            high = low + self.side - 1
            least = (np.maximum(np.maximum(low - self.entry, self.entry - high), 0) ** 2).sum(axis=2)
            most = (np.maximum(np.abs(self.entry - low), np.abs(high - self.entry)) ** 2).sum(axis=2)
            kept = least <= most.min(axis=1, keepdims=True)
            entries, ends = np.nonzero(kept)[1], np.cumsum(kept.sum(axis=1)).tolist()
            for i, a, b in zip(at, [0, *ends], ends):
                self.known[keys[i]] = entries[a:b]
        return [self.known[k] for k in keys]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row (ties: the lower) and its squared distance."""
        if not x.shape[1] or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        cells, of = _distinct(x // self.side)
        lists = self.candidates(cells)
        count = np.array([len(c) for c in lists])
        flat, first = np.concatenate(lists), np.cumsum(count) - count
        many = count[of]
        start = np.cumsum(many) - many
        row = np.repeat(np.arange(len(x)), many)
        entry = flat[np.arange(many.sum()) - np.repeat(start - first[of], many)]
        self.evaluated += len(entry)
        distance = ((x[row] - self.entry[entry]) ** 2).sum(axis=1)
        best = np.minimum.reduceat(distance, start)
        hit = np.flatnonzero(distance == best[row])
        hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])]  # candidates ascend, so the first is the lower
        return entry[hit], best


def _usable(vectors: DataFrame, parts: int) -> DataFrame:
    """vec_id, label and embedding (doubles) of rows whose vector is whole and as long as the others."""
    v = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (x == limit) | (x == -limit))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label, v.alias("embedding"))
    size = F.size("embedding")
    return rows.where(F.col("embedding").isNotNull() & ~bad & (size > 0) & (size % parts == 0))


def _first(rows: DataFrame, n: int, scale: int) -> np.ndarray:
    """The vectors of the ``n`` smallest ids (a bounded number of rows), null ids last."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = rows.orderBy(*order).limit(1).select(F.size("embedding").alias("n")).first()
    if head is None:
        return np.empty((0, 0), np.int64)
    got = rows.where(F.size("embedding") == head["n"]).orderBy(*order).limit(n).select("embedding").toArrow()
    return whole(np.array(got["embedding"].to_pylist(), float), scale)


def _matrices(column: pa.Array, width: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, scaled vectors) of slices of a column of lists of ``width`` doubles."""
    for lo in range(0, len(column), ROWS):
        part = column.slice(lo, ROWS)
        yield lo, whole(part.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), scale)


def _as_long(rows: DataFrame, books: Codebooks) -> DataFrame:
    return rows.where(F.size("embedding") == books.width)


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: entries replaced by ``floor(sum / count)`` of the parts assigned to them; unused ones stay."""
    parts, entries, size = books.entry.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(e) for e in books.entry]
        total = np.zeros((parts, entries, size), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, x in _matrices(b.column(0), parts * size, books.scale):
                for p in range(parts):
                    mine = x[:, p * size : (p + 1) * size]
                    index, _ = cells[p].nearest(mine)
                    for c in range(size):  # sums of whole numbers below 2^53, so exact
                        total[p, :, c] += np.bincount(index, mine[:, c], entries).astype(np.int64)
                    count[p] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(count)
        place, at = np.tile(np.arange(size), len(part)), np.repeat(np.arange(len(part)), size)
        out = (part[at], entry[at], place, total[part[at], entry[at], place], count[part[at], entry[at]])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["part", "entry", "place", "total", "n"])

    sums = mapped(rows.select("embedding"), assign, "part long, entry long, place long, total long, n long")
    got = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
    out = books.entry.copy()
    part, entry, place, total, n = (got[c].to_numpy() for c in ("part", "entry", "place", "total", "n"))
    out[part, entry, place] = total // n
    return Codebooks(out, books.scale)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of a column ``embedding``, trained on all rows from the vectors of the smallest ids."""
    rows = _usable(vectors, parts)
    first = _first(rows, entries, scale)
    books = Codebooks(first.reshape(len(first), parts, -1).transpose(1, 0, 2) if len(first) else np.empty((parts, 0, 0), np.int64), scale)
    for _ in range(rounds if len(first) else 0):
        books = improved(_as_long(rows, books), books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (one byte a part) and error (squared distance, summed over parts) of every usable row."""
    parts, entries, size = books.entry.shape
    if entries > 256:
        raise ValueError("a code has one byte for each part")
    rows = _as_long(_usable(vectors, parts), books)
    if not entries:
        rows = rows.where(F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(e) for e in books.entry]
        for b in batches:
            for lo, x in _matrices(b.column(2), parts * size, books.scale):
                code, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
                for p in range(parts):
                    index, distance = cells[p].nearest(x[:, p * size : (p + 1) * size])
                    code[:, p] = index
                    error += distance
                packed = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(x)), b.column(1).slice(lo, len(x)), packed, pa.array(error)], ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return mapped(rows, run, f"vec_id long, label {kind}, code binary, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with the vector (array of doubles) that each ``code`` stands for in a column ``decoded``."""
    flat = F.array(*[F.array(*[F.array(*[F.lit(x / books.scale) for x in e]) for e in part]) for part in books.entry.tolist()])
    index = lambda p: F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("decoded", F.concat(*[F.element_at(F.element_at(flat, p + 1), index(p) + 1) for p in range(books.entry.shape[0])]))


def _key(label: Column) -> Column:
    """A key of a label's equality in which null is a value of its own."""
    return F.struct(label.isNull().alias("none"), F.coalesce(label.cast("string"), F.lit("")).alias("text"))


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the error summed over all rows of the label (nulls together).

    The sums are combined map-side, and a hot label's rows are dealt to several
    tasks in the join.
    """
    keyed = coded.withColumn("_key", _key(F.col("label")))
    sums = keyed.groupBy("_key").agg(F.sum("error").alias("label_error"))
    return salted_join(keyed, sums, ["_key"], F.col("vec_id"), "inner").drop("_key")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    books = fit(vectors)
    coded = with_label_error(staged(encode(vectors, books), "codes"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _assigned(book: str, out: str) -> str:
    """CTEs that assign every part to the nearest entry of a codebook table (part, entry, v)."""
    return f"""{out} AS MATERIALIZED (
  SELECT x.vec_id, x.part, any_value(x.v) AS v, arg_min(b.entry, d * 64 + b.entry) AS entry, min(d) AS d
  FROM x JOIN {book} b USING (part), LATERAL (SELECT list_sum(list_transform(range(1, 5), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))::BIGINT AS d)
  GROUP BY x.vec_id, x.part
)"""


def _replaced(book: str, assigned: str, out: str) -> str:
    """A CTE with each entry's floor of the mean of its parts."""
    mean = "(s - ((s % n) + n) % n) // n"
    return f"""{out} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN (
    SELECT part, entry, list({mean} ORDER BY i) AS v FROM (
      SELECT part, entry, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM {assigned}, range(1, 5) t(i) GROUP BY part, entry, i
    ) GROUP BY part, entry
  ) m USING (part, entry)
)"""


ORACLE = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS v FROM k, range(16) t(part)
), f AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64
), b0 AS MATERIALIZED (
  SELECT part, entry, v FROM x JOIN f USING (vec_id)
), {_assigned("b0", "a0")}, {_replaced("b0", "a0", "b1")}, {_assigned("b1", "a1")}, {_replaced("b1", "a1", "b2")}, {_assigned("b2", "a2")}, c AS (
  SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id
), h AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM c JOIN k USING (vec_id), h
"""
