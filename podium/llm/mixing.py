"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size.
Documents are put in one order inside each source (size descending, a hash,
id), their expected copies are prefix-summed, one random offset per source is
added, and a copy is emitted for each integer boundary a document's interval
crosses.  As every document of a source expects the same number, the prefix sum
is the document's index times that number, so only integer positions have to be
found: rows are range-partitioned by (source, size, hash, id), which cuts a hot
source into many ranges, and a table with one row per source and range carries
the counts before each.

The error of a source's mix is at most half its largest document, since sizes
fall along the order.  Copies never exceed ``ceil(target / size)``, so with the
default cap no document exceeds twice its size.

Defined results: null text has size 0; null sources are one source, ordered
last; a source of size 0 gets target 0 and no copies; repeated rows are rows of
their own; an empty table gives an empty mix.  Input columns travel in a struct
and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from podium.llm.common import WORD, by_part, in_order, part_offsets, staged, table, unstage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1"


def sized(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", carry: Sequence[str] | None = None) -> DataFrame:
    """``row`` (struct of the carried columns), ``src``, ``no_src``, ``id`` and ``size`` in words."""
    carry = docs.columns if carry is None else carry
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.col(source).isNull().alias("no_src"),
        F.col(key).alias("id"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sources`` (src, no_src, source_size) with ``target``.

    Weights repeat along the sources in code-point order, null last.  A target
    stops at ``cap`` times the source's size; the excess is shared again by
    weight until no target is above its stop.  Each round is one aggregate over
    the sources that returns three numbers.
    """
    spark = sources.sparkSession
    placed = in_order(sources, [F.col("no_src"), F.col("src")], "sources")
    counts = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    place = F.col("_row") + F.col("_before")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights)).cast("int") + 1)
    ranked = placed.join(by_part(spark, part_offsets(counts), "_before"), "_part").withColumn("weight", weight)
    ranked = staged(ranked.drop("_part", "_row", "_before"), "weights")
    unstage(placed)
    stop = (F.col("source_size") * cap).cast("double")
    total = ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    level = None  # words per unit of weight; None: nothing stopped yet
    while True:
        stopped = F.lit(False) if level is None else stop <= F.col("weight") * F.lit(level)
        got = ranked.agg(
            F.sum(F.when(stopped, F.col("source_size") * cap).otherwise(0)).alias("used"),
            F.sum(F.when(stopped, 0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(stopped, 1)).alias("n"),
        ).first()
        if not got["open"]:
            return ranked.withColumn("target", stop)
        new = (share * total - got["used"]) / got["open"]
        if level is not None and new <= level:
            return ranked.withColumn("target", F.when(stopped, stop).otherwise(F.col("weight") * F.lit(level)))
        level = new


def offset(seed: str = SEED) -> Column:
    """One number in [0, 1) per source, the same in every run."""
    name = F.concat(F.lit(seed), F.when(F.col("no_src"), F.lit(":")).otherwise(F.concat(F.lit(":s"), F.col("src"))))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``row``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` for each row of :func:`sized`."""
    tie = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    placed = in_order(rows, [F.col("no_src"), F.col("src"), F.col("size").desc(), tie, F.col("id")], "mixrows")
    runs = staged(placed.groupBy("no_src", "src", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"), F.sum("size").alias("_size")), "runs")
    sources = targets(runs.groupBy("no_src", "src").agg(F.sum("_size").alias("source_size")), weights, share, cap)
    w = W.partitionBy("no_src", "src").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = runs.select("no_src", "src", "_part", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    known = before.join(sources, ["no_src", "src"])
    out = placed.join(known, ["no_src", "src", "_part"])
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    at = (F.col("_row") - F.col("_first") + F.col("_before")).cast("double")
    copies = (F.floor((at + 1) * rate + offset(seed)) - F.floor(at * rate + offset(seed))).cast("long")
    out = out.withColumn("copies", copies)
    return out.select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    m = mix(sized(docs))
    return m.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(sized(table(spark, sf_dir, "documents"), carry=["doc_id"]))
    return m.select("row.doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)] AS w, 2 * source_size AS stop FROM s
), p AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS wtot,
    coalesce(sum(stop) OVER o, 0) AS used, coalesce(sum(w) OVER o, 0) AS wused FROM r
  WINDOW o AS (ORDER BY stop::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (
  SELECT *, stop::DOUBLE * (wtot - wused) <= w * (total - used) AS full_ FROM p
), l AS (
  SELECT (max(total) - coalesce(sum(stop) FILTER (full_), 0)::DOUBLE) / nullif(sum(w) FILTER (NOT full_), 0) AS level FROM q
), t AS (
  SELECT source, source_size, CASE WHEN full_ THEN stop::DOUBLE ELSE w * level END AS target,
    (('0x' || substr(md5(CASE WHEN source IS NULL THEN '{SEED}:' ELSE '{SEED}:s' || source END), 1, 8))::BIGINT)::DOUBLE / 4294967296::DOUBLE AS u
  FROM q, l
), n AS (
  SELECT doc_id, size, source_size, target, u, CASE WHEN source_size = 0 THEN 0::DOUBLE ELSE target / source_size::DOUBLE END AS rate,
    (row_number() OVER (PARTITION BY d.source ORDER BY size DESC, md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1)::DOUBLE AS at_
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, (floor((at_ + 1) * rate + u) - floor(at_ * rate + u))::BIGINT AS copies FROM n
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""
