"""Helpers shared by the corpus operators: staging, prefix positions, null-proof columns.

Every staged table goes to a fresh sub-folder of the shared folder named by
``spark.checkpoint.dir`` (:func:`podium.session.scratch_path`), so a lost
executor costs a re-read, never a recomputation of another stage.
"""

from __future__ import annotations

import gc
import io
import os
import zipfile
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import delete_path, scratch_path

#: a word: a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"
#: the white space between words, as a character list for ``translate`` / ``trim``
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: while a list stands here, :func:`staged` notes its paths in it
_noted: list[str] | None = None


@contextmanager
def noting(paths: list[str]):
    """Note the paths staged inside the block, for a caller that knows when they are spent."""
    global _noted
    outer, _noted = _noted, paths
    try:
        yield paths
    finally:
        _noted = outer


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    if _noted is not None:
        _noted.append(path)
    df.write.parquet(path)
    # the driver drops shuffle files only when it collects the plans that refer to them
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables nothing lazy refers to any more."""
    for t in tables:
        path = getattr(t, "_staged_path", None)
        if path:
            delete_path(t.sparkSession, path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, staged, with their place in ``_part`` and ``_row``.

    ``_part`` numbers the range partitions in order and ``_row`` the rows inside
    one from 0, so a global position is ``_row`` plus the counts of all earlier
    parts: a table with one row per part, never a window over all rows.  Keys
    given in ``order`` should end in something unique, so that one hot leading
    key is cut into many ranges.
    """
    placed = in_order_by(df, order).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND((1 << 33) - 1))
    return staged(placed.drop("_at"), name)


def in_order_by(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted; ``parts`` fixes the number of partitions, for rows that stand for much more than their bytes."""
    ranged = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
    return ranged.sortWithinPartitions(*order)


def arrow_uri(path: str) -> str:
    """A qualified Hadoop path as pyarrow's file systems name it; ValueError for a file system they do not have."""
    scheme, colon, rest = path.partition(":")
    known = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "hdfs": "hdfs", "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}
    if not colon or scheme not in known:
        raise ValueError(f"files are written and read by ranges through pyarrow, which cannot open {path!r}; use one of {sorted(known)}")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{known[scheme]}:{rest}"


def task_uri(spark: SparkSession, path: str) -> str:
    """``path`` for tasks that write or read files themselves: in the file system that Spark itself would use for it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return arrow_uri(str(fs.makeQualified(p).toString()))


def part_offsets(sums: dict[int, int]) -> dict[int, int]:
    """The running total before each part; ``sums`` has one number per part (bounded by the number of partitions)."""
    out, total = {}, 0
    for part in sorted(sums):
        out[part] = total
        total += sums[part]
    return out


def by_part(spark: SparkSession, values: dict[int, int], name: str) -> DataFrame:
    """The per-part numbers as a table (one row per partition, so its size is bounded)."""
    rows = ",".join(f"(CAST({k} AS BIGINT), CAST({v} AS BIGINT))" for k, v in values.items())
    if not rows:
        return spark.sql(f"SELECT CAST(0 AS BIGINT) AS _part, CAST(0 AS BIGINT) AS {name} WHERE false")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(_part, {name})")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Column, how: str = "left", salts: int = 16) -> DataFrame:
    """Equi-join whose hot keys are dealt to ``salts`` tasks.

    ``right`` has one row per key and is repeated once per salt; each row of
    ``left`` takes one salt from the hash of ``spread``.
    """
    r = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    l = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return l.join(r, [*on, "_salt"], how).drop("_salt")


_SHIPPED: set[str] = set()


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` after this package was sent to the executors (once per application, by the shared folder)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        path = scratch_path(spark, "corpus-operators") + ".zip"
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p)
        out.write(bytearray(packed.getvalue()))
        out.close()
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return df.mapInArrow(function, schema)
