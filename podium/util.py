"""Small shared helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keys(by: Sequence[str] | None, *more: str) -> list[str]:
    """``by`` keys followed by the operator's own keys."""
    return [*(by or []), *more]


def null_safe_join(left, right, on: Sequence[str], how: str = "inner", plain: Sequence[str] = ()):
    """Equi-join on ``on`` where null keys match each other (``<=>``); keys in ``plain`` use ``=``.

    Spark still plans it as an equi-join (hash / sort-merge on the keys), not a
    nested loop; a null-safe key is hashed as ``(coalesce(k, default), isnull(k))``
    (see :func:`partition_keys`).  Output keeps one copy of each key column,
    taken from the left (from either side for a full join).
    """
    from functools import reduce

    l, r = left.alias("__l"), right.alias("__r")

    def eq(k):
        a, b = F.col(f"__l.{k}"), F.col(f"__r.{k}")
        return a == b if k in plain else a.eqNullSafe(b)

    cond = reduce(lambda a, b: a & b, [eq(k) for k in on])
    joined = l.join(r, cond, how)
    if how in ("left_anti", "anti", "left_semi", "semi"):
        return joined.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns])
    rest = [c for c in right.columns if c not in on]
    full = how in ("full", "outer", "full_outer", "fullouter")
    if how in ("right", "right_outer", "rightouter"):
        key = {k: F.col(f"__r.{k}") for k in on}
    elif full:
        key = {k: F.coalesce(F.col(f"__l.{k}"), F.col(f"__r.{k}")) for k in on}
    else:
        key = {k: F.col(f"__l.{k}") for k in on}
    return joined.select(
        *[(key[c] if c in key else F.col(f"__l.{c}")).alias(c) for c in left.columns],
        *[F.col(f"__r.{c}").alias(c) for c in rest],
    )


def partition_keys(df, on: Sequence[str], plain: Sequence[str] = ()) -> list[Column]:
    """Window / repartition keys equal to those Spark hashes for :func:`null_safe_join` on ``on``.

    A window partitioned by these reuses the join's shuffle (same expressions),
    instead of shuffling again on the raw columns.
    """
    from pyspark.sql import types as T

    defaults = {
        T.StringType: "",
        T.DateType: __import__("datetime").date(1970, 1, 1),
        T.BooleanType: False,
    }
    types = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for k in on:
        if k in plain:
            out.append(F.col(k))
            continue
        t = types[k]
        default = defaults.get(type(t), 0)
        out += [F.coalesce(F.col(k), F.lit(default).cast(t)), F.isnull(F.col(k))]
    return out


def _row_bytes(df) -> int:
    """Estimated bytes per row from the schema (JVM default sizes when available)."""
    try:
        return int(df._jdf.schema().defaultSize())
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: rough Python estimate
        return sum(20 if f.dataType.simpleString() == "string" else 8 for f in df.schema.fields)


def broadcast_threshold(spark) -> int:
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for u in sorted(units, key=len, reverse=True):
        if raw.endswith(u):
            return int(float(raw[: -len(u)]) * units[u])
    return int(raw)


def checked_broadcast(df, max_bytes: int | None = None):
    """Materialise a join side once and broadcast it only if its *measured* size is under the limit.

    The side is written as a reliable checkpoint in ``spark.checkpoint.dir``
    (a shared folder on a cluster; this also cuts its lineage), its rows are
    counted from that copy, and ``rows × row width`` is compared with
    ``max_bytes`` (default: ``spark.sql.autoBroadcastJoinThreshold``).  Over
    the limit, or with broadcasting disabled, the side is returned unmarked and
    the join stays a shuffle join.
    """
    from podium.session import checkpoint_dir

    spark = df.sparkSession
    checkpoint_dir(spark)
    limit = broadcast_threshold(spark) if max_bytes is None else max_bytes
    side = df.checkpoint(eager=True)
    if limit <= 0:
        return side
    size = side.count() * _row_bytes(side)
    return F.broadcast(side) if size <= limit else side
