"""Join helpers: size-checked broadcast, anti/semi, existence flags, merge-style lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rows and bytes a side may hold to be broadcast, well below the executor
# memory a broadcast relation may take.
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 << 20


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts by their length, nested values by their JSON, the rest by a word each."""
    parts = [F.lit(16 * (len(df.columns) + 1)).cast("bigint")]
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"))
        elif "<" in kind:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)).cast("bigint"))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       known_max: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its rows are proven under ``max_rows`` and its bytes under ``BROADCAST_BYTES``.

    ``known_max`` is an upper bound of the rows that the caller already holds
    (e.g. of the batch the keys come from, read from a commit log); it spares
    the job for a frame without texts of any length.  Otherwise one job over
    ``df`` alone counts both (callers pass
    small frames such as distinct batch keys).  Above a bound the frame is
    returned as is and the planner falls back to a shuffle join.
    """
    if known_max is not None and known_max > max_rows:
        return df
    if known_max is not None and not any(k in ("string", "binary") or "<" in k for _, k in df.dtypes):
        return F.broadcast(df)
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= BROADCAST_BYTES else df


def anti_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``NOT EXISTS (.. right.k = left.k ..)``: a null key never matches, so it survives."""
    return left.join(right.select(*on).distinct(), on=on, how="left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on=on, how="left_semi")


def existence_flag(left: DataFrame, right: DataFrame, on: list[str], name: str) -> DataFrame:
    """Add boolean ``name`` = a row with equal non-null ``on`` exists in ``right``.

    Written as a left join to the distinct key set of ``right`` with a marker
    column, so there is no fan-out.
    """
    marks = right.select(*on).distinct().withColumn(name, F.lit(True))
    return (left.join(marks, on=on, how="left")
                .withColumn(name, F.coalesce(F.col(name), F.lit(False))))


def split_by_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``keys``, rows whose key is not) from one left join.

    ``keys`` must be distinct.  Both halves come from the same join, so when
    ``keys`` is too large to broadcast the big side is shuffled once (the
    exchange is reused by the second half) rather than once per half.
    A null key is never matched, as in ``NOT EXISTS``.
    """
    flagged = df.join(keys.select(*on).withColumn("_in_keys", F.lit(True)), on=on, how="left")
    hit = F.coalesce(F.col("_in_keys"), F.lit(False))
    return flagged.where(hit).drop("_in_keys"), flagged.where(~hit).drop("_in_keys")


def with_group_aggregates(df: DataFrame, by: list[str], aggs: dict) -> DataFrame:
    """Attach whole-group aggregates to every row (``agg() over (partition by ..)``).

    Written as an aggregate joined back on the group key instead of a window:
    the aggregate combines map-side, and the join is an ordinary equi-join
    that AQE splits when one group is hot, so no group is funnelled through a
    single task.  Groups compare null-safely, as window partitions do.
    """
    totals = df.groupBy(*by).agg(*[e.alias(n) for n, e in aggs.items()])
    renamed = totals.select(*[F.col(c).alias(f"_g_{c}") for c in by], *aggs.keys())
    cond = [df[c].eqNullSafe(renamed[f"_g_{c}"]) for c in by]
    return df.join(renamed, cond, "left").drop(*[f"_g_{c}" for c in by])
