"""Version chains per key that stay parallel when one key is hot.

A plain ``row_number() / lead() over (partition by key order by t)`` sends
every row of a key to one task.  Here rows are partitioned by (key, time
bucket): ordinals and next values are computed inside each bucket, then a
small per-(key, bucket) summary -- row count and first value -- is turned
into offsets and cross-bucket successors with a window over buckets, and
joined back on (key, bucket).  One shuffle of the rows; only the summary
(one row per key and bucket) moves again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .dedupe import asc

# Bucket of rows whose time is null: after every real bucket (nulls sort last).
LATE_BUCKET = "9999-12-31 00:00:00"


def time_bucket(ts: str | Column, unit: str = "day") -> Column:
    """``date_trunc(unit, ts)``; null times fall into a last, separate bucket."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_trunc(unit, c).cast("timestamp_ntz"), F.lit(LATE_BUCKET).cast("timestamp_ntz"))


def chain_links(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], value: str,
                bucket: str, *, include: Column | None = None, seen: str = "_seen", nxt: str = "_next",
                partitioned: bool = False, carry: Sequence[str] = (), summary: DataFrame | None = None) -> DataFrame:
    """Add ``seen`` (bigint row number) and ``nxt`` (next row's ``value``) per ``key``.

    ``order`` must start with ``value`` ascending (nulls last) and ``bucket``
    must not decrease along it (e.g. ``time_bucket``, ``borders.part_of``),
    so bucket order agrees with row order.  A null key is a chain of its own.  Only rows
    where ``include`` holds form the chains (others get values to ignore).
    With ``partitioned=True`` the caller has already hash-partitioned ``df``
    on (key, bucket) and no exchange of the rows is added here.  Each column
    in ``carry`` also gets its next row's value as ``next_<col>`` (``order``
    must then be plain ascending, non-null column names).  A caller that knows a
    cheaper way to the ``_n`` included rows and the ``_first`` value of each (key,
    bucket) passes it as ``summary`` (without ``carry``).
    """
    key = list(key)
    kb = [*key, bucket]
    rows = df if partitioned else df.repartition(*kb)
    inc = F.lit(True) if include is None else include
    rows = rows.withColumn("_in", inc)
    order_c = [asc(o) if isinstance(o, str) else o for o in order]
    wl = W.partitionBy(*kb, "_in").orderBy(*order_c)
    local = rows.select("*", F.row_number().over(wl).alias("_rn_l"), F.lead(value).over(wl).alias("_nx_l"),
                        F.lead(F.lit(True)).over(wl).alias("_has_nx"),
                        *[F.lead(c).over(wl).alias(f"_nx_{c}") for c in carry])
    if summary is None:
        first_aggs = [F.min(F.when(F.col("_in"), F.col(value))).alias("_first")]
        if carry:
            ordkey = F.when(F.col("_in"), F.struct(*[F.col(o) for o in order]))
            first_aggs.append(F.min_by(F.struct(*[F.col(c) for c in carry]), ordkey).alias("_first_carry"))
        summary = rows.groupBy(*kb).agg(F.count(F.when(F.col("_in"), F.lit(1))).alias("_n"), *first_aggs)
    summ = summary
    wk = W.partitionBy(*key).orderBy(asc(bucket))
    after = wk.rowsBetween(1, W.unboundedFollowing)
    summ = summ.select(
        *kb,
        F.coalesce(F.sum("_n").over(wk.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.first("_first", ignorenulls=True).over(after).alias("_next_first"),
        *([F.first("_first_carry", ignorenulls=True).over(after).alias("_next_carry")] if carry else []))
    side = summ.select(*[F.col(c).alias(f"_s_{c}") for c in kb], *[c for c in summ.columns if c not in kb])
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in kb]  # a null key is a key like any other
    out = local.join(side, same, "inner").drop(*[f"_s_{c}" for c in kb])
    in_bucket = F.col("_has_nx").isNotNull()
    cols = {seen: (F.col("_off") + F.col("_rn_l")).cast("bigint"),
            nxt: F.when(in_bucket, F.col("_nx_l")).otherwise(F.col("_next_first"))}
    for c in carry:
        cols[f"next_{c}"] = F.when(in_bucket, F.col(f"_nx_{c}")).otherwise(F.col(f"_next_carry.{c}"))
    drop = ["_rn_l", "_nx_l", "_has_nx", "_off", "_next_first", "_in", *[f"_nx_{c}" for c in carry]]
    if carry:
        drop.append("_next_carry")
    return out.withColumns(cols).drop(*drop)
