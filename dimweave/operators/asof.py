"""Point-in-time reads with a time of their own per row.

``as_of_join`` gives every fact row the version of its key that was valid at
the fact's time.  It is an as-of join without pairs: versions and facts are
unioned and hash-partitioned by (key, time slice); inside a slice the last
version started so far is carried down the time order, and the version that
is open when a slice begins comes from a summary of one row per (key, slice).
A key with a third of all facts is spread over as many tasks as it has slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..schemas import KEY
from .chains import time_bucket
from .dedupe import asc

VF, VT = "valid_from_ts", "valid_to_ts"
_OPEN = "9999-12-31 23:59:59.999999"


def as_of_join(facts: DataFrame, dim: DataFrame, *, fact_ts: str, key: Sequence[str] = KEY,
               columns: Sequence[str] | None = None, prefix: str = "", how: str = "left",
               include_deleted: bool = False, bucket_unit: str = "day") -> DataFrame:
    """``facts`` with the ``columns`` of the version valid at ``fact_ts`` (``start <= t < end``; an open end is still valid).

    ``columns`` default to all of ``dim`` but the key; ``prefix`` is put before
    their names.  ``how='left'`` keeps facts without a version (nulls),
    ``'inner'`` drops them.  Facts with a null key part or time match nothing,
    and versions with a null key or start are met by no fact.  Deleted versions are left out
    first unless asked for.  Should versions of a key overlap, the one that
    started last counts (then the one that ends last).  Repeated facts stay
    repeated.  ``bucket_unit`` is the time slice that spreads one key.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    key = list(key)
    columns = [c for c in dim.columns if c not in key] if columns is None else list(columns)
    clash = {prefix + c for c in columns} & set(facts.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}; pass a prefix")
    versions = dim
    if not include_deleted and "is_deleted" in dim.columns:
        versions = versions.where(~F.coalesce(F.col("is_deleted"), F.lit(False)))
    whole = F.col(VF).isNotNull()
    for k in key:
        whole = whole & F.col(k).isNotNull()
    names = [f"_k{i}" for i in range(len(key))]
    key_of = [F.col(k).alias(n) for k, n in zip(key, names)]
    version = F.struct(F.col(VF).alias("_from"), F.coalesce(F.col(VT), F.lit(_OPEN).cast("timestamp_ntz")).alias("_until"),
                       F.col(VT).isNull().alias("_open"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    vs = versions.where(whole).select(*key_of, F.col(VF).alias("_t"), F.lit(0).alias("_side"), version.alias("_version"))
    fs = facts.select(*key_of, F.col(fact_ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"),
                      F.struct(*facts.columns).alias("_fact"))
    rows = (vs.unionByName(fs, allowMissingColumns=True).withColumn("_slice", time_bucket("_t", bucket_unit))
              .repartition(*names, "_slice"))

    order = W.partitionBy(*names, "_slice").orderBy(asc("_t"), asc("_side"), asc(F.col("_version._until")))
    seen = F.last("_version", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    latest = F.max_by("_version", F.when(F.col("_side") == 0, F.struct("_version._from", "_version._until")))
    summary = rows.groupBy(*names, "_slice").agg(latest.alias("_last"))
    before = F.last("_last", ignorenulls=True).over(W.partitionBy(*names).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    summary = summary.select(*[F.col(n).alias(f"_s{n}") for n in names], F.col("_slice").alias("_s_slice"), before.alias("_before"))
    same = [F.col(n).eqNullSafe(F.col(f"_s{n}")) for n in names] + [F.col("_slice") == F.col("_s_slice")]
    met = rows.select("*", seen.alias("_seen")).where(F.col("_side") == 1).join(summary, same)
    found = F.coalesce("_seen", "_before")
    valid = F.col("_t").isNotNull() & (F.col("_t") >= F.col("_found._from")) & (F.col("_found._open") | (F.col("_t") < F.col("_found._until")))
    for n in names:
        valid = valid & F.col(n).isNotNull()
    met = met.withColumn("_found", found).withColumn("_valid", F.coalesce(valid, F.lit(False)))
    if how == "inner":
        met = met.where("_valid")
    return met.select(*[F.col(f"_fact.`{c}`") for c in facts.columns],
                      *[F.when(F.col("_valid"), F.col(f"_found.c{i}")).alias(prefix + c) for i, c in enumerate(columns)])


__all__ = ["as_of_join"]
