"""Audits: row counts, distinct ids, grain, grain offenders, two-way parity.

Every audit is a lazy aggregate (one row or a small report), so it can be
written or joined like any other result; none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..schemas import KEY
from .chains import time_bucket
from .dedupe import asc

GRAIN = ("media_id", "author_id", "valid_from_ts")


def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    """``count(1) as cnt`` (with the table name when given)."""
    out = df.agg(F.count(F.lit(1)).alias("cnt"))
    return out if name is None else out.select(F.lit(name).alias("table_name"), "cnt")


def distinct_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Rows and exact distinct non-null ids."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(id_col).alias("n_ids"))


def grain(df: DataFrame, cols: Sequence[str] = GRAIN) -> DataFrame:
    """Rows and distinct grain tuples; a tuple with null parts still counts once."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(F.struct(*[F.col(c) for c in cols])).alias("n_grain"))


def grain_offenders(df: DataFrame, cols: Sequence[str] = GRAIN) -> DataFrame:
    """Grain tuples held by more than one row, with their row count."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def parity(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Set differences both ways over an explicit shared column list (one row):
    ``count(a EXCEPT b)`` and ``count(b EXCEPT a)``.

    Both inputs are tagged, unioned and grouped by all columns once (nulls
    group together, as set operations compare them); a distinct row seen
    only on one side counts for that side.  Each input is computed once and
    the grouping combines map-side.
    """
    cols = list(columns)
    u = (a.select(*cols, F.lit(True).alias("_in_a"), F.lit(False).alias("_in_b"))
          .unionByName(b.select(*cols, F.lit(False).alias("_in_a"), F.lit(True).alias("_in_b"))))
    rows = u.groupBy(*cols).agg(F.max("_in_a").alias("_a"), F.max("_in_b").alias("_b"))
    return rows.agg(F.count(F.when(F.col("_a") & ~F.col("_b"), F.lit(1))).alias("a_minus_b"),
                    F.count(F.when(F.col("_b") & ~F.col("_a"), F.lit(1))).alias("b_minus_a"))


def intervals(dim: DataFrame, key: Sequence[str] = KEY, *, bucket_unit: str = "day") -> DataFrame:
    """Keys whose versions do not form one chain, a row each; an empty report is a clean dimension.

    ``n_versions, n_current, n_deleted``; ``n_gaps``: versions that start after
    every earlier one has ended; ``n_overlaps``: versions that start before one
    that started earlier has ended (of two that start at once the later to
    end comes second); ``issue``: ``no current`` (a live version but none current),
    ``several current``, ``gap``, ``overlap``, joined by commas.

    How far the earlier versions of a key reach is a running maximum inside
    (key, time slice), carried across slices by a summary of one row each, so a
    hot key is checked by many tasks.  An open end reaches past everything.
    """
    key = list(key)
    names = [f"_k{i}" for i in range(len(key))]
    open_end = F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz")
    rows = dim.select(*[F.col(k).alias(n) for k, n in zip(key, names)], F.col("valid_from_ts").alias("_from"),
                      F.coalesce("valid_to_ts", open_end).alias("_until"), F.coalesce("is_current", F.lit(False)).alias("_current"),
                      (F.coalesce(F.col("is_deleted"), F.lit(False)) if "is_deleted" in dim.columns else F.lit(False)).alias("_deleted"))
    rows = rows.withColumn("_slice", time_bucket("_from", bucket_unit)).repartition(*names, "_slice")
    order = W.partitionBy(*names, "_slice").orderBy(asc("_from"), asc("_until"))
    reach = F.max("_until").over(order.rowsBetween(W.unboundedPreceding, -1))
    before = F.max("_far").over(W.partitionBy(*names).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1))
    summary = rows.groupBy(*names, "_slice").agg(F.max("_until").alias("_far")).withColumn("_before", before)
    side = summary.select(*[F.col(n).alias(f"_s{n}") for n in names], F.col("_slice").alias("_s_slice"), "_before")
    same = [F.col(n).eqNullSafe(F.col(f"_s{n}")) for n in names] + [F.col("_slice") == F.col("_s_slice")]
    met = rows.withColumn("_reach", reach).join(side, same).withColumn("_ended", F.greatest("_reach", "_before"))

    def times(cond):
        return F.count(F.when(cond, 1))

    report = met.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_versions"), times(F.col("_current")).alias("n_current"), times(F.col("_deleted")).alias("n_deleted"),
        times(F.col("_from") > F.col("_ended")).alias("n_gaps"), times(F.col("_from") < F.col("_ended")).alias("n_overlaps"))
    found = {"no current": (F.col("n_current") == 0) & (F.col("n_deleted") < F.col("n_versions")), "several current": F.col("n_current") > 1,
             "gap": F.col("n_gaps") > 0, "overlap": F.col("n_overlaps") > 0}
    issue = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in found.items()])
    return (report.withColumn("issue", issue).where("issue != ''")
            .select(*[F.col(n).alias(k) for k, n in zip(key, names)], "n_versions", "n_current", "n_deleted", "n_gaps", "n_overlaps", "issue"))
