"""Incremental source batches: keep only rows outside the time range already loaded.

The range of the target is a one-row aggregate (min/max of its start times)
joined to the input as a broadcast, so no data row is collected to the driver.
Note this is not a watermark: rows *older* than the loaded range are admitted
too (backfill), only rows inside it are dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import lit_ts, minus_years, plus_days, utc_to_eastern
from .flatten import flatten_chat, media_fields


def seen_range(target: DataFrame, ts_col: str = "valid_from_ts") -> DataFrame:
    """One row: ``_seen_lo``, ``_seen_hi`` (nulls when the target is empty)."""
    return target.agg(F.min(ts_col).alias("_seen_lo"), F.max(ts_col).alias("_seen_hi"))


def outside_seen_range(df: DataFrame, ts: Column | str, target: DataFrame | None, run_ts: dt.datetime,
                       target_ts: str = "valid_from_ts", known_range: tuple | None = None) -> DataFrame:
    """Rows with ``ts < min(target)`` or ``ts > max(target)``.

    Strict on both sides (boundary rows are inside).  An empty target admits
    every non-null ``ts`` through the fallbacks ``run_ts + 1 day`` and
    ``run_ts - 99 years``; a null ``ts`` never passes.  ``known_range``
    ``(min, max)`` -- e.g. recorded when the target was published -- replaces
    the scan of the target by two literals.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    run = lit_ts(run_ts)
    if known_range is not None:
        lo_v, hi_v = known_range
        lo = F.lit(lo_v).cast("timestamp_ntz") if lo_v is not None else plus_days(run, 1)
        hi = F.lit(hi_v).cast("timestamp_ntz") if hi_v is not None else minus_years(run, 99)
        return df.where((t < lo) | (t > hi))
    bounds = F.broadcast(seen_range(target, target_ts))
    lo = F.coalesce(F.col("_seen_lo"), plus_days(run, 1))
    hi = F.coalesce(F.col("_seen_hi"), minus_years(run, 99))
    return df.crossJoin(bounds).where((t < lo) | (t > hi)).drop("_seen_lo", "_seen_hi")


def future_guard(df: DataFrame, ts: Column | str, run_ts: dt.datetime, days: int = 1) -> DataFrame:
    """Drop rows dated after ``run_ts + days``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return df.where(t <= plus_days(lit_ts(run_ts), days))


def build_source_batch(chat: DataFrame, dim: DataFrame, run_ts: dt.datetime, *,
                       guard_days: int | None = None, created: str = "created_ts",
                       author: str = "fromUser.id", media: str = "media",
                       chat_id: str = "chat_id", extract_ts: Column | None = None,
                       known_range: tuple | None = None) -> DataFrame:
    """Staging chat messages -> distinct source-batch rows for the dimension.

    Messages outside the dimension's loaded range (optionally not in the
    future) are flattened to one row per media element; id and duration come
    from one parse of the element text.  The load stamp defaults to the run
    time shown as US/Eastern wall clock.  ``known_range`` is the dimension's
    (min, max) start when already known (no scan of the dimension then).
    """
    created_ts = F.col(created).cast("timestamp_ntz")
    msgs = chat.withColumn("_created", created_ts)
    if guard_days is not None:
        msgs = future_guard(msgs, "_created", run_ts, guard_days)
    msgs = outside_seen_range(msgs, "_created", dim, run_ts, known_range=known_range)
    flat = flatten_chat(msgs, chat_id=chat_id, author=author, media=media, created="_created")
    rows = media_fields(flat)
    stamp = extract_ts if extract_ts is not None else utc_to_eastern(lit_ts(run_ts))
    # distinct over the varying columns only; the constant ones are added after it
    rows = rows.select("author_id", "media_id", "media_duration", "media_blob",
                       F.col("created_ts").alias("valid_from_ts")).distinct()
    return rows.select(
        "author_id", "media_id", "media_duration", "media_blob",
        F.lit(1).alias("seen_count"), "valid_from_ts",
        F.lit(None).cast("timestamp_ntz").alias("valid_to_ts"), F.lit(True).alias("is_current"),
        stamp.alias("extract_ts"),
    )
