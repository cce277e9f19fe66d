"""Merge-style loads of a versioned dimension.

``merge_upsert``  MERGE with two conditional updates and an insert, keeping
                  the action of each row (``UPDATE`` / ``INSERT`` / null).
``merge_legacy``  that merge followed, only when nothing was inserted, by one
                  new row per source key placed against the newest version.

Both keep the target in place: the source (one row per key, checked) is
joined to the target as a broadcast when its size allows, so the target is
scanned but never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schemas import KEY, LEGACY_DIM_COLUMNS
from .joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small

VF, VT = "valid_from_ts", "valid_to_ts"


def _checked_source(source: DataFrame, key: list[str]) -> DataFrame:
    """Source rows with a lazy uniqueness check: a key sent twice fails the job.

    The largest per-key count comes from a partially aggregated count by key
    reduced to one row (no shuffle of the source rows themselves); it is
    cross-joined as a broadcast row and used in a predicate, so the optimizer
    cannot prune the check.
    """
    worst = source.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("_max_n"))
    ok = F.when(F.col("_max_n") > 1, F.raise_error(F.lit("merge source holds a key more than once"))) \
          .otherwise(F.lit(True)).cast("boolean")
    return source.crossJoin(F.broadcast(worst)).where(ok).drop("_max_n")


def _source_defaults(source: DataFrame) -> DataFrame:
    s = source
    if "seen_count" not in s.columns:
        s = s.withColumn("seen_count", F.lit(1))
    if VT not in s.columns:
        s = s.withColumn(VT, F.lit(None).cast("timestamp_ntz"))
    if "is_current" not in s.columns:
        s = s.withColumn("is_current", F.lit(True))
    return s


def _merge_parts(target: DataFrame, source: DataFrame, key: list[str],
                 broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(target rows after the updates, source rows with the newest updated version of their key)``.

    Only the source's keys and starts are broadcast (behind a size check); its
    payload meets one row per key, by a join that the planner chooses.
    ``_newest`` is null where the target has no version of the key.
    """
    key = list(key)
    t = target.select(*LEGACY_DIM_COLUMNS).withColumn("media_duration", F.col("media_duration").cast("int"))
    s = _source_defaults(_checked_source(source, key))
    s = s.select(*key, F.col("media_duration").cast("int").alias("media_duration"), "media_blob",
                 F.col("seen_count").cast("bigint").alias("seen_count"), VF, VT, "is_current")
    sb = broadcast_if_small(s.select(*key, F.col(VF).alias("_s_vf"), F.lit(True).alias("_m")), broadcast_rows)

    def updated(how: str, *payload: str) -> DataFrame:
        matched = F.col("_m").isNotNull()
        close = matched & (F.col("_s_vf") > F.col(VF)) & F.col("is_current")
        bump = matched & ~close & (F.col("_s_vf") <= F.col(VF))
        return t.join(sb, key, how).select(
            *key, *payload,
            F.when(bump, F.col("seen_count") + 1).otherwise(F.col("seen_count")).alias("seen_count"), VF,
            F.when(close, F.col("_s_vf")).otherwise(F.col(VT)).alias(VT),
            F.when(close, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
            "extract_ts",
            F.when(close | bump, F.lit("UPDATE")).alias("merge_action"))

    newest = updated("inner").groupBy(*key).agg(F.max(F.struct(VF, "seen_count")).alias("_newest"))
    return updated("left", "media_duration", "media_blob"), s.join(newest, key, "left")


def merge_upsert(target: DataFrame, source: DataFrame, key: Sequence[str] = KEY, *,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Merge ``source`` (unique per key) into ``target`` (versions per key).

    For every target version of a source key, first matching clause wins:
      * source starts after it and it is current -> closed at the source start, not current;
      * source starts at or before it             -> ``seen_count + 1``;
    source keys absent from the target are inserted (``extract_ts`` null).
    Output: the target's legacy columns plus ``merge_action``.
    """
    merged, sent = _merge_parts(target, source, list(key), broadcast_rows)
    inserts = (sent.where(F.col("_newest").isNull())
               .withColumn("extract_ts", F.lit(None).cast("timestamp_ntz")).withColumn("merge_action", F.lit("INSERT")))
    return merged.unionByName(inserts.select(*merged.columns))


def merge_legacy(target: DataFrame, source: DataFrame, key: Sequence[str] = KEY, *,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The merge above, then -- only when it inserted nothing -- one row per source key:
    against the key's newest version, a newer source becomes the open current
    version (``seen_count + 1``), an older one a closed first version ending
    at that newest start.  Output: legacy dimension columns.
    """
    key = list(key)
    merged, sent = _merge_parts(target, source, key, broadcast_rows)
    # one row: whether some key was new to the target
    any_insert = F.broadcast(sent.agg(F.coalesce(F.max(F.col("_newest").isNull()), F.lit(False)).alias("_any_insert")))
    fresh = F.col("_newest").isNull()
    newer = F.col(VF) > F.col(f"_newest.{VF}")
    added = sent.crossJoin(any_insert).where(fresh | ~F.col("_any_insert")).select(
        *key, "media_duration", "media_blob",
        F.when(fresh, F.col("seen_count")).when(newer, F.col("_newest.seen_count") + 1).otherwise(F.lit(1)).cast("bigint").alias("seen_count"),
        VF,
        F.when(fresh, F.col(VT)).when(newer, F.lit(None).cast("timestamp_ntz")).otherwise(F.col(f"_newest.{VF}")).alias(VT),
        F.when(fresh, F.col("is_current")).otherwise(newer).alias("is_current"),
        F.lit(None).cast("timestamp_ntz").alias("extract_ts"))
    return merged.select(*LEGACY_DIM_COLUMNS).unionByName(added)
