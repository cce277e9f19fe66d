"""Flat reports over the dimension: first versions, changed versions, point lookup, sample row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .dedupe import asc

REPORT_COLUMNS = ["author_id", "media_id", "seen_count", "media_duration", "valid_from_ts",
                  "valid_to_ts", "is_current", "is_deleted"]
REPORT_ORDER = ["author_id", "media_id", "valid_from_ts", "seen_count"]


def _videos(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("media_duration") > 0).select(*REPORT_COLUMNS)


def first_versions(dim: DataFrame, sort: bool = True) -> DataFrame:
    """Videos at their first version (``seen_count = 1``)."""
    out = _videos(dim).where(F.col("seen_count") == 1)
    return out.orderBy(*[asc(c) for c in REPORT_ORDER]) if sort else out


def changed_versions(dim: DataFrame, sort: bool = True) -> DataFrame:
    """Videos that changed: a later version, or no longer current."""
    out = _videos(dim).where((F.col("seen_count") > 1) | ~F.col("is_current"))
    return out.orderBy(*[asc(c) for c in REPORT_ORDER]) if sort else out


def point_lookup(dim: DataFrame, media_id, valid_from: Column) -> DataFrame:
    """Rows of one media version; both predicates reach the parquet scan as filters
    when given as literals."""
    return dim.where((F.col("media_id") == F.lit(media_id)) & (F.col("valid_from_ts") == valid_from))


def sample_row(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row by ``order`` (a top-1, not a full sort)."""
    return df.orderBy(*[asc(c) for c in order]).limit(1)
