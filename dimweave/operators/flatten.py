"""Flatten nested chat messages and wall posts to one row per media item."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.json import extract_typed, multi_extract
from .joins import with_group_aggregates


def _ts(df: DataFrame, col: str):
    return F.col(col).cast("timestamp_ntz")


def flatten_chat(chat: DataFrame, *, chat_id: str = "chat_id", author: str = "fromUser.id",
                 media: str = "media", created: str = "created_ts", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per media element of each message (null or empty media: no row).

    Columns: ``chat_id, author_id, media_blob, created_ts`` plus ``keep``.
    ``explode`` (not ``explode_outer``) drops messages without media.
    """
    return chat.select(
        F.col(chat_id).alias("chat_id"), F.col(author).cast("string").alias("author_id"),
        *[F.col(k) for k in keep], _ts(chat, created).alias("created_ts"),
        F.explode(F.col(media)).alias("media_blob"))


def flatten_chat_videos(chat: DataFrame, **kw) -> DataFrame:
    """Chat media with price, typed id/duration and date; videos only (duration > 0).

    Both fields come from a single explode and a single parse of each element,
    so they stay in lockstep.
    """
    price = kw.pop("price", "price")
    flat = flatten_chat(chat, keep=(price,), **kw)
    parsed = flat.withColumn("_j", multi_extract("media_blob", "id", "duration"))
    out = parsed.select(
        "chat_id", "author_id", F.col("_j.id").alias("media_id"), F.col(price).alias("msg_price"),
        F.col("_j.duration").cast("int").alias("media_duration"),
        F.to_date("created_ts").alias("created_date"))
    return out.where(F.col("media_duration") > 0)


def flatten_wall(wall: DataFrame, *, post_id: str = "id", author: str = "author.id",
                 media: str = "media", posted: str = "postedAt") -> DataFrame:
    """One row per wall-post media: ``author_id, post_id, media_id, posted_ts, posted_date``."""
    flat = wall.select(
        F.col(author).cast("string").alias("author_id"), F.col(post_id).alias("post_id"),
        _ts(wall, posted).alias("posted_ts"), F.explode(F.col(media)).alias("_m"))
    return flat.select(
        "author_id", "post_id", extract_typed("_m", "$.id", "bigint").alias("media_id"),
        "posted_ts", F.to_date("posted_ts").alias("posted_date"))


def media_fields(flat: DataFrame, blob: str = "media_blob") -> DataFrame:
    """Add ``media_id`` and ``media_duration`` as text from one parse of the blob."""
    j = multi_extract(blob, "id", "duration")
    return (flat.withColumn("_j", j)
                .withColumn("media_id", F.col("_j.id"))
                .withColumn("media_duration", F.col("_j.duration"))
                .drop("_j"))


def typed_media_fields(flat: DataFrame, blob: str = "media_blob") -> DataFrame:
    """``media_id`` as bigint and ``media_duration`` as int (strict casts)."""
    return (flat.withColumn("media_id", extract_typed(blob, "$.id", "bigint"))
                .withColumn("media_duration", extract_typed(blob, "$.duration", "int")))


def message_total(flat: DataFrame, duration: str = "media_duration", by: str = "chat_id",
                  out: str = "tot_duration_per_msg") -> DataFrame:
    """Sum of ``coalesce(duration, 0)`` over each message, on every media row.

    Same result as ``sum(..) over (partition by message)``, computed as a
    partially aggregated total joined back, so a message with a huge share
    of the rows does not sit in one task.
    """
    total = F.sum(F.coalesce(F.col(duration), F.lit(0))).cast("bigint")
    return with_group_aggregates(flat, [by], {out: total})
