"""Input views over the driver's tables (``events``), as DataFrames.

They shape ``events`` into chat messages, wall posts and dimension versions so
every operator runs on data whose size grows with the tables.  The same views
exist as DuckDB SQL in ``plans/oracle_views.py``; both must return identical rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

TS = dt.datetime


def ts_lit(s: str):
    return F.lit(TS.fromisoformat(s)).cast("timestamp_ntz")


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (the DataFrame object is reused per session, so
    its files are listed and its footers read once; no data is cached)."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _TABLES[key]


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k")


def v_chat(spark, sf_dir) -> DataFrame:
    """Chat messages: null, empty, one- and two-element media; missing duration."""
    e = events(spark, sf_dir)
    one = F.concat(F.lit('{"id":'), (F.col("event_id") % 97).cast("string"),
                   F.lit(',"duration":'), _k(), F.lit("}"))
    two = F.concat(F.lit('{"id":'), (F.col("event_id") % 89 + 1000).cast("string"), F.lit("}"))
    media = (F.when(F.col("event_type") == "error", F.array().cast("array<string>"))
             .when(F.col("event_type") == "signup", F.lit(None).cast("array<string>"))
             .when(F.col("event_type") == "purchase", F.array(one, two))
             .otherwise(F.array(one)))
    return e.select(
        F.col("event_id").alias("chat_id"),
        F.struct(F.col("user_id").cast("string").alias("id")).alias("fromUser"),
        media.alias("media"),
        F.col("value").alias("price"),
        F.col("ts").alias("created_ts"),
    )


def v_wall(spark, sf_dir) -> DataFrame:
    """Wall media: ids not monotone in time, several rows per posting minute."""
    e = events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    eid = F.col("event_id")
    return e.select(
        (F.col("user_id") % 10).cast("string").alias("author_id"),
        eid.alias("post_id"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("posted_ts"),
        (F.lit(4000000000).cast("bigint") + eid * 10 + (eid * 37) % 23 - 11).alias("media_id"),
    )


def v_ochat(spark, sf_dir) -> DataFrame:
    """Chat media for the origin-date query (20 consecutive events form a message)."""
    e = events(spark, sf_dir).where(F.col("event_type") == "purchase")
    eid = F.col("event_id")
    chat = eid - eid % 20
    return e.select(
        chat.alias("chat_id"),
        (chat % 7).cast("string").alias("author_id"),
        (F.lit(4000000000).cast("bigint") + (eid - eid % 3) * 10).alias("media_id"),
        F.col("value").alias("msg_price"),
        _k().cast("int").alias("media_duration"),
        F.col("ts").alias("created_ts"),
    )


def v_versions(spark, sf_dir) -> DataFrame:
    """One row per (author, media, time) with payload and checksum."""
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("author_id"),
        F.col("event_type").alias("media_id"),
        _k().cast("int").alias("media_duration"),
        F.col("props").alias("media_blob"),
        F.col("ts").alias("valid_from_ts"),
        F.md5("props").alias("checksum"),
    )


def v_dim(spark, sf_dir) -> DataFrame:
    """Dimension holding 2024-01-08..21, one author in ten flagged deleted."""
    v = v_versions(spark, sf_dir).where(
        (F.col("valid_from_ts") >= ts_lit("2024-01-08 00:00:00"))
        & (F.col("valid_from_ts") < ts_lit("2024-01-22 00:00:00")))
    # test-data construction (a stored dimension in production), written as FIXTURES.md states it
    w = W.partitionBy("author_id", "media_id").orderBy("valid_from_ts")
    z = (v.withColumn("seen_count", F.row_number().over(w).cast("bigint"))
          .withColumn("valid_to_ts", F.lead("valid_from_ts").over(w)))
    deleted = F.col("author_id").cast("int") % 10 == 3
    cut = ts_lit("2024-02-01 00:00:00")
    return z.select(
        "author_id", "media_id", "media_duration", "media_blob", "seen_count", "valid_from_ts",
        F.when(deleted, F.coalesce("valid_to_ts", cut)).otherwise(F.col("valid_to_ts")).alias("valid_to_ts"),
        deleted.alias("is_deleted"),
        (F.col("valid_to_ts").isNull() & ~deleted).alias("is_current"),
        cut.alias("extract_ts"),
        "checksum",
    )


def _batch(v: DataFrame) -> DataFrame:
    return v.withColumn("extract_ts", ts_lit("2024-03-01 00:00:00"))


def v_daily(spark, sf_dir) -> DataFrame:
    """Batch newer than the dimension."""
    return _batch(v_versions(spark, sf_dir).where(F.col("valid_from_ts") >= ts_lit("2024-01-22 00:00:00")))


def v_backfill(spark, sf_dir) -> DataFrame:
    """Batch older than the dimension."""
    return _batch(v_versions(spark, sf_dir).where(F.col("valid_from_ts") < ts_lit("2024-01-08 00:00:00")))


def v_rescrape(spark, sf_dir) -> DataFrame:
    """Batch with exact matches, deleted matches, absent keys and new versions."""
    vf = F.col("valid_from_ts")
    a = F.col("author_id").cast("int")
    cond = (((vf >= ts_lit("2024-01-10 00:00:00")) & (vf < ts_lit("2024-01-20 00:00:00"))
             & (a % 10 != 7) & (a % 20 != 13))
            | ((vf >= ts_lit("2024-01-22 00:00:00")) & (a % 10).isin(1, 2)))
    return _batch(v_versions(spark, sf_dir).where(cond))


def v_merge_src(spark, sf_dir) -> DataFrame:
    """Key-unique batch for merge: newer for some authors, older for others."""
    vf = F.col("valid_from_ts")
    a = F.col("author_id").cast("int")
    cond = (((vf >= ts_lit("2024-01-22 00:00:00")) & (a % 10).isin(1, 2, 6))
            | ((vf < ts_lit("2024-01-08 00:00:00")) & (a % 10).isin(4, 5)))
    w = W.partitionBy("author_id", "media_id").orderBy("valid_from_ts")
    z = v_versions(spark, sf_dir).where(cond).withColumn("rn", F.row_number().over(w))
    return z.where("rn = 1").select("author_id", "media_id", "media_duration", "media_blob", "valid_from_ts")


VIEWS = {
    "v_chat": v_chat, "v_wall": v_wall, "v_ochat": v_ochat, "v_versions": v_versions,
    "v_dim": v_dim, "v_daily": v_daily, "v_backfill": v_backfill, "v_rescrape": v_rescrape,
    "v_merge_src": v_merge_src,
}
