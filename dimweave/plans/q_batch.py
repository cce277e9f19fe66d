"""Registered queries: flattening, JSON, time functions, incremental filters, windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import time as tf
from ..functions.numeric import round_ratio
from ..operators import flatten as fl, incremental as inc, scd2
from ..operators.chains import chain_links, time_bucket
from ..operators.dedupe import last_value_default_frame
from ..operators.joins import with_group_aggregates
from . import fixtures as fx
from .oracle_views import with_views
from .registry import query

RUN_TS = dt.datetime(2024, 1, 25)

FLAT_CHAT = {"flat_chat": """
select chat_id, fromUser.id as author_id, price, created_ts, unnest(media) as media_blob from v_chat"""}


@query("flatten_chat", with_views("select * from flat_chat", FLAT_CHAT))
def flatten_chat(spark, sf):
    return fl.flatten_chat(fx.v_chat(spark, sf), keep=("price",))


@query("flatten_chat_videos", with_views("""
select chat_id, author_id, json_extract_string(media_blob, '$.id') as media_id, price as msg_price,
       cast(json_extract_string(media_blob, '$.duration') as int) as media_duration,
       cast(created_ts as date) as created_date
from flat_chat where cast(json_extract_string(media_blob, '$.duration') as int) > 0""", FLAT_CHAT))
def flatten_chat_videos(spark, sf):
    return fl.flatten_chat_videos(fx.v_chat(spark, sf))


def nested_wall(spark, sf):
    """Wall posts re-nested as staging pages would hold them (author struct, media array)."""
    w = fx.v_wall(spark, sf)
    return w.select(
        F.col("post_id").alias("id"), F.struct(F.col("author_id").alias("id")).alias("author"),
        F.array(F.concat(F.lit('{"id":'), F.col("media_id").cast("string"), F.lit("}"))).alias("media"),
        F.date_format("posted_ts", "yyyy-MM-dd HH:mm:ss").alias("postedAt"))


@query("flatten_wall", with_views("""
select author_id, post_id, media_id, posted_ts, cast(posted_ts as date) as posted_date from v_wall"""))
def flatten_wall(spark, sf):
    return fl.flatten_wall(nested_wall(spark, sf))


@query("json_multi_extract", with_views("""
select chat_id, media_blob, json_extract_string(media_blob, '$.id') as media_id,
       json_extract_string(media_blob, '$.duration') as media_duration from flat_chat""", FLAT_CHAT))
def json_multi_extract(spark, sf):
    flat = fl.flatten_chat(fx.v_chat(spark, sf))
    return fl.media_fields(flat).select("chat_id", "media_blob", "media_id", "media_duration")


@query("json_extract_typed", with_views("""
select chat_id, media_blob, cast(json_extract_string(media_blob, '$.id') as bigint) as media_id,
       cast(json_extract_string(media_blob, '$.duration') as int) as media_duration from flat_chat""", FLAT_CHAT))
def json_extract_typed(spark, sf):
    flat = fl.flatten_chat(fx.v_chat(spark, sf))
    return fl.typed_media_fields(flat).select("chat_id", "media_blob", "media_id", "media_duration")


@query("window_message_total", with_views("""
select chat_id, media_blob, cast(json_extract_string(media_blob, '$.duration') as int) as media_duration,
       cast(sum(coalesce(cast(json_extract_string(media_blob, '$.duration') as int), 0))
            over (partition by chat_id) as bigint) as tot_duration_per_msg
from flat_chat""", FLAT_CHAT))
def window_message_total(spark, sf):
    flat = fl.typed_media_fields(fl.flatten_chat(fx.v_chat(spark, sf)))
    return fl.message_total(flat).select("chat_id", "media_blob", "media_duration", "tot_duration_per_msg")


@query("round_ratio", with_views("""
select chat_id, media_id, media_duration,
       round(media_duration * 1.0 / nullif(sum(coalesce(media_duration, 0)) over (partition by chat_id), 0), 2)
         as duration_ratio
from v_ochat"""))
def round_ratio_q(spark, sf):
    o = fl.message_total(fx.v_ochat(spark, sf), out="_tot")
    return o.select("chat_id", "media_id", "media_duration",
                    round_ratio(F.col("media_duration"), F.col("_tot")).alias("duration_ratio"))


@query("checksum_md5", with_views("""
select author_id, media_id, valid_from_ts, media_blob, md5(media_blob) as checksum from v_versions"""))
def checksum_md5(spark, sf):
    r = fx.v_versions(spark, sf).select("author_id", "media_id", "valid_from_ts", "media_blob")
    return scd2.add_checksum(r)


@query("cast_naive_ts", with_views("""
select event_id, cast(strftime(ts, '%Y-%m-%d %H:%M:%S.%f') ||
                      case when event_type in ('view', 'click') then '+05:00' else '' end as timestamp) as parsed_ts
from events"""))
def cast_naive_ts(spark, sf):
    e = fx.events(spark, sf)
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                    F.when(F.col("event_type").isin("view", "click"), F.lit("+05:00")).otherwise(F.lit("")))
    return e.select("event_id", tf.naive_ts(text).alias("parsed_ts"))


@query("tz_utc_to_eastern", with_views("""
select event_id, cast((ts at time zone 'UTC') at time zone 'US/Eastern' as timestamp) as eastern_ts from events"""))
def tz_utc_to_eastern(spark, sf):
    return fx.events(spark, sf).select("event_id", tf.utc_to_eastern("ts").alias("eastern_ts"))


@query("tz_zoned_reinterpret", with_views("""
select event_id, cast((ts at time zone 'US/Eastern') at time zone 'UTC' as timestamp) as utc_ts from events"""))
def tz_zoned_reinterpret(spark, sf):
    return fx.events(spark, sf).select("event_id", tf.zoned_reinterpret("ts").alias("utc_ts"))


@query("format_sql_datetime", with_views("""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as sql_datetime from events"""))
def format_sql_datetime(spark, sf):
    return fx.events(spark, sf).select("event_id", tf.sql_datetime("ts").alias("sql_datetime"))


_RANGE_SQL = """
select chat_id, fromUser.id as author_id, price, created_ts from v_chat
where (created_ts < coalesce((select min(valid_from_ts) from v_dim), timestamp '2024-01-26 00:00:00')
    or created_ts > coalesce((select max(valid_from_ts) from v_dim), timestamp '1925-01-25 00:00:00'))"""


@query("filter_outside_seen_range", with_views(_RANGE_SQL))
def filter_outside_seen_range(spark, sf):
    chat = fx.v_chat(spark, sf)
    out = inc.outside_seen_range(chat, "created_ts", fx.v_dim(spark, sf), RUN_TS)
    return out.select("chat_id", F.col("fromUser.id").alias("author_id"), "price", "created_ts")


@query("filter_future_guard", with_views(_RANGE_SQL + " and created_ts <= timestamp '2024-01-26 00:00:00'"))
def filter_future_guard(spark, sf):
    chat = inc.future_guard(fx.v_chat(spark, sf), "created_ts", RUN_TS, 1)
    out = inc.outside_seen_range(chat, "created_ts", fx.v_dim(spark, sf), RUN_TS)
    return out.select("chat_id", F.col("fromUser.id").alias("author_id"), "price", "created_ts")


@query("build_source_batch", with_views("""
select distinct author_id, json_extract_string(media_blob, '$.id') as media_id,
       json_extract_string(media_blob, '$.duration') as media_duration, media_blob,
       1 as seen_count, created_ts as valid_from_ts, cast(null as timestamp) as valid_to_ts,
       true as is_current,
       cast((timestamp '2024-01-25 00:00:00' at time zone 'UTC') at time zone 'US/Eastern' as timestamp) as extract_ts
from (select fromUser.id as author_id, created_ts, unnest(media) as media_blob from v_chat
      where created_ts < coalesce((select min(valid_from_ts) from v_dim), timestamp '2024-01-26 00:00:00')
         or created_ts > coalesce((select max(valid_from_ts) from v_dim), timestamp '1925-01-25 00:00:00')) z"""))
def build_source_batch(spark, sf):
    return inc.build_source_batch(fx.v_chat(spark, sf), fx.v_dim(spark, sf), RUN_TS)


@query("agg_batch_bounds", with_views("""
select min(valid_from_ts) as min_src_ts, max(valid_from_ts) as max_src_ts, max(ex) as max_extract_ts
from (select author_id, media_id, md5(media_blob) as cs, valid_from_ts, valid_from_ts + interval 40 day as ex
      from v_versions group by all) z"""))
def agg_batch_bounds(spark, sf):
    """Bounds of all versions taken as one batch, each extracted forty days after its start."""
    batch = fx.v_versions(spark, sf).withColumn("extract_ts", F.col("valid_from_ts").cast("timestamp_ntz") + F.expr("INTERVAL 40 DAYS"))
    return scd2.batch_bounds(batch)


TWO_BATCHES = {"two_batches": """
select author_id, media_id, media_duration, media_blob, valid_from_ts, extract_ts from v_daily
union all
select author_id, media_id, media_duration, media_blob, valid_from_ts, extract_ts + interval 1 day from v_rescrape"""}


def _two_batches(spark, sf):
    cols = ["author_id", "media_id", "media_duration", "media_blob", "valid_from_ts", "extract_ts"]
    r = fx.v_rescrape(spark, sf).withColumn("extract_ts", tf.plus_days(F.col("extract_ts"), 1))
    return fx.v_daily(spark, sf).select(*cols).unionByName(r.select(*cols))


@query("dedupe_keep_first", with_views("""
select author_id, media_id, media_duration, media_blob, valid_from_ts, extract_ts, md5(media_blob) as checksum
from two_batches
qualify row_number() over (partition by author_id, media_id, md5(media_blob), valid_from_ts
                           order by extract_ts, media_blob, media_duration) = 1""", TWO_BATCHES))
def dedupe_keep_first(spark, sf):
    return scd2.dedupe_batch(_two_batches(spark, sf))


@query("window_partition_max", with_views("""
select author_id, media_id, valid_from_ts, extract_ts,
       max(extract_ts) over (partition by author_id, media_id, valid_from_ts) as max_extract_ts
from two_batches""", TWO_BATCHES))
def window_partition_max(spark, sf):
    rows = _two_batches(spark, sf).select("author_id", "media_id", "valid_from_ts", "extract_ts")
    return with_group_aggregates(rows, ["author_id", "media_id", "valid_from_ts"],
                                 {"max_extract_ts": F.max("extract_ts")})


_CHAIN = "partition by author_id, media_id order by valid_from_ts, extract_ts, media_blob"


def _chained(spark, sf):
    """Ordinal and next start per key, split by day of start (hot keys stay parallel)."""
    rows = _two_batches(spark, sf).withColumn("_bk", time_bucket("valid_from_ts"))
    return chain_links(rows, ["author_id", "media_id"], ["valid_from_ts", "extract_ts", "media_blob"],
                       "valid_from_ts", "_bk", seen="seen_count", nxt="valid_to_ts")


@query("window_version_ordinal", with_views(f"""
select author_id, media_id, valid_from_ts, extract_ts,
       cast(row_number() over ({_CHAIN}) as bigint) as seen_count from two_batches""", TWO_BATCHES))
def window_version_ordinal(spark, sf):
    return _chained(spark, sf).select("author_id", "media_id", "valid_from_ts", "extract_ts", "seen_count")


@query("window_lead_valid_to", with_views(f"""
select author_id, media_id, valid_from_ts, extract_ts,
       lead(valid_from_ts) over ({_CHAIN}) as valid_to_ts from two_batches""", TWO_BATCHES))
def window_lead_valid_to(spark, sf):
    return _chained(spark, sf).select("author_id", "media_id", "valid_from_ts", "extract_ts", "valid_to_ts")


@query("window_last_value_default", with_views("""
select author_id, media_id, valid_from_ts,
       last_value(valid_from_ts) over (partition by media_id, author_id order by valid_from_ts desc) as last_vf
from v_dim"""))
def window_last_value_default(spark, sf):
    """``last_value`` with the default frame (ends at the current peer): the row's own start."""
    return fx.v_dim(spark, sf).select(
        "author_id", "media_id", "valid_from_ts",
        last_value_default_frame(["media_id", "author_id"], "valid_from_ts", "valid_from_ts").alias("last_vf"))


@query("window_last_value_other", with_views("""
select author_id, post_id, posted_ts,
       last_value(date_trunc('hour', posted_ts)::timestamp) over (partition by author_id order by posted_ts desc) as last_hour
from v_wall"""))
def window_last_value_other(spark, sf):
    """``last_value`` of another column than the order: the value of the current row's last peer (peers share it here)."""
    wall = fx.v_wall(spark, sf).withColumn("_hour", F.date_trunc("hour", "posted_ts").cast("timestamp_ntz"))
    return wall.select("author_id", "post_id", "posted_ts", last_value_default_frame(["author_id"], "posted_ts", "_hour").alias("last_hour"))
