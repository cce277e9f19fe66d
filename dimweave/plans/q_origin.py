"""Registered queries: origin-date attribution and its parts (bands, global windows, range joins)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import origin as og
from . import fixtures as fx
from .oracle_views import with_views
from .registry import query

MIN_YEAR = 2024

# Oracle, stated from the semantics: every wall row looks up the largest id posted
# so far, rows are numbered, a row's band ends where the next number begins.
WALL_CTES = {
    "posted": """
select w.author_id, w.post_id, w.media_id, w.posted_ts,
       case when w.posted_ts is null then (select max(e.media_id) from v_wall e)
            else (select max(e.media_id) from v_wall e where e.posted_ts <= w.posted_ts) end as largest
from v_wall w""",
    "numbered": """
select p.*, greatest(media_id, largest) as band_start,
       row_number() over (order by greatest(media_id, largest), posted_ts, author_id, media_id, post_id) as place
from posted p""",
    "banded": """
select n.*, case when f.place is null then 99999999999 else f.band_start end as band_end
from numbered n left join numbered f on f.place = n.place + 1""",
    "day_spans": """
select author_id, posted_ts::date as day, min(band_start) as opens, max(band_end) as closes
from banded group by all""",
    "messages": """
select chat_id, count(*) as n_media, coalesce(sum(media_duration), 0)::bigint as seconds
from v_ochat group by chat_id""",
}

# The newest message of a medium that lies in a band, with the newest day of such a band.
ORIGIN_BODY = """
select created_date, media_id, media_duration, msg_price, media_count, duration_ratio, approx_origin_date
from (
  select distinct on (author_id, media_id) *
  from (
    select c.author_id, c.chat_id, c.created_ts, c.created_ts::date as created_date, c.media_id, c.media_duration,
           c.msg_price, m.n_media as media_count, round(c.media_duration * 1.0 / m.seconds, 2) as duration_ratio,
           (select max(s.day) from day_spans s
            where extract(year from s.day) >= {min_year} and s.opens <= c.media_id and c.media_id < s.closes) as approx_origin_date
    from v_ochat c join messages m using (chat_id)
    where c.media_duration > 0)
  where approx_origin_date is not null
  order by author_id, media_id, created_date desc, chat_id desc, created_ts desc, media_duration desc, msg_price desc)"""


@query("window_running_max_global", with_views(
    "select author_id, post_id, media_id, posted_ts, largest as max_media_id_yet, band_start as media_id_v2 from numbered", WALL_CTES))
def window_running_max_global(spark, sf):
    m = og.monotone_ids(fx.v_wall(spark, sf))
    return m.select("author_id", "post_id", "media_id", "posted_ts", "max_media_id_yet", "media_id_v2")


@query("window_lead_global_sentinel", with_views(
    "select author_id, post_id, posted_ts, band_start as media_id_v2, band_end as next_media_id_v2 from banded", WALL_CTES))
def window_lead_global_sentinel(spark, sf):
    m = og.monotone_ids(fx.v_wall(spark, sf))
    return m.select("author_id", "post_id", "posted_ts", "media_id_v2", "next_media_id_v2")


@query("agg_daily_id_bands", with_views(
    "select author_id, day as posted_date, opens as first_media_id_v2, closes as last_media_id_v2 from day_spans", WALL_CTES))
def agg_daily_id_bands(spark, sf):
    return og.daily_id_bands(og.monotone_ids(fx.v_wall(spark, sf)))


@query("origin_date", with_views(ORIGIN_BODY.format(min_year=MIN_YEAR), WALL_CTES))
def origin_date(spark, sf):
    return og.origin_date(fx.v_ochat(spark, sf), fx.v_wall(spark, sf), min_year=MIN_YEAR)


@query("join_range_half_open", with_views("""
select c.chat_id, c.author_id, c.media_id, s.author_id as band_author_id, s.day as posted_date,
       s.opens as first_media_id_v2, s.closes as last_media_id_v2
from v_ochat c left join day_spans s on s.opens <= c.media_id and c.media_id < s.closes""", WALL_CTES))
def join_range_half_open(spark, sf):
    """Left range join of chat media to the daily bands (all bands, no year filter)."""
    t1 = fx.v_ochat(spark, sf).select("chat_id", "author_id", "media_id")
    bands = og.daily_id_bands(og.monotone_ids(fx.v_wall(spark, sf))).withColumnRenamed(
        "author_id", "band_author_id")
    return og.range_join(t1, bands, how="left").select(
        "chat_id", "author_id", "media_id", "band_author_id", "posted_date",
        "first_media_id_v2", "last_media_id_v2")


@query("join_author_band", with_views("""
select c.chat_id, c.author_id, c.media_id, w.post_id, w.media_id as band_from, w.band_to, w.posted_ts
from v_ochat c join (
  select author_id, post_id, media_id, posted_ts,
         lead(media_id) over (partition by author_id order by media_id, post_id) as band_to
  from v_wall) w
  on c.author_id = w.author_id and c.media_id >= w.media_id and (w.band_to is null or c.media_id < w.band_to)"""))
def join_author_band(spark, sf):
    return og.asof_band(fx.v_ochat(spark, sf), fx.v_wall(spark, sf))


@query("window_lead_per_author", with_views("""
select author_id, post_id, media_id, posted_ts,
       lead(media_id, 1) over (partition by author_id order by media_id, post_id) as next_media_id,
       lead(posted_ts, 1) over (partition by author_id order by media_id, post_id) as next_media_id_ts
from v_wall"""))
def window_lead_per_author(spark, sf):
    out = og.lead_per_author(fx.v_wall(spark, sf))
    return out.select("author_id", "post_id", "media_id", "posted_ts", "next_media_id",
                      F.col("next_posted_ts").alias("next_media_id_ts"))


@query("window_lead_per_author_lexical", with_views("""
select author_id, post_id, cast(media_id as varchar) as media_id, posted_ts,
       lead(cast(media_id as varchar)) over following as next_media_id, lead(posted_ts) over following as next_media_id_ts
from v_wall window following as (partition by author_id order by cast(media_id as varchar), post_id)"""))
def window_lead_per_author_lexical(spark, sf):
    """The same lead with ids as text, in lexical order."""
    wall = fx.v_wall(spark, sf).withColumn("media_id", F.col("media_id").cast("string"))
    return og.lead_per_author(wall).select("author_id", "post_id", "media_id", "posted_ts", "next_media_id",
                                           F.col("next_posted_ts").alias("next_media_id_ts"))


@query("origin_date_one_medium", with_views("""
select * from (""" + ORIGIN_BODY.format(min_year=MIN_YEAR) + """) where media_id = (select min(media_id) from v_ochat where media_duration > 0)""", WALL_CTES))
def origin_date_one_medium(spark, sf):
    """The optional filter on one media id."""
    chat = fx.v_ochat(spark, sf)
    one = chat.where(F.col("media_duration") > 0).agg(F.min("media_id")).first()[0]
    return og.origin_date(chat, fx.v_wall(spark, sf), min_year=MIN_YEAR, media_id=one)


@query("origin_date_posted_between", with_views(ORIGIN_BODY.format(min_year=str(MIN_YEAR) + " and s.day between date '2024-01-05' and date '2024-01-19'"), WALL_CTES))
def origin_date_posted_between(spark, sf):
    """The optional filter on the posting days of the bands."""
    days = (dt.date(2024, 1, 5), dt.date(2024, 1, 19))
    return og.origin_date(fx.v_ochat(spark, sf), fx.v_wall(spark, sf), min_year=MIN_YEAR, posted_between=days)
