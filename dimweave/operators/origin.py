"""Origin-date attribution: date chat media by placing their ids in id bands of wall posts.

Wall media ids are made monotone in posting time with a running max across
all authors; each row's band runs from its monotone id to the next row's
(a sentinel closes the last one).  Bands are merged per (author, posting
day), and every chat video takes the posting date of a band its id falls in;
per (author, media) the latest message wins.

Scale: the two global windows (running max, next value) are never run as
single-partition windows.  Rows are first reduced to one row per distinct
posting time (map-side partial aggregation absorbs hot times), the times are
cut into buckets, a small per-bucket summary carries values across bucket
edges, and results join back on the time key.  The range join sweeps sorted
id ranges, cut at sampled quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.numeric import round_ratio
from .borders import default_parts, part_of, sampled_borders
from .chains import chain_links
from .dedupe import asc, desc, keep_first
from .joins import with_group_aggregates
from .sweep import sweep_join

# Fixed value: the upper bound that closes the newest band.
SENTINEL = 99999999999
# Part of rows that sort after every other.
_LAST_PART = (1 << 31) - 1
# Null posting times sort after every real one.
_LATE = "9999-12-31 23:59:59.999999"


def _time_key(col: str):
    return F.coalesce(F.col(col), F.lit(_LATE).cast("timestamp_ntz"))


def monotone_ids(wall: DataFrame, *, ts: str = "posted_ts", media_id: str = "media_id",
                 tie: tuple[str, ...] = ("author_id", "media_id", "post_id"),
                 bucket: str = "hour", sentinel: int = SENTINEL) -> DataFrame:
    """Add ``max_media_id_yet``, ``media_id_v2`` and ``next_media_id_v2`` to each wall row.

    ``max_media_id_yet`` = max id over rows posted at or before this row's time
    (peers share it); ``media_id_v2 = greatest(media_id, max_media_id_yet)``;
    ``next_media_id_v2`` = ``media_id_v2`` of the next row in the order
    (media_id_v2, ts, *tie), or ``sentinel`` for the last row.  Ids must be
    non-null for that order to equal the time order.
    """
    key = _time_key(ts)
    rows = wall.withColumn("_tk", key).withColumn("_tie", F.struct(*[F.col(c) for c in tie]))
    per_ts = rows.groupBy("_tk").agg(F.max(media_id).alias("_ts_max"), F.max("_tie").alias("_last_tie"))
    per_ts = per_ts.withColumn("_bk", F.date_trunc(bucket, "_tk"))

    # per-bucket summary: one row per bucket, carried across bucket edges
    summ = per_ts.groupBy("_bk").agg(
        F.max("_ts_max").alias("_b_max"),
        F.min_by("_ts_max", "_tk").alias("_b_first_max"))
    wb = W.orderBy("_bk")
    summ = (summ.withColumn("_before", F.max("_b_max").over(wb.rowsBetween(W.unboundedPreceding, -1)))
                .withColumn("_b_first_v2", F.greatest("_before", "_b_first_max"))
                .withColumn("_next_bucket_v2", F.lead("_b_first_v2").over(wb))
                .select("_bk", "_before", "_next_bucket_v2"))
    # No broadcast needed: the join below is hash-partitioned on the bucket,
    # which is exactly the partitioning the per-bucket window reuses.

    wt = W.partitionBy("_bk").orderBy("_tk")
    per_ts = (per_ts.join(summ, "_bk")
              .withColumn("_run", F.max("_ts_max").over(wt.rowsBetween(W.unboundedPreceding, 0)))
              .withColumn("_v2", F.greatest("_before", "_run")))
    per_ts = per_ts.withColumn(
        "_next_v2", F.coalesce(F.lead("_v2").over(wt), F.col("_next_bucket_v2"), F.lit(sentinel).cast("bigint")))
    per_ts = per_ts.select("_tk", F.col("_v2").alias("_max_yet"), "_next_v2", "_last_tie")

    out = rows.join(per_ts, "_tk")
    v2 = F.greatest(F.col(media_id), F.col("_max_yet"))
    # of rows equal in time and tie only one is the last of its time
    copy = F.row_number().over(W.partitionBy("_tk", "_tie").orderBy(F.col(media_id)))
    out = out.withColumn("_copy", copy)
    nxt = F.when(F.col("_tie").eqNullSafe(F.col("_last_tie")) & (F.col("_copy") == 1), F.col("_next_v2")).otherwise(v2)
    return (out.withColumn("max_media_id_yet", F.col("_max_yet"))
               .withColumn("media_id_v2", v2)
               .withColumn("next_media_id_v2", nxt)
               .drop("_tk", "_tie", "_max_yet", "_next_v2", "_last_tie", "_copy"))


def daily_id_bands(wall_v2: DataFrame, *, ts: str = "posted_ts") -> DataFrame:
    """Merge bands per (author, posting day): [min id_v2, max next id_v2)."""
    return (wall_v2.withColumn("posted_date", F.to_date(ts))
            .groupBy("author_id", "posted_date")
            .agg(F.min("media_id_v2").alias("first_media_id_v2"),
                 F.max("next_media_id_v2").alias("last_media_id_v2")))


def merge_bands_by_date(bands: DataFrame, *, lo: str = "first_media_id_v2",
                        hi: str = "last_media_id_v2", parts: int | None = None) -> DataFrame:
    """Union the bands of all authors per posting date into disjoint islands.

    Only the posting date of a containing band reaches the origin-date
    result, so the bands of one day may be replaced by their union without
    changing it.  This turns a fan-out of one match per author into about one
    per day.  Gaps and islands: within a date, ordered by start, a band opens
    a new island when it starts after every earlier band has ended.

    A day is not one group: its bands are cut at sampled quantiles of
    (date, start) into ranges, a summary of one row per range says how far the ranges
    before it reach and how many islands they open, and islands that run over
    a range's edge are joined by their number.
    """
    kinds = [dict(bands.dtypes)["posted_date"], dict(bands.dtypes)[lo]]
    borders = sampled_borders(bands, ["posted_date", lo], parts or default_parts(bands))
    rows = bands.withColumn("_range", part_of(["posted_date", lo], borders, kinds)).repartition("posted_date", "_range")
    rows = rows.where(F.col(lo).isNotNull())
    w = W.partitionBy("posted_date", "_range").orderBy(asc(lo), asc(hi))
    rows = rows.withColumn("_reach", F.max(hi).over(w.rowsBetween(W.unboundedPreceding, -1)))
    over = W.partitionBy("posted_date").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    reach = rows.groupBy("posted_date", "_range").agg(F.max(hi).alias("_far")).withColumn("_before", F.max("_far").over(over)).drop("_far")

    def same(side):  # a null date is a date like any other
        return [rows["posted_date"].eqNullSafe(side["_d"]), rows["_range"] == side["_r"]]

    reach = reach.select(F.col("posted_date").alias("_d"), F.col("_range").alias("_r"), "_before")
    rows = rows.join(reach, same(reach)).drop("_d", "_r")
    ended = F.greatest("_reach", "_before")  # nulls are passed over
    rows = rows.withColumn("_open", F.when(ended.isNull() | (F.col(lo) > ended), 1).otherwise(0))
    counted = W.partitionBy("posted_date", "_range").orderBy(asc(lo), asc(hi), F.col("_open").desc())  # of equal bands the opening one first
    rows = rows.withColumn("_island", F.sum("_open").over(counted.rowsBetween(W.unboundedPreceding, 0)))
    # islands of a range first, then those that are one across ranges
    part = rows.groupBy("posted_date", "_range", "_island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.max("_open").alias("_open"))
    opened = part.groupBy("posted_date", "_range").agg(F.sum("_open").alias("_n"))
    opened = opened.select(F.col("posted_date").alias("_d"), F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_opened"))
    part = part.join(opened, [part["posted_date"].eqNullSafe(opened["_d"]), part["_range"] == opened["_r"]])
    return (part.groupBy("posted_date", (F.col("_opened") + F.col("_island")).alias("_island"))
            .agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("_island"))


def range_join(probe: DataFrame, bands: DataFrame, *, value: str = "media_id",
               lo: str = "first_media_id_v2", hi: str = "last_media_id_v2", how: str = "inner",
               parts: int | None = None) -> DataFrame:
    """Join each probe row to every band with ``lo <= value < hi`` (half-open), by one sorted sweep per id range.

    ``how='left'`` keeps probe rows without a band (band columns null); see ``sweep.sweep_join``.
    """
    return sweep_join(probe, bands, value=value, lo=lo, hi=hi, how=how, parts=parts)


def chat_media_totals(chat_media: DataFrame, *, chat_id: str = "chat_id",
                      duration: str = "media_duration", media_count: str | None = None) -> DataFrame:
    """Per media row: message total duration and media count.

    Whole-message aggregates joined back (``joins.with_group_aggregates``),
    so a hot message is split by AQE rather than held by one task.
    """
    aggs = {"tot_duration_per_msg": F.sum(F.coalesce(F.col(duration), F.lit(0))).cast("bigint")}
    if media_count is None:
        aggs["media_count"] = F.count(F.lit(1))
    out = with_group_aggregates(chat_media, [chat_id], aggs)
    if media_count is not None:
        out = out.withColumn("media_count", F.col(media_count))
    return out.withColumn("created_date", F.to_date("created_ts"))


def origin_date(chat_media: DataFrame, wall: DataFrame, *, min_year: int = 2025,
                media_id: int | None = None, posted_between: tuple | None = None, sentinel: int = SENTINEL,
                bucket: str = "hour", sort: bool = True) -> DataFrame:
    """Approximate origin date of each chat video.

    ``chat_media``: one row per chat media (``chat_id, author_id, media_id
    (bigint), msg_price, media_duration, created_ts`` and optionally
    ``media_count``).  ``wall``: one row per wall media (``author_id,
    post_id, media_id (bigint), posted_ts``).

    Output: ``created_date, media_id, media_duration, msg_price,
    media_count, duration_ratio, approx_origin_date``; one row per (author,
    media): the latest message, then the latest band date.  The bands of a
    day are merged across authors before the range join (the band's author
    never reaches the result), so each chat medium meets about one band per
    day instead of one per author.
    """
    mc = "media_count" if "media_count" in chat_media.columns else None
    t1 = chat_media_totals(chat_media, media_count=mc)
    t1 = t1.where(F.col("media_duration") > 0)
    if media_id is not None:
        t1 = t1.where(F.col("media_id") == media_id)
    bands = daily_id_bands(monotone_ids(wall, bucket=bucket, sentinel=sentinel))
    bands = bands.where(F.year("posted_date") >= min_year)
    if posted_between is not None:
        bands = bands.where(F.col("posted_date").between(*posted_between))
    bands = merge_bands_by_date(bands.select("posted_date", "first_media_id_v2", "last_media_id_v2"))
    j = range_join(t1, bands)
    j = j.withColumn("duration_ratio", round_ratio(F.col("media_duration"), F.col("tot_duration_per_msg")))
    top = keep_first(j, ["author_id", "media_id"],
                     [desc("created_date"), desc("chat_id"), desc("created_ts"), desc("posted_date"),
                      desc("media_duration"), desc("msg_price"), desc("media_count")])
    out = top.select("created_date", "media_id", "media_duration", "msg_price", "media_count",
                     "duration_ratio", F.col("posted_date").alias("approx_origin_date"))
    if sort:
        out = out.orderBy(desc("duration_ratio"), desc("media_duration"))
    return out


def lead_per_author(wall: DataFrame, *, by: str = "author_id", value: str = "media_id",
                    tie: str = "post_id", carry: tuple[str, ...] = ("posted_ts",),
                    parts: int | None = None) -> DataFrame:
    """``lead(value)`` and ``lead(carry)`` per author ordered by (value, tie).

    Rows are cut at sampled quantiles of (author, value, tie), so the parts are even
    for numbers and for text, whatever the ids look like; values are stitched
    across the cuts by a summary, and one author with most of the rows still
    runs in parallel.  Text ids are in lexical order.  Adds ``next_<value>``
    and ``next_<carry>`` columns.
    """
    types = dict(wall.dtypes)
    order = {"_by": F.col(by), "_value": F.col(value), "_late": F.col(tie).isNull(), "_tie": F.col(tie)}  # null ties come last
    kinds = [types[by], types[value], "boolean", types[tie]]
    borders = sampled_borders(wall.select(*[c.alias(n) for n, c in order.items()]), list(order), parts or default_parts(wall))
    place = F.when(F.col(value).isNull(), F.lit(_LAST_PART)).otherwise(part_of(list(order.values()), borders, kinds))
    out = chain_links(wall.withColumn("_ib", place), [by], [value, tie], value, "_ib", seen="_ord", nxt=f"next_{value}", carry=carry)
    return out.drop("_ib", "_ord")


def asof_band(chat_media: DataFrame, wall: DataFrame, *, by: str = "author_id",
              value: str = "media_id", parts: int | None = None) -> DataFrame:
    """Per-author id-band join: each chat medium meets the wall row of the same
    author whose id band ``[media_id, next media_id)`` contains it.

    Written as an as-of join: the wall rows get their band end from
    ``lead_per_author``; wall and chat rows are unioned, partitioned by
    (author, id range), and the last wall band at or before each chat id is
    carried forward inside the range (rows without an id lie in no band); a small per-(author, range) summary
    supplies the band that is open when a range starts.  No pairs are
    enumerated and no author is held by a single task.  The newest band of an
    author is open-ended.
    """
    wall, chat_media = wall.where(F.col(value).isNotNull()), chat_media.where(F.col(value).isNotNull())
    both = wall.select(by, value).unionByName(chat_media.select(by, value))
    parts = parts or default_parts(wall)
    borders = sampled_borders(both, [by, value], parts)
    bands = lead_per_author(wall, by=by, value=value, carry=(), parts=parts)
    band = F.struct(F.col(value).alias("band_from"), F.col(f"next_{value}").alias("band_to"),
                    F.col("post_id"), F.col("posted_ts"))
    wl = bands.select(by, F.col(value).alias("_v"), F.lit(0).alias("_side"), F.col("post_id").alias("_ord"),
                      F.lit(None).cast("bigint").alias("chat_id"), band.alias("_band"))
    ch = chat_media.select(by, F.col(value).alias("_v"), F.lit(1).alias("_side"),
                           F.col("chat_id").cast("bigint").alias("_ord"), F.col("chat_id").cast("bigint"),
                           F.lit(None).cast(band_type(wall, value)).alias("_band"))
    u = wl.unionByName(ch)
    kinds = [dict(u.dtypes)[c] for c in (by, "_v")]
    u = u.withColumn("_ib", part_of([by, "_v"], borders, kinds)).repartition(by, "_ib")
    w = W.partitionBy(by, "_ib").orderBy(asc("_v"), asc("_side"), asc("_ord"))
    u = u.withColumn("_local", F.last("_band", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    summ = u.groupBy(by, "_ib").agg(F.max_by("_band", F.when(F.col("_side") == 0,
                                                             F.struct("_v", "_ord"))).alias("_last"))
    wk = W.partitionBy(by).orderBy(asc("_ib"))
    summ = summ.select(by, "_ib", F.last("_last", ignorenulls=True).over(
        wk.rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    hits = (u.where(F.col("_side") == 1).join(summ, [by, "_ib"], "inner")
             .withColumn("_b", F.coalesce("_local", "_before"))
             .where(F.col("_b").isNotNull()))
    return hits.select("chat_id", by, F.col("_v").alias(value), F.col("_b.post_id").alias("post_id"),
                       F.col("_b.band_from").alias("band_from"), F.col("_b.band_to").alias("band_to"),
                       F.col("_b.posted_ts").alias("posted_ts"))


def band_type(wall: DataFrame, value: str) -> str:
    t = wall.schema
    return (f"struct<band_from:{t[value].dataType.simpleString()},band_to:{t[value].dataType.simpleString()},"
            f"post_id:{t['post_id'].dataType.simpleString()},posted_ts:{t['posted_ts'].dataType.simpleString()}>")
