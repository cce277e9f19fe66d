"""Hot keys: one key holding most rows gives the same chains whatever the time slice,
and the two-phase global windows equal a single-partition window."""

import datetime as dt

from pyspark.sql import Window as W, functions as F

from dimweave.operators import origin as og, scd2
from dimweave.operators.chains import chain_links, time_bucket
from dimweave.plans import fixtures as fx

from conftest import SF_SMALL


def _hot_versions(spark, n=400):
    base = dt.datetime(2024, 1, 1)
    rows = [("7", "hot", i % 5, f'{{"k": {i % 5}}}', base + dt.timedelta(hours=7 * i)) for i in range(n)]
    rows += [("8", "cold", 1, '{"k": 1}', base + dt.timedelta(days=i)) for i in range(5)]
    return spark.createDataFrame(rows, "author_id string, media_id string, media_duration int, "
                                       "media_blob string, valid_from_ts timestamp_ntz")


def test_chain_links_equals_plain_window(spark):
    v = _hot_versions(spark).withColumn("_bk", time_bucket("valid_from_ts", "day"))
    got = chain_links(v, ["author_id", "media_id"], ["valid_from_ts"], "valid_from_ts", "_bk")
    w = W.partitionBy("author_id", "media_id").orderBy("valid_from_ts")
    want = v.select("*", F.row_number().over(w).cast("bigint").alias("_seen"),
                    F.lead("valid_from_ts").over(w).alias("_next"))
    cols = ["author_id", "media_id", "valid_from_ts", "_seen", "_next"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_apply_same_for_any_time_slice(spark):
    hot = _hot_versions(spark)
    dim0 = scd2.apply_batch(scd2.conform_dim_like(hot.limit(0).withColumn("seen_count", F.lit(1))
                                                   .withColumn("valid_to_ts", F.lit(None).cast("timestamp_ntz"))
                                                   .withColumn("is_current", F.lit(True))
                                                   .withColumn("extract_ts", F.lit(None).cast("timestamp_ntz"))),
                            hot.withColumn("extract_ts", F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz")))
    cols = scd2.DIM_COLUMNS
    a = dim0.select(cols)
    later = hot.withColumn("valid_from_ts", F.col("valid_from_ts") + F.expr("INTERVAL 2 HOURS")) \
               .withColumn("extract_ts", F.lit(dt.datetime(2024, 7, 1)).cast("timestamp_ntz"))
    by_day = scd2.apply_batch(a, later, bucket_unit="day").select(cols)
    one_slice = scd2.apply_batch(a, later, bucket_unit="year").select(cols)
    assert by_day.exceptAll(one_slice).count() == 0 and one_slice.exceptAll(by_day).count() == 0
    # one current row per key
    cur = by_day.where("is_current").groupBy("author_id", "media_id").count()
    assert cur.where("count != 1").count() == 0


def test_monotone_ids_equal_naive_global_window(spark):
    wall = fx.v_wall(spark, SF_SMALL)
    got = og.monotone_ids(wall, bucket="hour")
    naive = wall.withColumn("max_media_id_yet", F.max("media_id").over(W.orderBy(F.col("posted_ts").asc_nulls_last())))
    naive = naive.withColumn("media_id_v2", F.greatest("media_id", "max_media_id_yet"))
    order = [F.col(c).asc_nulls_last() for c in ("media_id_v2", "posted_ts", "author_id", "media_id", "post_id")]
    naive = naive.withColumn("next_media_id_v2",
                             F.coalesce(F.lead("media_id_v2").over(W.orderBy(*order)), F.lit(og.SENTINEL)))
    cols = ["post_id", "max_media_id_yet", "media_id_v2", "next_media_id_v2"]
    assert got.select(cols).exceptAll(naive.select(cols)).count() == 0
    # same answer with a different bucket width
    day = og.monotone_ids(wall, bucket="day").select(cols)
    assert day.exceptAll(got.select(cols)).count() == 0


def test_bucketed_range_join_equals_nested_loop(spark):
    chat = fx.v_ochat(spark, SF_SMALL).select("chat_id", "author_id", "media_id")
    bands = og.daily_id_bands(og.monotone_ids(fx.v_wall(spark, SF_SMALL))).withColumnRenamed(
        "author_id", "band_author_id")
    got = og.range_join(chat, bands)
    cond = (chat["media_id"] >= bands["first_media_id_v2"]) & (chat["media_id"] < bands["last_media_id_v2"])
    want = chat.join(bands, cond, "inner")
    cols = ["chat_id", "media_id", "band_author_id", "posted_date"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()
    left = og.range_join(chat, bands, how="left")
    assert left.where(F.col("posted_date").isNull()).count() == chat.join(want.select("chat_id", "media_id"),
                                                                        ["chat_id", "media_id"], "left_anti").count()


def test_lead_per_author_lexical_ids(spark):
    """String ids (as staged wall posts hold them) are ordered lexically."""
    wall = fx.v_wall(spark, SF_SMALL).withColumn("media_id", (F.col("media_id") % 997).cast("string"))
    got = og.lead_per_author(wall)
    w = W.partitionBy("author_id").orderBy("media_id", "post_id")
    want = wall.select("*", F.lead("media_id").over(w).alias("next_media_id"),
                       F.lead("posted_ts").over(w).alias("next_posted_ts"))
    cols = ["post_id", "media_id", "next_media_id", "next_posted_ts"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert got.count() == want.count()


def test_range_join_with_empty_and_very_wide_bands(spark):
    """80 % empty bands and one over 6e9 ids: the band side at most doubles."""
    bands = spark.createDataFrame([(i, 1000 * i, 1000 * i) for i in range(40)] + [(100 + i, 1000 * i, 1000 * i + 7) for i in range(10)]
                                  + [(999, 0, 6_000_000_000)], "band int, first_media_id_v2 bigint, last_media_id_v2 bigint")
    probe = spark.createDataFrame([(3003,), (9006,), (9007,), (5_999_999_999,), (6_000_000_000,), (None,)], "media_id bigint")
    got = sorted((r.media_id, r.band) for r in og.range_join(probe, bands).collect())
    assert got == [(3003, 103), (3003, 999), (9006, 109), (9006, 999), (9007, 999), (5_999_999_999, 999)]
    left = og.range_join(probe, bands, how="left").where("band is null").collect()
    assert sorted((r.media_id for r in left), key=str) == [6_000_000_000, None]


def test_rows_without_author_or_id(spark):
    """A null author is a chain of its own; a null media id lies in no band; equal wall rows get one successor."""
    import datetime as dt
    t = [dt.datetime(2025, 1, 1, 0, i) for i in range(3)]
    wall = spark.createDataFrame([(None, 1, 10, t[0]), (None, 2, 20, t[1]), ("a", 3, 30, t[2])],
                                 "author_id string, post_id bigint, media_id bigint, posted_ts timestamp_ntz")
    assert sorted((r.post_id, r.next_media_id) for r in og.lead_per_author(wall).collect()) == [(1, 20), (2, None), (3, None)]
    chat = spark.createDataFrame([(1, "a", 31), (2, "a", None)], "chat_id bigint, author_id string, media_id bigint")
    assert [r.chat_id for r in og.asof_band(chat, wall).collect()] == [1]
    twice = spark.createDataFrame([("a", 1, 10, t[0]), ("a", 1, 10, t[0]), ("a", 2, 20, t[1])], wall.schema)
    assert sorted(r.next_media_id_v2 for r in og.monotone_ids(twice).collect()) == [10, 20, og.SENTINEL]
