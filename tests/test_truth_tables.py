"""Corner cases of the type 2 apply (hazards of the reference's semantics), source batch
golden cases, and properties of the chain rebuild."""

import datetime as dt

from pyspark.sql import functions as F

from dimweave.operators import incremental as inc, scd2
from dimweave.schemas import DIM_SCHEMA, empty_dim

from test_scd2_golden import batch_df, dim_df

COLS = ["author_id", "media_id", "seen_count", "valid_from_ts", "valid_to_ts", "is_deleted", "is_current"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_h3_delete_flag_cleared_outside_window(spark):
    dim = dim_df(spark, ["930/130 d10 #1 [03-01T00:00,04-01T00:00) x03-01T01:00 del=T cur=F",
                         "931/131 d10 #1 [04-10T00:00,∅) x04-10T01:00 del=F cur=T"])
    batch = batch_df(spark, ["931/131 d10 [04-10T00:00) x06-01T00:00"])
    out = {r["author_id"]: r for r in scd2.apply_batch(dim, batch).collect()}
    assert out["930"]["is_deleted"] is False          # outside [04-10, 04-10]: flag cleared
    assert out["930"]["is_current"] is False          # ... while current stays false


def test_h4_reactivated_newest_version_has_no_current_row(spark):
    dim = dim_df(spark, ["932/132 d10 #1 [04-01T00:00,05-01T00:00) x04-01T01:00 del=T cur=F"])
    batch = batch_df(spark, ["932/132 d10 [04-01T00:00) x06-01T00:00"])
    out = scd2.apply_batch(dim, batch).collect()
    assert len(out) == 1
    assert out[0]["is_current"] is False and out[0]["valid_to_ts"] == out[0]["valid_from_ts"]


def test_h5_exact_match_plus_newer_version_gives_two_current_rows(spark):
    dim = dim_df(spark, ["933/133 d10 #1 [04-01T00:00,∅) x04-01T01:00 del=F cur=T"])
    batch = batch_df(spark, ["933/133 d10 [04-01T00:00) x06-01T00:00",
                             "933/133 d20 [05-01T00:00) x06-01T00:00"])
    out = scd2.apply_batch(dim, batch)
    assert out.where("is_current").count() == 2


def test_h7_null_keys_are_rejected(spark):
    dim = dim_df(spark, ["934/134 d10 #1 [04-01T00:00,∅) x04-01T01:00 del=F cur=T"])
    nulled = dim.withColumn("media_id", F.lit(None).cast("string"))
    batch = batch_df(spark, ["935/135 d10 [05-01T00:00) x06-01T00:00"])
    out = scd2.apply_batch(dim.unionByName(nulled), batch)
    assert out.where(F.col("media_id").isNull()).count() == 0
    assert out.count() == 2


def test_h8_empty_batch_clears_every_delete_flag(spark):
    dim = dim_df(spark, ["936/136 d10 #1 [04-01T00:00,05-01T00:00) x04-01T01:00 del=T cur=F"])
    out = scd2.apply_batch(dim, batch_df(spark, []))
    r = out.collect()
    assert len(r) == 1 and r[0]["is_deleted"] is False and r[0]["valid_to_ts"] is not None


def test_versioned_and_full_modes_agree(spark):
    from dimweave.plans import fixtures as fx
    from conftest import SF_SMALL
    dim, batch = fx.v_dim(spark, SF_SMALL), fx.v_rescrape(spark, SF_SMALL)
    a = scd2.apply_batch(dim, batch, dim_is_versioned=True)
    b = scd2.apply_batch(dim, batch, dim_is_versioned=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- source batch golden cases (B1-B3) --------------------------------------------------------

def _chat(spark, author, media, created):
    return spark.createDataFrame(
        [(1, (author,), [media], created)],
        "chat_id bigint, fromUser struct<id:string>, media array<string>, createdAt string")


def _range_dim(spark, starts):
    rows = [("0", "0", None, "x", 1, dt.datetime.fromisoformat(s), None, False, True, None, None) for s in starts]
    return spark.createDataFrame(rows, DIM_SCHEMA) if rows else empty_dim(spark)


RUN = dt.datetime(2025, 11, 1)


def test_b1_in_range_excluded(spark):
    chat = _chat(spark, "901", '{"id":"101","duration":120}', "2025-04-15 10:00:00")
    out = inc.build_source_batch(chat, _range_dim(spark, ["2025-03-01 00:00:00", "2025-09-30 00:00:00"]),
                                 RUN, created="createdAt")
    assert out.count() == 0


def test_b2_after_range_included(spark):
    chat = _chat(spark, "902", '{"id":"102","duration":180}', "2025-10-15 10:00:00")
    out = inc.build_source_batch(chat, _range_dim(spark, ["2025-03-01 00:00:00", "2025-09-30 00:00:00"]),
                                 RUN, created="createdAt").collect()
    assert [(r.author_id, r.media_id, r.media_duration, r.seen_count, r.valid_from_ts, r.valid_to_ts, r.is_current)
            for r in out] == [("902", "102", "180", 1, dt.datetime(2025, 10, 15, 10), None, True)]


def test_b3_empty_target_included(spark):
    chat = _chat(spark, "903", '{"id":"103","duration":240}', "2025-04-15 10:00:00")
    out = inc.build_source_batch(chat, _range_dim(spark, []), RUN, created="createdAt").collect()
    assert [(r.author_id, r.media_id, r.media_duration, r.valid_from_ts) for r in out] == [
        ("903", "103", "240", dt.datetime(2025, 4, 15, 10))]
    # run time shown as US/Eastern wall clock (UTC-4 in November before the change, -5 after)
    assert out[0].extract_ts == dt.datetime(2025, 10, 31, 20)


# --- chain rebuild properties -----------------------------------------------------------------

def test_rebuild_chain_invariants(spark):
    from dimweave.plans import fixtures as fx
    from conftest import SF_SMALL
    out = scd2.rebuild_chain(fx.v_dim(spark, SF_SMALL), fx.v_daily(spark, SF_SMALL))
    touched = fx.v_daily(spark, SF_SMALL).select("author_id", "media_id").distinct()
    chains = out.join(touched, ["author_id", "media_id"], "left_semi")
    # exactly one current row per touched key
    per_key = chains.groupBy("author_id", "media_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert per_key.where("n != 1").count() == 0
    # contiguous: each closed interval ends where the next version starts
    from pyspark.sql import Window as W
    w = W.partitionBy("author_id", "media_id").orderBy("seen_count")
    gaps = chains.withColumn("nxt", F.lead("valid_from_ts").over(w)).where(
        F.col("valid_to_ts").isNotNull() & (F.col("valid_to_ts") != F.col("nxt")))
    assert gaps.count() == 0


def test_rebuild_chain_order_independent(spark):
    from dimweave.plans import fixtures as fx
    from conftest import SF_SMALL
    dim = fx.v_dim(spark, SF_SMALL).select(*scd2.LEGACY_DIM_COLUMNS)
    daily, back = fx.v_daily(spark, SF_SMALL), fx.v_backfill(spark, SF_SMALL)
    a = scd2.rebuild_chain(scd2.rebuild_chain(dim, daily), back).drop("extract_ts")
    b = scd2.rebuild_chain(scd2.rebuild_chain(dim, back), daily).drop("extract_ts")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_shuffle_fallback_equals_broadcast_path(spark):
    """Above the broadcast bound the key split runs as a shuffle join; results are the same."""
    from dimweave.plans import fixtures as fx
    from conftest import SF_SMALL
    dim, batch = fx.v_dim(spark, SF_SMALL), fx.v_rescrape(spark, SF_SMALL)
    a = scd2.apply_batch(dim, batch)
    b = scd2.apply_batch(dim, batch, broadcast_rows=0)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_h6_seen_count_restarts_when_exact_match_stays_outside_the_chain(spark):
    dim = dim_df(spark, ["937/137 d10 #1 [04-01T00:00,05-01T00:00) x04-01T01:00 del=F cur=F",
                         "937/137 d20 #2 [05-01T00:00,∅) x05-01T01:00 del=F cur=T"])
    batch = batch_df(spark, ["937/137 d10 [04-01T00:00) x06-02T00:00",      # exact live re-send of #1
                             "937/137 d30 [06-01T00:00) x06-02T00:00"])     # new version
    rows = sorted((r.valid_from_ts.month, r.seen_count, r.is_current)
                  for r in scd2.apply_batch(dim, batch).collect())
    # #1 is kept as it is; #2 is re-chained with the new version and restarts at 1
    assert rows == [(4, 1, False), (5, 1, False), (6, 2, True)]
