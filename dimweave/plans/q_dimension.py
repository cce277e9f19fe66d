"""Registered queries: type 2 apply scenarios, chain rebuild, reads of the dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import scd2
from ..operators.asof import as_of_join
from ..schemas import empty_dim
from . import fixtures as fx
from .oracle_views import with_views
from .registry import query
from .sql_scd2 import DIM_COLS, LEGACY_COLS, apply_ctes, rebuild_ctes

AS_OF = dt.datetime(2024, 1, 15)


def _apply_sql(dim: str, batch: str, tail: str = "select * from r_result") -> str:
    return with_views(tail, apply_ctes("r_", dim, batch))


EMPTY_DIM_SQL = {"empty_dim": f"select {DIM_COLS} from v_dim where false"}


@query("scd2_bootstrap", with_views("select * from r_result",
                                    {**EMPTY_DIM_SQL, **apply_ctes("r_", "empty_dim", "v_daily")}))
def scd2_bootstrap(spark, sf):
    return scd2.apply_batch(empty_dim(spark), fx.v_daily(spark, sf))


@query("scd2_newer", _apply_sql("v_dim", "v_daily"))
def scd2_newer(spark, sf):
    return scd2.apply_batch(fx.v_dim(spark, sf), fx.v_daily(spark, sf))


@query("scd2_backfill", _apply_sql("v_dim", "v_backfill"))
def scd2_backfill(spark, sf):
    return scd2.apply_batch(fx.v_dim(spark, sf), fx.v_backfill(spark, sf))


@query("scd2_apply", _apply_sql("v_dim", "v_rescrape"))
def scd2_apply(spark, sf):
    return scd2.apply_batch(fx.v_dim(spark, sf), fx.v_rescrape(spark, sf))


@query("scd2_soft_delete", _apply_sql("v_dim", "v_rescrape", "select * from r_result where is_deleted"))
def scd2_soft_delete(spark, sf):
    """Versions flagged deleted after a re-scrape that omitted their key."""
    return scd2.apply_batch(fx.v_dim(spark, sf), fx.v_rescrape(spark, sf)).where("is_deleted")


@query("scd2_reactivate", _apply_sql("v_dim", "v_rescrape", """
select * from r_result r
where not r.is_deleted and exists (
  select 1 from v_dim d where d.is_deleted and d.author_id = r.author_id and d.media_id = r.media_id
    and d.checksum = r.checksum and d.valid_from_ts = r.valid_from_ts)"""))
def scd2_reactivate(spark, sf):
    """Versions deleted before the batch and live after it (the batch re-sent them)."""
    dim = fx.v_dim(spark, sf)
    out = scd2.apply_batch(dim, fx.v_rescrape(spark, sf)).where(~F.col("is_deleted"))
    was_deleted = dim.where("is_deleted").select("author_id", "media_id", "checksum", "valid_from_ts")
    return out.join(was_deleted, ["author_id", "media_id", "checksum", "valid_from_ts"], "left_semi")


@query("scd2_rebuild_chain", with_views("select * from c_result", rebuild_ctes("c_", "v_dim", "v_daily")))
def scd2_rebuild_chain(spark, sf):
    return scd2.rebuild_chain(fx.v_dim(spark, sf), fx.v_daily(spark, sf))


@query("sink_replace_keys", with_views(f"""
select {LEGACY_COLS} from v_dim d
where not exists (select 1 from v_backfill b where b.author_id = d.author_id and b.media_id = d.media_id)
union all
select author_id, media_id, media_duration, media_blob, cast(1 as bigint) as seen_count, valid_from_ts,
       cast(null as timestamp) as valid_to_ts, true as is_current, extract_ts
from v_backfill"""))
def sink_replace_keys(spark, sf):
    """Delete the target rows of every key in the new rows, then insert them (by name)."""
    target = fx.v_dim(spark, sf).select(*scd2.LEGACY_DIM_COLUMNS)
    rows = (fx.v_backfill(spark, sf)
            .withColumn("seen_count", F.lit(1).cast("bigint"))
            .withColumn("valid_to_ts", F.lit(None).cast("timestamp_ntz"))
            .withColumn("is_current", F.lit(True)))
    return scd2.replace_keys(target, rows)


@query("dim_current", with_views("select * from v_dim where is_current"))
def dim_current(spark, sf):
    return scd2.current(fx.v_dim(spark, sf))


@query("dim_as_of", with_views("""
select * from v_dim
where valid_from_ts <= timestamp '2024-01-15 00:00:00'
  and (valid_to_ts is null or timestamp '2024-01-15 00:00:00' < valid_to_ts)
  and not is_deleted"""))
def dim_as_of(spark, sf):
    return scd2.as_of(fx.v_dim(spark, sf), AS_OF)



@query("dim_as_of_join", with_views("""
select e.event_id, cast(e.user_id as varchar) as author_id, e.event_type as media_id, e.value, e.ts + interval 36 hour as at,
       d.seen_count, d.media_duration, d.checksum, d.valid_from_ts, d.valid_to_ts
from events e left join v_dim d
  on d.author_id = cast(e.user_id as varchar) and d.media_id = e.event_type and not d.is_deleted
  and d.valid_from_ts <= e.ts + interval 36 hour and (d.valid_to_ts is null or e.ts + interval 36 hour < d.valid_to_ts)"""))
def dim_as_of_join(spark, sf):
    """Every event a day and a half later, with the version of its medium that was valid then."""
    facts = fx.events(spark, sf).select(
        "event_id", F.col("user_id").cast("string").alias("author_id"), F.col("event_type").alias("media_id"), "value",
        (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 36 HOURS")).alias("at"))
    return as_of_join(facts, fx.v_dim(spark, sf), fact_ts="at",
                      columns=["seen_count", "media_duration", "checksum", "valid_from_ts", "valid_to_ts"])
