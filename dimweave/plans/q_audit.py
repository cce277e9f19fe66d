"""Registered queries: audits, set operations, existence joins and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, reports, scd2
from ..operators.joins import anti_join, existence_flag
from . import fixtures as fx
from .oracle_views import with_views
from .registry import query
from .sql_scd2 import apply_ctes, rebuild_ctes

K4 = ["author_id", "media_id", "checksum", "valid_from_ts"]
BATCH_COLS = ["author_id", "media_id", "media_duration", "media_blob", "valid_from_ts", "extract_ts"]
PARITY_COLS = ["author_id", "media_id", "media_duration", "media_blob", "seen_count",
               "valid_from_ts", "valid_to_ts", "is_current"]


def _batches(spark, sf):
    return fx.v_daily(spark, sf).select(*BATCH_COLS).unionByName(fx.v_rescrape(spark, sf).select(*BATCH_COLS))


BATCHES = {"batches": f"""
select {', '.join(BATCH_COLS)} from v_daily union all select {', '.join(BATCH_COLS)} from v_rescrape"""}


@query("audit_row_count", with_views("""
select 'v_dim' as table_name, count(1) as cnt from v_dim
union all select 'v_chat', count(1) from v_chat
union all select 'v_daily', count(1) from v_daily
union all select 'v_rescrape', count(1) from v_rescrape"""))
def audit_row_count(spark, sf):
    parts = [audit.row_count(fx.VIEWS[n](spark, sf), n) for n in ("v_dim", "v_chat", "v_daily", "v_rescrape")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("audit_distinct_ids", with_views("""
select 'v_chat' as table_name, count(1) as n_rows, count(distinct chat_id) as n_ids from v_chat
union all select 'v_wall', count(1), count(distinct post_id) from v_wall"""))
def audit_distinct_ids(spark, sf):
    chat = audit.distinct_ids(fx.v_chat(spark, sf), "chat_id").select(F.lit("v_chat").alias("table_name"), "*")
    wall = audit.distinct_ids(fx.v_wall(spark, sf), "post_id").select(F.lit("v_wall").alias("table_name"), "*")
    return chat.unionByName(wall)


@query("audit_grain", with_views("""
select 'v_dim' as table_name, count(1) as n_rows, count(distinct row(media_id, author_id, valid_from_ts)) as n_grain
from v_dim
union all
select 'batches', count(1), count(distinct row(media_id, author_id, valid_from_ts)) from batches""", BATCHES))
def audit_grain(spark, sf):
    d = audit.grain(fx.v_dim(spark, sf)).select(F.lit("v_dim").alias("table_name"), "*")
    b = audit.grain(_batches(spark, sf)).select(F.lit("batches").alias("table_name"), "*")
    return d.unionByName(b)


@query("audit_grain_offenders", with_views("""
select media_id, author_id, valid_from_ts, count(1) as n_rows from batches
group by media_id, author_id, valid_from_ts having count(1) > 1""", BATCHES))
def audit_grain_offenders(spark, sf):
    return audit.grain_offenders(_batches(spark, sf))


@query("audit_parity", with_views(f"""
select (select count(1) from (select {', '.join(PARITY_COLS)} from c_result
                              except select {', '.join(PARITY_COLS)} from r_result) x) as a_minus_b,
       (select count(1) from (select {', '.join(PARITY_COLS)} from r_result
                              except select {', '.join(PARITY_COLS)} from c_result) y) as b_minus_a""",
                                  {**rebuild_ctes("c_", "v_dim", "v_daily"), **apply_ctes("r_", "v_dim", "v_daily")}))
def audit_parity(spark, sf):
    """The plain chain rebuild and the checksum-aware apply of the same batch, compared both ways."""
    dim, daily = fx.v_dim(spark, sf), fx.v_daily(spark, sf)
    return audit.parity(scd2.rebuild_chain(dim, daily), scd2.apply_batch(dim, daily), PARITY_COLS)


@query("setop_union_distinct", with_views(f"""
select {', '.join(BATCH_COLS)} from v_daily union select {', '.join(BATCH_COLS)} from v_rescrape"""))
def setop_union_distinct(spark, sf):
    return _batches(spark, sf).distinct()


@query("setop_union_all_by_name", with_views("""
select author_id, media_id, media_duration, media_blob, valid_from_ts, extract_ts, is_deleted, checksum from v_dim
union all by name
select checksum, false as is_deleted, extract_ts, valid_from_ts, media_blob, media_duration, media_id, author_id
from v_rescrape"""))
def setop_union_all_by_name(spark, sf):
    a = fx.v_dim(spark, sf).select("author_id", "media_id", "media_duration", "media_blob", "valid_from_ts",
                                   "extract_ts", "is_deleted", "checksum")
    b = fx.v_rescrape(spark, sf).select("checksum", F.lit(False).alias("is_deleted"), "extract_ts",
                                        "valid_from_ts", "media_blob", "media_duration", "media_id", "author_id")
    return a.unionByName(b)


@query("join_left_anti", with_views("""
select * from v_dim d where not exists (
  select 1 from v_rescrape s where s.author_id = d.author_id and s.media_id = d.media_id
    and s.checksum = d.checksum and s.valid_from_ts = d.valid_from_ts)"""))
def join_left_anti(spark, sf):
    return anti_join(fx.v_dim(spark, sf), fx.v_rescrape(spark, sf), K4)


@query("join_existence_or", with_views("""
select d.* from v_dim d
left join v_rescrape s on s.author_id = d.author_id and s.media_id = d.media_id
                      and s.checksum = d.checksum and s.valid_from_ts = d.valid_from_ts
where (s.media_id is not null and not d.is_deleted)
   or not exists (select 1 from v_rescrape k where k.author_id = d.author_id and k.media_id = d.media_id)"""))
def join_existence_or(spark, sf):
    """Dimension rows matched live by the batch, or whose key the batch lacks."""
    dim, batch = fx.v_dim(spark, sf), fx.v_rescrape(spark, sf)
    flagged = existence_flag(existence_flag(dim, batch, K4, "_m4"), batch, ["author_id", "media_id"], "_mk")
    return flagged.where((F.col("_m4") & ~F.col("is_deleted")) | ~F.col("_mk")).drop("_m4", "_mk")


_REPORT = """
select author_id, media_id, seen_count, media_duration, valid_from_ts, valid_to_ts, is_current, is_deleted
from v_dim where media_duration > 0 and {cond}
order by author_id, media_id, valid_from_ts, seen_count"""


@query("report_first_versions", with_views(_REPORT.format(cond="seen_count = 1")))
def report_first_versions(spark, sf):
    return reports.first_versions(fx.v_dim(spark, sf))


@query("report_changed_versions", with_views(_REPORT.format(cond="(seen_count > 1 or not is_current)")))
def report_changed_versions(spark, sf):
    return reports.changed_versions(fx.v_dim(spark, sf))


@query("report_point_lookup", with_views("""
select * from v_dim
where media_id = 'purchase'
  and valid_from_ts = (select min(valid_from_ts) from v_dim where media_id = 'purchase')"""))
def report_point_lookup(spark, sf):
    dim = fx.v_dim(spark, sf)
    first = dim.where(F.col("media_id") == "purchase").agg(F.min("valid_from_ts")).scalar()
    return reports.point_lookup(dim, "purchase", first)


@query("limit_sample", with_views("""
select author_id, media_id, media_duration, media_blob, seen_count, valid_from_ts, valid_to_ts, is_current, extract_ts
from v_dim order by author_id, media_id, valid_from_ts limit 1"""))
def limit_sample(spark, sf):
    return reports.sample_row(fx.v_dim(spark, sf).select(*scd2.LEGACY_DIM_COLUMNS),
                              ["author_id", "media_id", "valid_from_ts"])


@query("audit_intervals", with_views("""
select author_id, media_id, n_versions, n_current, n_deleted, n_gaps, n_overlaps, issue
from (
  select *, concat_ws(',', case when n_current = 0 and n_deleted < n_versions then 'no current' end,
                      case when n_current > 1 then 'several current' end,
                      case when n_gaps > 0 then 'gap' end, case when n_overlaps > 0 then 'overlap' end) as issue
  from (
    select author_id, media_id, count(*) as n_versions, count(*) filter (is_current) as n_current, count(*) filter (is_deleted) as n_deleted,
           count(*) filter (valid_from_ts > ended) as n_gaps, count(*) filter (valid_from_ts < ended) as n_overlaps
    from (
      select *, max(coalesce(valid_to_ts, timestamp '9999-12-31 23:59:59.999999')) over (
                  partition by author_id, media_id order by valid_from_ts, coalesce(valid_to_ts, timestamp '9999-12-31 23:59:59.999999')
                  rows between unbounded preceding and 1 preceding) as ended
      from r_result)
    group by author_id, media_id))
where issue <> ''""", apply_ctes("r_", "v_dim", "v_rescrape")))
def audit_intervals(spark, sf):
    """Keys without one gapless chain after a re-scrape: no current version, several, gaps, overlaps."""
    return audit.intervals(scd2.apply_batch(fx.v_dim(spark, sf), fx.v_rescrape(spark, sf)))
