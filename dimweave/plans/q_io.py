"""Registered queries that write and read back: JSON pages, staging, versions, history,
merges, the full load run and the streaming ingest.  All files go to a fresh
folder under the session's checkpoint directory."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from ..operators import merge as mg, scd2
from ..schemas import CHAT_PAGE_SCHEMA, DIM_SCHEMA, WALL_PAGE_SCHEMA, split_null_keys
from ..session import work_dir
from ..operators.flatten import flatten_wall
from ..sources import json_pages as jp, tables as tb
from ..sources.buckets import KeyBuckets
from ..sources.partitioned import PartitionedDimension
from ..streaming.ingest import ingest_pages, ingest_wall, read_staging
from . import fixtures as fx
from .load import DimensionStore, run_load, run_rebuild
from .oracle_views import with_views
from .q_dimension import EMPTY_DIM_SQL
from .registry import query
from .sql_scd2 import DIM_COLS, LEGACY_COLS, apply_ctes, rebuild_ctes

FLAT_V_CHAT = """
select chat_id, fromUser.id as author_id, array_to_string(media, '|') as media_text,
       cast(len(media) as bigint) as n_media, price, created_ts
from v_chat"""

RUN_1 = dt.datetime(2024, 1, 15)
RUN_2 = dt.datetime(2024, 2, 1)


def _pages(spark, sf, name, **kw):
    path = work_dir(spark, name)
    jp.write_chat_pages(fx.v_chat(spark, sf), path, **kw)
    return path


@query("src_json_scan", with_views(FLAT_V_CHAT))
def src_json_scan(spark, sf):
    """Chat pages (JSON arrays, one page per line) read back with the fixed staging schema."""
    path = _pages(spark, sf, "json-scan")
    return jp.flat_chat_view(jp.read_pages(spark, path, CHAT_PAGE_SCHEMA))


@query("src_schema_from_sample", with_views(FLAT_V_CHAT))
def src_schema_from_sample(spark, sf):
    """Schema inferred once from the first day's pages, saved, reloaded and used for all pages."""
    path = _pages(spark, sf, "schema-sample")
    first_day = fx.v_chat(spark, sf).agg(F.min(F.to_date("created_ts"))).first()[0]
    schema = jp.schema_from_sample(spark, f"{path}/page_date={first_day}",
                                   declared={"media": T.ArrayType(T.StringType())})
    jp.save_schema(spark, schema, f"{path}/_schema")
    pinned = jp.load_schema(spark, f"{path}/_schema")
    return jp.flat_chat_view(jp.read_pages(spark, path, pinned))


@query("src_conform_to_target", with_views(FLAT_V_CHAT))
def src_conform_to_target(spark, sf):
    """Pages carrying extra fields, read with the schema saved from a sample, projected onto the target."""
    path = _pages(spark, sf, "conform", extra={"files": "null", "isMarkdownDisabled": "true"})
    first_day = fx.v_chat(spark, sf).agg(F.min(F.to_date("created_ts"))).first()[0]
    sample = jp.schema_from_sample(spark, f"{path}/page_date={first_day}", declared={"media": T.ArrayType(T.StringType())})
    jp.save_schema(spark, sample, saved := work_dir(spark, "conform-schema"))
    staged = jp.conform_to_target(jp.read_pages(spark, path, jp.load_schema(spark, saved)), CHAT_PAGE_SCHEMA)
    return jp.flat_chat_view(staged)


@query("src_page_envelope", with_views("""
select chat_id, fromUser.id as author_id, created_ts,
       not (cast(created_ts as date) = (select max(cast(created_ts as date)) from v_chat)
            and chat_id // 10 = (select max(chat_id // 10) from v_chat
                                 where cast(created_ts as date) = (select max(cast(created_ts as date)) from v_chat)))
         as has_more
from v_chat"""))
def src_page_envelope(spark, sf):
    """Pages wrapped as {"list": [...], "hasMore": ..}: one row per list element plus the flag."""
    path = _pages(spark, sf, "envelope", envelope=True)
    recs = jp.read_envelope(spark, path, CHAT_PAGE_SCHEMA)
    return recs.select(F.col("id").alias("chat_id"), F.col("fromUser.id").alias("author_id"),
                       F.col("createdAt").cast("timestamp_ntz").alias("created_ts"),
                       F.col("hasMore").alias("has_more"))


@query("sink_insert_by_name", with_views(FLAT_V_CHAT))
def sink_insert_by_name(spark, sf):
    """Pages appended to a staging table by column name (input columns in another order)."""
    path = _pages(spark, sf, "by-name")
    table = work_dir(spark, "staging-by-name")
    rows = jp.read_pages(spark, path, CHAT_PAGE_SCHEMA)
    shuffled = rows.select(*reversed(rows.columns))
    tb.insert_by_name(CHAT_PAGE_SCHEMA, shuffled, table)
    return jp.flat_chat_view(spark.read.schema(CHAT_PAGE_SCHEMA).parquet(table))


@query("sink_inserted_count", with_views("""
select count(*) filter (where created_ts < lo or created_ts > hi) as inserted_rows,
       count(*) filter (where created_ts >= timestamp '2024-01-08 00:00:00' and created_ts < timestamp '2024-01-22 00:00:00')
       + count(*) filter (where created_ts < lo or created_ts > hi) as staged_rows
from v_chat, (select min(created_ts) as lo, max(created_ts) as hi from v_chat
              where created_ts >= timestamp '2024-01-08 00:00:00' and created_ts < timestamp '2024-01-22 00:00:00') b"""))
def sink_inserted_count(spark, sf):
    """Staging holds two weeks; loading every page inserts only rows outside them, counted on the write."""
    path = _pages(spark, sf, "count")
    table = work_dir(spark, "staging-count")
    pages = jp.read_pages(spark, path, CHAT_PAGE_SCHEMA)
    t = F.col("createdAt").cast("timestamp_ntz")
    first = pages.where((t >= F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"))
                        & (t < F.lit("2024-01-22 00:00:00").cast("timestamp_ntz")))
    tb.insert_by_name(CHAT_PAGE_SCHEMA, first, table)
    n = tb.append_outside_range(spark, table, CHAT_PAGE_SCHEMA, pages, "createdAt", RUN_2)
    staged = spark.read.schema(CHAT_PAGE_SCHEMA).parquet(table)
    return staged.agg(F.count(F.lit(1)).alias("staged_rows")).select(
        F.lit(n).cast("bigint").alias("inserted_rows"), "staged_rows")


@query("stream_ingest_pages", with_views(FLAT_V_CHAT + " where created_ts is not null"))
def stream_ingest_pages(spark, sf):
    """Structured Streaming over the page folder (availableNow): staging rows read back."""
    path = _pages(spark, sf, "stream-pages")
    root = work_dir(spark, "stream")
    store = DimensionStore(spark, f"{root}/store")
    ingest_pages(spark, path, store, f"{root}/staging", f"{root}/_checkpoint", RUN_2, max_files_per_trigger=20, apply_dimension=False)
    return jp.flat_chat_view(read_staging(spark, f"{root}/staging"))


@query("sink_publish_version", with_views("select * from r_result", apply_ctes("r_", "v_dim", "v_daily")))
def sink_publish_version(spark, sf):
    """v1 = the dimension; v2 = v1 with the daily batch applied, computed from v1 while v1 stays current."""
    t = tb.VersionedTable(spark, work_dir(spark, "publish"))
    v1 = t.publish(fx.v_dim(spark, sf))
    t.publish(scd2.apply_batch(t.read(v1), fx.v_daily(spark, sf)))
    return t.read(schema=DIM_SCHEMA)


@query("history_append_snapshot", with_views(f"""
select {DIM_COLS}, cast(1 as bigint) as run_id from v_dim
union all
select {DIM_COLS}, cast(2 as bigint) as run_id from r_result""", apply_ctes("r_", "v_dim", "v_daily")))
def history_append_snapshot(spark, sf):
    """Whole-dimension snapshots appended per run (run 1: the dimension, run 2: after the daily batch)."""
    path = work_dir(spark, "history")
    dim = fx.v_dim(spark, sf)
    tb.append_snapshot(path, dim, 1)
    tb.append_snapshot(path, scd2.apply_batch(dim, fx.v_daily(spark, sf)), 2)
    return tb.read_history(spark, path)


@query("history_replace", with_views("select * from v_dim"))
def history_replace(spark, sf):
    """History as a full copy of the dimension (replaced on every run)."""
    t = tb.VersionedTable(spark, work_dir(spark, "history-copy"))
    tb.replace_history(t, fx.v_dim(spark, sf))
    return t.read(schema=DIM_SCHEMA)


def _batch_ctes(p: str, chat: str, dim: str, run_ts: str) -> dict[str, str]:
    return {f"{p}batch": f"""
select distinct author_id, json_extract_string(media_blob, '$.id') as media_id,
       json_extract_string(media_blob, '$.duration') as media_duration, media_blob,
       1 as seen_count, created_ts as valid_from_ts, cast(null as timestamp) as valid_to_ts,
       true as is_current,
       cast((timestamp '{run_ts}' at time zone 'UTC') at time zone 'US/Eastern' as timestamp) as extract_ts
from (select fromUser.id as author_id, created_ts, unnest(media) as media_blob from {chat}
      where created_ts < coalesce((select min(valid_from_ts) from {dim}), timestamp '{run_ts}' + interval 1 day)
         or created_ts > coalesce((select max(valid_from_ts) from {dim}), timestamp '{run_ts}' - interval 99 year)) z"""}


_FULL = {**EMPTY_DIM_SQL,
         "chat_first": "select * from v_chat where created_ts < timestamp '2024-01-15 00:00:00'",
         **_batch_ctes("b1_", "chat_first", "empty_dim", "2024-01-15 00:00:00"),
         **apply_ctes("d1_", "empty_dim", "b1_batch"),
         **_batch_ctes("b2_", "v_chat", "d1_result", "2024-02-01 00:00:00"),
         **apply_ctes("d2_", "d1_result", "b2_batch")}


@query("scd2_full_run", with_views("select * from d2_result", _FULL))
def scd2_full_run(spark, sf):
    """Two load runs from staging chat: the first two weeks, then everything (only newer rows pass)."""
    store = DimensionStore(spark, work_dir(spark, "full-run"))
    chat = fx.v_chat(spark, sf)
    run_load(store, chat.where(F.col("created_ts") < F.lit(RUN_1).cast("timestamp_ntz")), RUN_1, run_id=1)
    run_load(store, chat, RUN_2, run_id=2)
    return store.current()


@query("stream_ingest_dimension", with_views("select * from n_result", {
    **EMPTY_DIM_SQL, **_batch_ctes("n_", "v_chat", "empty_dim", "2024-02-01 00:00:00"), **apply_ctes("n_", "empty_dim", "n_batch")}))
def stream_ingest_dimension(spark, sf):
    """The dimension after a streamed run of many micro-batches: one apply of the whole run."""
    path = _pages(spark, sf, "stream-dim-pages")
    root = work_dir(spark, "stream-dim")
    store = DimensionStore(spark, f"{root}/store")
    ingest_pages(spark, path, store, f"{root}/staging", f"{root}/_checkpoint", RUN_2, max_files_per_trigger=20)
    return store.current()


_MERGE_TGT = {
    "m_tgt": f"select {LEGACY_COLS} from v_dim where cast(author_id as int) % 10 <> 2",
}


def _merge_ctes(p: str, tgt: str, src: str) -> dict[str, str]:
    close = "s.media_id is not null and s.valid_from_ts > t.valid_from_ts and t.is_current"
    bump = f"s.media_id is not null and not ({close}) and s.valid_from_ts <= t.valid_from_ts"
    return {
        f"{p}merged": f"""
select t.author_id, t.media_id, t.media_duration, t.media_blob,
       case when {bump} then t.seen_count + 1 else t.seen_count end as seen_count,
       t.valid_from_ts,
       case when {close} then s.valid_from_ts else t.valid_to_ts end as valid_to_ts,
       case when {close} then false else t.is_current end as is_current,
       t.extract_ts,
       case when ({close}) or ({bump}) then 'UPDATE' end as merge_action
from {tgt} t left join {src} s on t.author_id = s.author_id and t.media_id = s.media_id""",
        f"{p}inserts": f"""
select s.author_id, s.media_id, s.media_duration, s.media_blob, cast(1 as bigint) as seen_count,
       s.valid_from_ts, cast(null as timestamp) as valid_to_ts, true as is_current,
       cast(null as timestamp) as extract_ts, 'INSERT' as merge_action
from {src} s where not exists (select 1 from {tgt} t where t.author_id = s.author_id and t.media_id = s.media_id)""",
        f"{p}result": f"select * from {p}merged union all select * from {p}inserts",
    }


@query("merge_upsert_actions", with_views("select * from m_result",
                                          {**_MERGE_TGT, **_merge_ctes("m_", "m_tgt", "v_merge_src")}))
def merge_upsert_actions(spark, sf):
    """MERGE of a key-unique batch: close, bump and insert, with the action of each row."""
    tgt = fx.v_dim(spark, sf).where(F.col("author_id").cast("int") % 10 != 2)
    return mg.merge_upsert(tgt, fx.v_merge_src(spark, sf))


_LEGACY = {
    "l_tgt": f"select {LEGACY_COLS} from v_dim",
    "l_src": """select * from v_merge_src s
                where exists (select 1 from v_dim d where d.author_id = s.author_id and d.media_id = s.media_id)""",
    **_merge_ctes("lm_", "l_tgt", "l_src"),
    "l_newest": """
select author_id, media_id, valid_from_ts, seen_count from lm_result
where exists (select 1 from l_src s where s.author_id = lm_result.author_id and s.media_id = lm_result.media_id)
qualify row_number() over (partition by author_id, media_id order by valid_from_ts desc, seen_count desc) = 1""",
    "l_again": """
select s.author_id, s.media_id, s.media_duration, s.media_blob,
       cast(case when s.valid_from_ts > n.valid_from_ts then n.seen_count + 1 else 1 end as bigint) as seen_count,
       s.valid_from_ts,
       case when s.valid_from_ts > n.valid_from_ts then cast(null as timestamp) else n.valid_from_ts end as valid_to_ts,
       s.valid_from_ts > n.valid_from_ts as is_current, cast(null as timestamp) as extract_ts
from l_src s join l_newest n on s.author_id = n.author_id and s.media_id = n.media_id
where not exists (select 1 from lm_inserts)""",
}


@query("scd2_merge_legacy", with_views(f"select {LEGACY_COLS} from lm_result union all select * from l_again",
                                       _LEGACY))
def scd2_merge_legacy(spark, sf):
    """Legacy merge with a batch of keys the dimension already holds (re-insert path)."""
    dim = fx.v_dim(spark, sf)
    src = fx.v_merge_src(spark, sf).join(dim.select("author_id", "media_id").distinct(),
                                         ["author_id", "media_id"], "left_semi")
    return mg.merge_legacy(dim, src)


@query("src_reject_null_keys", with_views("""
select * from (select author_id, case when media_duration = 0 then null else media_id end as media_id,
                      media_duration, media_blob, valid_from_ts, checksum from v_versions) z
where author_id is not null and media_id is not null"""))
def src_reject_null_keys(spark, sf):
    """Rows with a null key part go to the reject output; the accepted rows are returned."""
    v = fx.v_versions(spark, sf).withColumn(
        "media_id", F.when(F.col("media_duration") == 0, F.lit(None)).otherwise(F.col("media_id")))
    accepted, _rejected = split_null_keys(v)
    return accepted


@query("src_rejected_rows", with_views("""
select author_id, media_id, media_duration, media_blob, valid_from_ts, checksum,
       case when author_id is null and media_id is null then 'author_id, media_id'
            when author_id is null then 'author_id' else 'media_id' end as null_columns
from (select author_id, case when media_duration = 0 then null else media_id end as media_id,
             media_duration, media_blob, valid_from_ts, checksum from v_versions) z
where author_id is null or media_id is null"""))
def src_rejected_rows(spark, sf):
    """The reject output: rows with a null key part and the columns that are null."""
    v = fx.v_versions(spark, sf).withColumn(
        "media_id", F.when(F.col("media_duration") == 0, F.lit(None)).otherwise(F.col("media_id")))
    _accepted, rejected = split_null_keys(v)
    return rejected.select("author_id", "media_id", "media_duration", "media_blob", "valid_from_ts", "checksum",
                           F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in ("author_id", "media_id")]).alias("null_columns"))


@query("scd2_partition_apply", with_views("select * from r_result", apply_ctes("r_", "v_dim", "v_daily")))
def scd2_partition_apply(spark, sf):
    """The daily batch applied in place to a dimension stored by day of start; only days with a changed row are written."""
    store = PartitionedDimension(spark, f"{work_dir(spark, 'partitioned')}/dim", unit="day")
    store.create(fx.v_dim(spark, sf))
    store.apply(fx.v_daily(spark, sf))
    return store.read()


# Chat of which some messages lack their author and some payloads their id.
_HOLED = {"v_holed": """
select chat_id, case when chat_id % 13 = 5 then struct_pack(id := cast(null as varchar)) else fromUser end as fromUser,
       case when chat_id % 7 = 2 then list_transform(media, lambda m: replace(m, '"id"', '"no"')) else media end as media, price, created_ts
from v_chat"""}


def _holed(spark, sf):
    chat, cid = fx.v_chat(spark, sf), F.col("chat_id")
    nobody = F.struct(F.lit(None).cast("string").alias("id"))
    return chat.select("chat_id", F.when(cid % 13 == 5, nobody).otherwise(F.col("fromUser")).alias("fromUser"),
                       F.when(cid % 7 == 2, F.transform("media", lambda m: F.replace(m, F.lit('"id"'), F.lit('"no"')))).otherwise(F.col("media")).alias("media"),
                       "price", "created_ts")


@query("load_rejected_rows", with_views("""
select author_id, media_id, media_duration, media_blob, valid_from_ts,
       concat_ws(', ', case when author_id is null then 'author_id' end, case when media_id is null then 'media_id' end) as null_columns,
       n_read, n_read - n_rejected as n_accepted, n_rejected
from (select *, count(*) over () as n_read, count(*) filter (author_id is null or media_id is null) over () as n_rejected from h_batch)
where author_id is null or media_id is null""", {**EMPTY_DIM_SQL, **_HOLED, **_batch_ctes("h_", "v_holed", "empty_dim", "2024-02-01 00:00:00")}))
def load_rejected_rows(spark, sf):
    """Rows a load run rejects, saved by the same write as the accepted ones, with the counts observed on it."""
    store = DimensionStore(spark, work_dir(spark, "rejects"))
    run_load(store, _holed(spark, sf), RUN_2, run_id=1, history=False)
    n = store.counts
    return store.rejects().select("author_id", "media_id", "media_duration", "media_blob", "valid_from_ts", "null_columns",
                                  *[F.lit(n[k]).cast("bigint").alias(f"n_{k}") for k in ("read", "accepted", "rejected")])


@query("load_accepted_rows", with_views("select * from d_result", {
    **EMPTY_DIM_SQL, **_HOLED, **_batch_ctes("h_", "v_holed", "empty_dim", "2024-02-01 00:00:00"), **apply_ctes("d_", "empty_dim", "h_batch")}))
def load_accepted_rows(spark, sf):
    """The dimension of the same run: the accepted rows alone."""
    store = DimensionStore(spark, work_dir(spark, "accepts"))
    run_load(store, _holed(spark, sf), RUN_2, run_id=1, history=False)
    return store.current()


_REBUILD = {**EMPTY_DIM_SQL, "chat_first": _FULL["chat_first"], **_batch_ctes("c1_", "chat_first", "empty_dim", "2024-01-15 00:00:00"),
            **rebuild_ctes("e1_", "empty_dim", "c1_batch"), **_batch_ctes("c2_", "v_chat", "e1_result", "2024-02-01 00:00:00"),
            **rebuild_ctes("e2_", "e1_result", "c2_batch")}


@query("rebuild_full_run", with_views(f"""
select {LEGACY_COLS}, cast(1 as bigint) as run_id from e1_result
union all
select {LEGACY_COLS}, cast(2 as bigint) as run_id from e2_result""", _REBUILD))
def rebuild_full_run(spark, sf):
    """Two runs of the chain-rebuild flavour and the snapshots they leave; the second run is told twice and counts once."""
    store = DimensionStore(spark, work_dir(spark, "rebuild-run"))
    chat = fx.v_chat(spark, sf)
    run_rebuild(store, chat.where(F.col("created_ts") < F.lit(RUN_1).cast("timestamp_ntz")), RUN_1, run_id=1)
    run_rebuild(store, chat, RUN_2, run_id=2)
    run_rebuild(store, chat, RUN_2, run_id=2)
    return store.history()


@query("wall_ingest", with_views("""
select author_id, post_id, media_id, posted_ts, cast(posted_ts as date) as posted_date from v_wall where posted_ts is not null"""))
def wall_ingest(spark, sf):
    """Wall pages through their own stream into their own staging table, flattened to a row per medium."""
    path = work_dir(spark, "wall-pages")
    jp.write_wall_pages(fx.v_wall(spark, sf), path)
    root = work_dir(spark, "wall-stream")
    ingest_wall(spark, path, f"{root}/staging", f"{root}/_checkpoint", RUN_2, max_files_per_trigger=20)
    return flatten_wall(read_staging(spark, f"{root}/staging", WALL_PAGE_SCHEMA))


@query("src_wall_json_scan", with_views("select author_id, post_id, media_id, posted_ts, cast(posted_ts as date) as posted_date from v_wall"))
def src_wall_json_scan(spark, sf):
    """Wall pages read back with the fixed wall schema."""
    path = work_dir(spark, "wall-scan")
    jp.write_wall_pages(fx.v_wall(spark, sf), path)
    return flatten_wall(jp.read_pages(spark, path, WALL_PAGE_SCHEMA))


@query("lookup_key_bucket", with_views("""
select * from v_dim where author_id = (select min(author_id) from v_dim) and media_id = 'purchase'"""))
def lookup_key_bucket(spark, sf):
    """All versions of one medium from a dimension bucketed by its key: one folder is read."""
    store = KeyBuckets(spark, f"{work_dir(spark, 'buckets')}/dim", DIM_SCHEMA, buckets=16)
    dim = fx.v_dim(spark, sf)
    store.write(dim)
    return store.lookup(dim.agg(F.min("author_id")).first()[0], "purchase")


@query("join_touched_buckets", with_views("""
select * from v_dim d where exists (select 1 from v_daily b where b.author_id = d.author_id and b.media_id = d.media_id)"""))
def join_touched_buckets(spark, sf):
    """The stored versions of a batch's keys, from a dimension bucketed by its key."""
    store = KeyBuckets(spark, f"{work_dir(spark, 'buckets')}/dim", DIM_SCHEMA, buckets=16)
    store.write(fx.v_dim(spark, sf))
    return store.touched(fx.v_daily(spark, sf))
