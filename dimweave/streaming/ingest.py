"""Streaming ingest of JSON pages: chat into staging and the type 2 dimension, wall posts into staging.

``foreachBatch`` only stages: the rows outside the staging table's range go to
a folder of their own per run and micro-batch.  When the pages are drained,
the source batch of the whole run is built and applied to the dimension once.

* A run is recorded before its stream starts, with the time ranges that
  staging and the dimension hold at that moment.  A run that dies is resumed
  under the same id and ranges, so nothing it staged itself shuts out its
  later pages, and a newest-first feed keeps its older pages.
* Every step may be repeated: a micro-batch overwrites its own folder, a
  dimension version is tagged with the run id, and a snapshot that a crash
  left out is written when the run is resumed.
* How files fall into micro-batches does not reach the dimension, since only
  the whole run is applied.
* ``trigger(availableNow=True)`` drains what is there and stops, which
  replaces the feed's own stop rule (no more pages / nothing inserted).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.time import lit_ts, minus_years, plus_days
from ..operators.incremental import build_source_batch
from ..plans.load import DimensionStore, applied
from ..schemas import CHAT_PAGE_SCHEMA, DIM_SCHEMA, WALL_PAGE_SCHEMA
from ..session import path_exists
from ..sources.tables import append_snapshot

RUN_SCHEMA = ("run_id string, checkpoint string, state string, noted_at timestamp_ntz, lo timestamp_ntz, hi timestamp_ntz, "
              "dim_lo timestamp_ntz, dim_hi timestamp_ntz")


def _batches_path(staging_path: str) -> str:
    return f"{staging_path.rstrip('/')}/pages"


def _runs_path(staging_path: str) -> str:
    return f"{staging_path.rstrip('/')}/runs"


def _note(spark: SparkSession, staging_path: str, row: tuple) -> None:
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(_runs_path(staging_path))


def _open_run(spark: SparkSession, staging_path: str, checkpoint: str) -> dict | None:
    """The run of this checkpoint that was begun and not finished, if any."""
    path = _runs_path(staging_path)
    if not path_exists(spark, path):
        return None
    runs = spark.read.schema(RUN_SCHEMA).parquet(path).where(F.col("checkpoint") == checkpoint)
    last = runs.orderBy(F.col("noted_at").desc(), F.col("state").asc()).first()
    return last.asDict() if last is not None and last["state"] == "open" else None


def read_staging(spark: SparkSession, staging_path: str, schema: T.StructType = CHAT_PAGE_SCHEMA) -> DataFrame:
    """All staged rows of all runs."""
    path = _batches_path(staging_path)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _begin(spark: SparkSession, staging_path: str, checkpoint: str, schema: T.StructType, ts: str, dim_range: tuple) -> dict:
    """The open run of this checkpoint, or a new one, recorded with the ranges held now."""
    run = _open_run(spark, staging_path, checkpoint)
    if run is None:
        t = F.col(ts).cast("timestamp_ntz")
        lo, hi = read_staging(spark, staging_path, schema).agg(F.min(t), F.max(t)).first()
        run = dict(run_id=uuid.uuid4().hex, checkpoint=checkpoint, state="open", noted_at=dt.datetime.now(), lo=lo, hi=hi, dim_lo=dim_range[0], dim_hi=dim_range[1])
        _note(spark, staging_path, tuple(run.values()))
    return run


def _end(spark: SparkSession, staging_path: str, run: dict) -> None:
    _note(spark, staging_path, (run["run_id"], run["checkpoint"], "done", dt.datetime.now(), run["lo"], run["hi"], run["dim_lo"], run["dim_hi"]))


def _drain(spark: SparkSession, pages_dir: str, staging_path: str, run: dict, run_ts: dt.datetime, schema: T.StructType, ts: str,
           max_files_per_trigger: int | None, multi_line: bool, envelope: bool) -> tuple[DataFrame | None, dict]:
    """Stages the run's rows outside the range it began with; ``(staged rows of the run, counters)``."""
    now = lit_ts(run_ts)
    lo = F.lit(run["lo"]).cast("timestamp_ntz") if run["lo"] is not None else plus_days(now, 1)
    hi = F.lit(run["hi"]).cast("timestamp_ntz") if run["hi"] is not None else minus_years(now, 99)
    run_path = f"{_batches_path(staging_path)}/run={run['run_id']}"
    stats = {"run_id": run["run_id"], "batches": 0, "inserted": 0, "versions": []}

    page = T.StructType([T.StructField("list", T.ArrayType(schema)), T.StructField("hasMore", T.BooleanType())]) if envelope else schema
    reader = spark.readStream.schema(page).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    pages = reader.json(pages_dir)
    if envelope:
        pages = pages.select(F.explode("list").alias("_r")).select("_r.*")

    def stage(df: DataFrame, batch_id: int) -> None:
        t = F.col(ts).cast("timestamp_ntz")
        rows = df.where((t < lo) | (t > hi))
        (rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
             .write.mode("overwrite").parquet(f"{run_path}/batch={int(batch_id)}"))
        stats["batches"] += 1

    q = (pages.writeStream.foreachBatch(stage)
         .option("checkpointLocation", run["checkpoint"])
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not path_exists(spark, run_path):
        return None, stats
    staged = spark.read.schema(schema).parquet(run_path)
    stats["inserted"] = staged.count()
    return staged, stats


def ingest_pages(spark: SparkSession, pages_dir: str, store: DimensionStore, staging_path: str,
                 checkpoint: str, run_ts: dt.datetime, *, schema: T.StructType = CHAT_PAGE_SCHEMA,
                 ts: str = "createdAt", max_files_per_trigger: int | None = None,
                 apply_dimension: bool = True, multi_line: bool = False, envelope: bool = False) -> dict:
    """Drain the pages folder once; returns per-run counters (``accepted`` and ``rejected`` rows of the batch if it was applied).

    ``multi_line`` reads indented page files, ``envelope`` pages of the form
    ``{"list": [...], "hasMore": ..}``.
    """
    run = _begin(spark, staging_path, checkpoint, schema, ts, store.dim.time_range(ts_col="valid_from_ts"))
    staged, stats = _drain(spark, pages_dir, staging_path, run, run_ts, schema, ts, max_files_per_trigger, multi_line, envelope)
    if staged is not None and apply_dimension and stats["inserted"]:
        version = _apply_run(store, staged, run, run_ts, ts)
        stats |= {k: v for k, v in store.counts.items() if k != "read"}
        if version is not None:
            stats["versions"].append(version)
    _end(spark, staging_path, run)
    return stats


def ingest_wall(spark: SparkSession, pages_dir: str, staging_path: str, checkpoint: str, run_ts: dt.datetime, *,
                schema: T.StructType = WALL_PAGE_SCHEMA, ts: str = "postedAt", max_files_per_trigger: int | None = None,
                multi_line: bool = False, envelope: bool = False) -> dict:
    """Drain a folder of wall pages once into their own staging table; wall posts feed no dimension.

    The feed has a schema, a range and run records of its own; a run that died
    is resumed like a chat run.  Posts without a time never pass the range.
    """
    run = _begin(spark, staging_path, checkpoint, schema, ts, (None, None))
    _, stats = _drain(spark, pages_dir, staging_path, run, run_ts, schema, ts, max_files_per_trigger, multi_line, envelope)
    _end(spark, staging_path, run)
    return stats


def _apply_run(store: DimensionStore, staged: DataFrame, run: dict, run_ts: dt.datetime, ts: str) -> int | None:
    """Apply a run's staged rows to the dimension once; a repeated call completes what is missing."""
    tag = f"stream-run-{run['run_id']}"
    version = store.dim.tagged(tag)
    if version is None:
        dim = store.current()
        batch = build_source_batch(staged, dim, run_ts, chat_id="id", created=ts, known_range=(run["dim_lo"], run["dim_hi"]))
        accepted = store.stage(batch, tag=tag)
        if store.counts["accepted"] == 0:
            return None
        version = store.dim.publish(applied(dim, accepted, store.counts["accepted"]), tag=tag, ts_col="valid_from_ts")
    if not path_exists(store.spark, f"{store.history_path}/run_id={version}"):
        append_snapshot(store.history_path, store.dim.read(version, schema=DIM_SCHEMA), version)
    return version
