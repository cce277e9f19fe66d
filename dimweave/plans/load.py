"""Load runs: staging chat -> source batch -> dimension -> history.

Each stage is written to the shared work folder before the next one reads
it, so a run's plan never grows past one stage of lineage and a lost
executor only recomputes that stage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.incremental import build_source_batch
from ..operators.scd2 import apply_batch, rebuild_chain
from ..schemas import (DIM_SCHEMA, LEGACY_DIM_COLUMNS, SOURCE_BATCH_COLUMNS, STAGED_BATCH_SCHEMA, conform_dim,
                       null_columns, split_null_keys)
from ..session import path_exists
from ..sources.tables import VersionedTable, append_snapshot, read_history

LEGACY_DIM_SCHEMA = T.StructType([DIM_SCHEMA[c] for c in LEGACY_DIM_COLUMNS])


def clustered(dim: DataFrame) -> DataFrame:
    """Sort each task's rows by (key, start) before writing: parquet row groups
    then carry tight min/max statistics on the key, so point lookups and key
    filters skip most of a file.  A local sort, no shuffle."""
    return dim.sortWithinPartitions("author_id", "media_id", "valid_from_ts")


class DimensionStore:
    """Folders of one dimension: current versions, staged batches with their rejects, history snapshots."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.dim = VersionedTable(spark, f"{self.root}/dim")
        self.batches = VersionedTable(spark, f"{self.root}/batches")
        self.history_path = f"{self.root}/history"
        self.counts: dict[str, int] = {}  # of the last staged batch: read, accepted, rejected

    def current(self, schema: T.StructType = DIM_SCHEMA) -> DataFrame:
        d = self.dim.read(schema=schema)
        return self.spark.createDataFrame([], schema) if d is None else d

    def history(self) -> DataFrame:
        return read_history(self.spark, self.history_path)

    def stage(self, batch: DataFrame, tag: str | None = None) -> DataFrame:
        """Writes a source batch once, as two outputs, and returns the accepted rows.

        Rows with a null key part go to the folder ``rejected=true`` with the
        names of these columns; ``counts`` is observed on the write.
        """
        marked = batch.select(*SOURCE_BATCH_COLUMNS, null_columns().alias("null_columns"))
        marked = marked.withColumn("rejected", F.col("null_columns").isNotNull())
        seen = Observation("staged")
        marked = marked.observe(seen, F.count(F.lit(1)).alias("read"), F.count(F.when(F.col("rejected"), 1)).alias("rejected"))
        version = self.batches.publish(marked, partition_by=["rejected"], tag=tag)
        got = seen.get
        self.counts = {"read": got["read"], "accepted": got["read"] - got["rejected"], "rejected": got["rejected"]}
        return self.batches.read(version, STAGED_BATCH_SCHEMA).where("not rejected").drop("rejected", "null_columns")

    def rejects(self, version: int | None = None) -> DataFrame | None:
        """The rejected rows of a staged batch (default: the last one) and which of their key columns are null."""
        staged = self.batches.read(version, STAGED_BATCH_SCHEMA)
        return None if staged is None else staged.where("rejected").drop("rejected")


def run_load(store: DimensionStore, chat: DataFrame, run_ts: dt.datetime, *, run_id: int,
             guard_days: int | None = None, chat_id: str = "chat_id", created: str = "created_ts",
             history: bool = True) -> int | None:
    """Apply the chat rows outside the dimension's loaded range; returns the new
    dimension version, or ``None`` when no row was accepted (an empty batch
    would clear every delete flag, so it is skipped).  Rows with a null key part are
    saved by the same write (``store.rejects()``, ``store.counts``)."""
    dim = store.current()
    seen = store.dim.time_range(ts_col="valid_from_ts")
    batch = build_source_batch(chat, dim, run_ts, guard_days=guard_days, chat_id=chat_id, created=created,
                               known_range=seen)
    staged = store.stage(batch)
    if store.counts["accepted"] == 0:
        return None
    v = store.dim.publish(applied(dim, staged, store.counts["accepted"]), ts_col="valid_from_ts")
    if history:
        append_snapshot(store.history_path, store.dim.read(v, schema=DIM_SCHEMA), run_id)
    return v


def applied(dim: DataFrame, staged: DataFrame, n: int) -> DataFrame:
    """The dimension after a staged batch, ready to be written; stored rows without a key stay as they are."""
    keyed, odd = split_null_keys(dim)
    return clustered(conform_dim(apply_batch(keyed, staged, batch_rows=n)).unionByName(conform_dim(odd)))


def run_rebuild(store: DimensionStore, chat: DataFrame, run_ts: dt.datetime, *, run_id: int,
                guard_days: int | None = 1, chat_id: str = "chat_id", created: str = "created_ts",
                replace_history: bool = False) -> int | None:
    """A run of the chain-rebuild flavour: source batch, rebuilt chains of its keys, snapshot of the result.

    The version is tagged with the run, so a run told twice (or one that died
    before its snapshot) rebuilds nothing again and only completes what is
    missing.  The snapshot is of that very version; ``replace_history``
    keeps the last one alone.  Returns the version, ``None`` if no row was accepted.
    """
    tag = f"rebuild-run-{int(run_id)}"
    version = store.dim.tagged(tag)
    if version is None:
        dim = store.current(LEGACY_DIM_SCHEMA)
        seen = store.dim.time_range(ts_col="valid_from_ts")
        batch = build_source_batch(chat, dim, run_ts, guard_days=guard_days, chat_id=chat_id, created=created, known_range=seen)
        staged = store.stage(batch)
        if store.counts["accepted"] == 0:
            return None
        keyed, odd = split_null_keys(dim)
        rebuilt = rebuild_chain(keyed, staged).select(*LEGACY_DIM_COLUMNS).unionByName(odd.select(*LEGACY_DIM_COLUMNS))
        version = store.dim.publish(clustered(rebuilt), tag=tag, ts_col="valid_from_ts")
    if not path_exists(store.spark, f"{store.history_path}/run_id={int(run_id)}"):
        append_snapshot(store.history_path, store.dim.read(version, schema=LEGACY_DIM_SCHEMA), run_id, alone=replace_history)
    return version


__all__ = ["DimensionStore", "LEGACY_DIM_SCHEMA", "applied", "run_load", "run_rebuild", "clustered"]
