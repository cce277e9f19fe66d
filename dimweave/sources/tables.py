"""Parquet tables: versioned publish, history snapshots, by-name appends.

A dimension is published as a new version folder and becomes current only
when a row is appended to the table's commit log, so a job may read the
current version while it writes the next one (a plan that reads the table it
replaces), and a job that dies half-way leaves the current version intact.
A written version also cuts the lineage of the plan that produced it.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.incremental import outside_seen_range
from ..session import path_exists

LOG_SCHEMA = ("version bigint, committed_at timestamp_ntz, n_rows bigint, tag string, "
              "min_ts timestamp_ntz, max_ts timestamp_ntz, folder string")


class VersionedTable:
    """A parquet table with immutable versions ``v=NNNNNN-<attempt>`` and an append-only commit log."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log_path = f"{self.path}/_commits"
        self._entries: dict[int, dict] = {}   # commit rows already seen by this process

    def _log(self) -> DataFrame | None:
        if not path_exists(self.spark, self.log_path):
            return None
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def latest(self) -> dict | None:
        """The last commit row (one small read of the log), or ``None``."""
        log = self._log()
        if log is None:
            return None
        row = log.orderBy(F.col("version").desc()).limit(1).first()
        if row is None:
            return None
        entry = row.asDict()
        self._entries[int(entry["version"])] = entry
        return entry

    def current_version(self) -> int | None:
        e = self.latest()
        return None if e is None else int(e["version"])

    def _entry(self, version: int) -> dict:
        if version not in self._entries:
            self._entries[version] = self._log().where(F.col("version") == version).first().asDict()
        return self._entries[version]

    def rows(self, version: int) -> int:
        """Row count of a committed version, from the commit log."""
        return int(self._entry(version)["n_rows"])

    def time_range(self, version: int | None = None, ts_col: str | None = None):
        """(min, max) of a version's times, or (None, None) if it has none.

        Taken from the commit log; a version published without its ``ts_col``
        is scanned instead (``ts_col`` must then be given).
        """
        e = self.latest() if version is None else self._entry(version)
        if e is None or not e["n_rows"]:
            return None, None
        if e["min_ts"] is None:
            if ts_col is None:
                raise ValueError(f"version {e['version']} was published without its time range; pass ts_col to scan it")
            t = F.col(ts_col).cast("timestamp_ntz")
            return tuple(self.read(int(e["version"])).agg(F.min(t), F.max(t)).first())
        return e["min_ts"], e["max_ts"]

    def tagged(self, tag: str) -> int | None:
        """The committed version with this tag, if any."""
        log = self._log()
        row = None if log is None else log.where(F.col("tag") == tag).agg(F.max("version")).first()
        return None if row is None else row[0]

    def has_tag(self, tag: str) -> bool:
        return self.tagged(tag) is not None

    def _commit(self, row: tuple) -> None:
        """Makes a written version current, at once: its log row is written beside the log and moved into it.

        The row's file is named after the version and moving does not
        overwrite, so of two writers one fails, and a writer that dies before the
        move leaves the table as it was.
        """
        spark, version = self.spark, row[0]
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        draft = f"{self.path}/_drafts/{uuid.uuid4().hex[:12]}"
        spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.parquet(draft)
        fs = path(draft).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        written = next(f.getPath() for f in fs.globStatus(path(f"{draft}/part-*.parquet")))
        fs.mkdirs(path(self.log_path))
        place = path(f"{self.log_path}/version-{version:06d}.parquet")
        if fs.exists(place) or not fs.rename(written, place):
            raise RuntimeError(f"version {version} of {self.path} was committed by another writer")
        fs.delete(path(draft), True)

    def version_path(self, version: int) -> str:
        return f"{self.path}/{self._entry(version)['folder']}"

    def read(self, version: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        if v is None:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.version_path(v))

    def publish(self, df: DataFrame, *, partition_by: list[str] | None = None, tag: str | None = None,
                ts_col: str | None = None) -> int:
        """Write ``df`` as the next version and commit it; returns the version number.

        Row count (and min/max of ``ts_col``) are observed on the write itself
        and kept in the commit log, so later runs read them without a scan.
        """
        v = (self.current_version() or 0) + 1
        obs = Observation(f"publish_{v}")
        metrics = [F.count(F.lit(1)).alias("n")]
        if ts_col:
            metrics += [F.min(ts_col).cast("timestamp_ntz").alias("lo"), F.max(ts_col).cast("timestamp_ntz").alias("hi")]
        folder = f"v={v:06d}-{uuid.uuid4().hex[:12]}"  # no attempt writes into another's folder
        w = df.observe(obs, *metrics).write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.path}/{folder}")
        got = obs.get
        n = got["n"]
        row = (v, dt.datetime.now(), n, tag, got.get("lo"), got.get("hi"), folder)
        self._commit(row)
        self._entries[v] = dict(zip(["version", "committed_at", "n_rows", "tag", "min_ts", "max_ts", "folder"], row))
        return v


def append_snapshot(history_path: str, dim: DataFrame, run_id: int, *, alone: bool = False) -> None:
    """Append the whole dimension as snapshot ``run_id`` (partitioned by run).

    Dynamic partition overwrite makes a retried run replace its own snapshot
    instead of adding a second copy; ``alone`` drops the snapshots of other runs.
    """
    (dim.withColumn("run_id", F.lit(int(run_id)).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if alone else "dynamic").partitionBy("run_id").parquet(history_path))


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    h = spark.read.parquet(history_path)
    return h.withColumn("run_id", F.col("run_id").cast("bigint"))


def replace_history(history: VersionedTable, dim: DataFrame) -> int:
    """History as a full copy of the current dimension (a new version replaces the old)."""
    return history.publish(dim)


def insert_by_name(target: T.StructType, rows: DataFrame, path: str) -> None:
    """Append ``rows`` to the parquet table at ``path`` matching columns by name."""
    have = set(rows.columns)
    missing = [f.name for f in target.fields if f.name not in have]
    if missing:
        raise ValueError(f"insert by name: columns missing from input: {missing}")
    rows.select(*[F.col(f.name).cast(f.dataType) for f in target.fields]).write.mode("append").parquet(path)


def append_outside_range(spark: SparkSession, path: str, schema: T.StructType, rows: DataFrame,
                         ts: str, run_ts: dt.datetime) -> int:
    """Append the rows that lie outside the time range the staging table holds; return their count.

    The range is read from the table before the write (frozen for the call),
    and the count comes from an observation on the write itself, not from a
    second pass over the data.
    """
    if path_exists(spark, path):
        current = spark.read.schema(schema).parquet(path)
    else:
        current = spark.createDataFrame([], schema)
    cur = current.select(F.col(ts).cast("timestamp_ntz").alias("_t"))
    keep = outside_seen_range(rows, F.col(ts).cast("timestamp_ntz"), cur, run_ts, target_ts="_t")
    obs = Observation("inserted")
    keep = keep.observe(obs, F.count(F.lit(1)).alias("n"))
    keep.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(path)
    return int(obs.get["n"])
