"""A dimension stored by start time, of which an apply rewrites only the partitions that change.

Rows lie in folders ``part=<start of month>`` (or day).  An apply works out
which partitions hold a row that differs from what is stored, writes their new
rows to a folder of its own, and puts them in place by Spark's dynamic
partition overwrite.  A note of that folder is written before and deleted after
the overwrite, so one that dies half-way is repeated from the finished rows,
not from the half-replaced table.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import DEFAULT_BROADCAST_ROWS
from ..operators.scd2 import VF, apply_parts
from ..schemas import DIM_COLUMNS, DIM_SCHEMA, KEY, conform_dim, reject_null_keys
from ..session import path_exists, work_dir


class PartitionedDimension:
    """A type 2 dimension under ``path``, a partition per ``unit`` of its rows' start."""

    def __init__(self, spark: SparkSession, path: str, unit: str = "month"):
        self.spark, self.path, self.unit = spark, path.rstrip("/"), unit
        self.data, self.notes = f"{self.path}/data", f"{self.path}/_pending"

    def _part(self) -> Column:
        return F.date_format(F.date_trunc(self.unit, F.col(VF)), "yyyy-MM-dd").alias("part")

    def create(self, dim: DataFrame) -> None:
        """Stores the first state; the table must not be there yet."""
        conform_dim(dim).select("*", self._part()).write.partitionBy("part").parquet(self.data)

    def read(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The dimension; with ``parts``, only these partitions' files are read."""
        self.recover()
        rows = self._rows()
        return (rows if parts is None else rows.where(F.col("part").isin(*parts))).select(*DIM_COLUMNS)

    def _rows(self) -> DataFrame:
        schema = conform_dim(self.spark.createDataFrame([], DIM_SCHEMA)).withColumn("part", F.lit("")).schema
        return self.spark.read.schema(schema).parquet(self.data)

    def recover(self) -> bool:
        """Repeats an overwrite that was noted and not finished; whether there was one."""
        if not path_exists(self.spark, self.notes):
            return False
        self._replace(self.spark.read.text(self.notes).first()[0])
        return True

    def _replace(self, staged: str) -> None:
        schema = self._rows().schema
        (self.spark.read.schema(schema).parquet(staged).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.data))
        jvm = self.spark.sparkContext._jvm
        note = jvm.org.apache.hadoop.fs.Path(self.notes)
        note.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(note, True)

    def apply(self, batch: DataFrame, key: Sequence[str] = KEY, *, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              batch_rows: int | None = None) -> list[str]:
        """Applies a source batch; returns the partitions that were rewritten (none for an empty batch).

        An empty batch would clear every delete flag, so it is skipped, as in a load run.
        """
        self.recover()
        batch = reject_null_keys(batch, list(key))
        if batch_rows == 0 or (batch_rows is None and batch.isEmpty()):
            return []
        dim = self.read()
        kept, chained, touched = apply_parts(dim, batch, key, broadcast_rows=broadcast_rows, batch_rows=batch_rows)
        work = work_dir(self.spark, "partition-apply")
        conform_dim(chained).select("*", self._part()).write.parquet(work)  # computed once, read twice
        chained = self.spark.read.parquet(work)
        changed = self._changed(chained, touched).union(kept.where("_changed").select(self._part())).distinct()
        parts = sorted(r["part"] for r in changed.collect())  # one name per month
        if not parts:
            return []
        kept_rows = apply_parts(self.read(parts), batch, key, broadcast_rows=broadcast_rows, batch_rows=batch_rows)[0]
        rows = conform_dim(kept_rows).select("*", self._part()).unionByName(chained.where(F.col("part").isin(*parts)))
        staged = f"{self.path}/_staged/{uuid.uuid4().hex[:12]}"
        rows.sortWithinPartitions("part", *key, VF).write.partitionBy("part").parquet(staged)
        self.spark.createDataFrame([(staged,)], "s string").coalesce(1).write.text(self.notes)
        self._replace(staged)
        return parts

    def _changed(self, after: DataFrame, before: DataFrame) -> DataFrame:
        """Partitions in which the touched keys' rows are not the same before and after (as bags)."""
        sides = (conform_dim(after).select(*DIM_COLUMNS, F.lit(1).alias("_n"))
                 .unionByName(conform_dim(before).select(*DIM_COLUMNS, F.lit(-1).alias("_n"))))
        # 128 bits of a row stand for it: only digests are grouped
        digest = [F.xxhash64(*DIM_COLUMNS).alias("_one"), F.xxhash64(F.lit(7), *DIM_COLUMNS).alias("_two")]
        return (sides.select(self._part(), *digest, "_n").groupBy("part", "_one", "_two").agg(F.sum("_n").alias("_n"))
                .where("_n != 0").select("part"))


__all__ = ["PartitionedDimension"]
