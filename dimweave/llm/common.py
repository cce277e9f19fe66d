"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimweave.session import WORK, work_dir

#: A word is a maximal run of anything but space and the five ASCII controls
#: 0x09-0x0D.  ``bytes.split()`` splits on exactly this set.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a key table may have to be broadcast; beyond it the planner joins by shuffle.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``stored``, with the rows dealt to as many buckets by ``column`` as the session shuffles to: a join on it then leaves them where they are."""
    spark = df.sparkSession
    path, entry = work_dir(spark, name), f"work_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, column).option("path", path).format("parquet").saveAsTable(entry)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")  # the catalog's entry; the files stay
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of ``stored`` tables whose successors are written; files outside the work folder are left alone."""
    for df in tables:
        hadoop, jvm = df.sparkSession.sparkContext._jsc.hadoopConfiguration(), df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 2)[-2] == WORK:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(hadoop).delete(path, True)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a stored key table if its counted rows are within ``rows``; else leave the join to the planner."""
    return F.broadcast(df) if df.count() <= rows else df


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """A number of each row of a Parquet scan, by its file and its place in it: the same however tasks read the files.

    Spark deals files out to tasks by the cores it sees when it plans a job, so
    task numbers (``monotonically_increasing_id``) differ between the jobs of
    one query when executors come or go.  The table of files has a row per file, as
    the driver's own list has.  Rows that no file holds (tests) are numbered by task.
    """
    plain = lambda c: F.regexp_replace(c, r"^(\w+):/*", "$1:")  # noqa: E731  file:/x and file:///x are the same
    files = sorted(df.inputFiles())
    if not files:
        return df.withColumn(name, F.monotonically_increasing_id())
    numbers = df.sparkSession.createDataFrame(list(enumerate(files)), "_file long, _path string").select("_file", plain(F.col("_path")).alias("_path"))
    place = df.select("*", plain(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.row_index").alias("_row"))
    number = F.coalesce("_file", F.raise_error(F.lit("a row's file is not in the table's list")).cast("long"))
    return place.join(F.broadcast(numbers), "_path", "left").select(*(F.col(c) for c in df.columns), (F.shiftleft(number, 40) + F.col("_row")).alias(name))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_rows(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows ``(first, last, bytes, offsets)`` of at most ``limit`` bytes (or one row); nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, side="right")) - 1)
        yield i, j, data[ends[i]:ends[j]], ends[i:j + 1] - ends[i]
        i = j


__all__ = ["WORD", "BROADCAST_ROWS", "table", "stored", "bucketed", "dropped", "small_side", "with_row_id", "word_count", "byte_rows"]
