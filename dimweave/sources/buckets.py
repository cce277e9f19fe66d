"""Tables laid out by a hash of their key, so lookups and touched-key reads skip whole folders.

A row lies in the folder ``key_bucket=<hash of its key mod buckets>``, sorted by
key and start inside each file.  A lookup of one key turns into one folder; a
join with a set of keys reads the folders that hold them alone.  A bucket is a folder of any number of
files, so a hot key makes its folder larger, not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from ..schemas import KEY

BUCKET = "key_bucket"
#: Rows of one file, so that a hot key's folder stays splittable in equal parts.
FILE_ROWS = 5_000_000


def bucket_of(key: Sequence[str | Column], buckets: int) -> Column:
    """The bucket of a key; null parts count like any value."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class KeyBuckets:
    """A parquet table under ``path``, bucketed by ``key``; ``buckets`` is fixed when it is written."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, *, key: Sequence[str] = KEY, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets
        self.schema = schema

    def write(self, rows: DataFrame, order: Sequence[str] = ("valid_from_ts",)) -> None:
        """Stores ``rows`` (a new table).  Spread by bucket and a few salts, so no task writes a whole hot bucket."""
        salt = F.pmod(F.xxhash64(*self.key, *order), F.lit(4))
        out = rows.select(*self.schema.names, bucket_of(self.key, self.buckets).alias(BUCKET)).withColumn("_salt", salt)
        out = out.repartition(BUCKET, "_salt").drop("_salt").sortWithinPartitions(BUCKET, *self.key, *order)
        out.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(BUCKET).parquet(self.path)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET)

    def lookup(self, *values) -> DataFrame:
        """The rows of one key (one value per key column; a null finds nothing): one folder is read."""
        if len(values) != len(self.key):
            raise ValueError(f"one value for each of {self.key}")
        kinds = {f.name: f.dataType for f in self.schema.fields}
        literal = [F.lit(v).cast(kinds[k]) for k, v in zip(self.key, values)]
        found = self._rows().where(F.col(BUCKET) == bucket_of(literal, self.buckets))
        for k, v in zip(self.key, literal):
            found = found.where(F.col(k) == v)
        return found.drop(BUCKET)

    def touched(self, rows: DataFrame, *, broadcast_rows: int = DEFAULT_BROADCAST_ROWS, known_max: int | None = None) -> DataFrame:
        """The stored rows whose key occurs in ``rows`` (null parts match nothing).

        Only the folders that some key falls in are read (their numbers, at most
        ``buckets``, come to the driver).  The distinct keys are broadcast if
        their count allows, and the stored rows then stay where they are; else the join
        shuffles, as on any table.
        """
        keys = rows.select(*self.key).dropna().distinct()
        held = [r[0] for r in keys.select(bucket_of(self.key, self.buckets).alias("b")).distinct().collect()]
        keys = broadcast_if_small(keys, broadcast_rows, known_max=known_max)
        return self._rows().where(F.col(BUCKET).isin(held)).join(keys, self.key, "left_semi").select(*self.schema.names)


__all__ = ["BUCKET", "FILE_ROWS", "KeyBuckets", "bucket_of"]
