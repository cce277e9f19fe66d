"""Fixed schemas of staging pages, source batches and dimensions.

The staging schema is declared (or inferred once from a sample, see
``sources.json_pages.schema_from_sample``) and then reused for every page, so a
later page can never change column types.  ``media`` stays ``array<string>``:
Spark keeps the raw JSON text of each element, so the md5 checksum of a
payload is stable byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

KEY = ("author_id", "media_id")

CHAT_PAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("fromUser", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("media", T.ArrayType(T.StringType())),
    T.StructField("createdAt", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("mediaCount", T.IntegerType()),
])

WALL_PAGE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("author", T.StructType([T.StructField("id", T.StringType())])),
    T.StructField("media", T.ArrayType(T.StringType())),
    T.StructField("postedAt", T.StringType()),
])

# Dimension with checksum and soft delete (SCD type 2 "apply" flavour).
DIM_SCHEMA = T.StructType([
    T.StructField("author_id", T.StringType(), False),
    T.StructField("media_id", T.StringType(), False),
    T.StructField("media_duration", T.IntegerType()),
    T.StructField("media_blob", T.StringType(), False),
    T.StructField("seen_count", T.LongType()),
    T.StructField("valid_from_ts", T.TimestampNTZType(), False),
    T.StructField("valid_to_ts", T.TimestampNTZType()),
    T.StructField("is_deleted", T.BooleanType(), False),
    T.StructField("is_current", T.BooleanType(), False),
    T.StructField("extract_ts", T.TimestampNTZType()),
    T.StructField("checksum", T.StringType()),
])
DIM_COLUMNS = [f.name for f in DIM_SCHEMA.fields]

# Dimension of the chain-rebuild and merge flavours (no delete flag, no checksum).
LEGACY_DIM_COLUMNS = ["author_id", "media_id", "media_duration", "media_blob", "seen_count",
                      "valid_from_ts", "valid_to_ts", "is_current", "extract_ts"]

SOURCE_BATCH_COLUMNS = ["author_id", "media_id", "media_duration", "media_blob", "seen_count",
                        "valid_from_ts", "valid_to_ts", "is_current", "extract_ts"]

# A staged source batch as it is stored: with the reason of a reject, and which of the two outputs a row is in.
STAGED_BATCH_SCHEMA = T.StructType([
    T.StructField("author_id", T.StringType()),
    T.StructField("media_id", T.StringType()),
    T.StructField("media_duration", T.StringType()),
    T.StructField("media_blob", T.StringType()),
    T.StructField("seen_count", T.IntegerType()),
    T.StructField("valid_from_ts", T.TimestampNTZType()),
    T.StructField("valid_to_ts", T.TimestampNTZType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("extract_ts", T.TimestampNTZType()),
    T.StructField("null_columns", T.StringType()),
    T.StructField("rejected", T.BooleanType()),
])


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMA)


def conform_dim(df: DataFrame) -> DataFrame:
    """Cast a dimension-shaped frame to ``DIM_SCHEMA`` in its column order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_SCHEMA.fields])


def split_null_keys(df: DataFrame, keys=KEY) -> tuple[DataFrame, DataFrame]:
    """Split rows into (accepted, rejected) by null natural-key parts.

    Spark does not enforce ``NOT NULL`` on files, and a null key would pass
    both existence tests of the dimension merge and double on every run, so
    such rows go to a reject output instead.
    """
    bad = None
    for k in keys:
        c = F.col(k).isNull()
        bad = c if bad is None else (bad | c)
    return df.where(~bad), df.where(bad)


def reject_null_keys(df: DataFrame, keys=KEY) -> DataFrame:
    return split_null_keys(df, keys)[0]


def null_columns(keys=KEY):
    """The names of the key columns that are null, joined by commas; null if none is."""
    names = F.concat_ws(", ", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    return F.when(names != "", names)
