"""JSON page sources: pages are JSON arrays of records (optionally in a
``{"list": [...], "hasMore": ..}`` envelope), as a paging REST feed returns them.

Reading uses a fixed schema so later pages can never change types; the
schema can be inferred once from a sample and saved.  Each page is written as
one line, so files stay splittable; pretty-printed single-page files need
``multi_line=True``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_pages(spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False) -> DataFrame:
    """One row per array element of every page under ``path``."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_envelope(spark: SparkSession, path: str, record_schema: T.StructType, *,
                  multi_line: bool = False) -> DataFrame:
    """Unwrap ``{"list": [...], "hasMore": b}`` pages: one row per list element plus ``hasMore``."""
    env = T.StructType([T.StructField("list", T.ArrayType(record_schema)),
                        T.StructField("hasMore", T.BooleanType())])
    pages = spark.read.schema(env).option("multiLine", multi_line).json(path)
    return pages.select(F.explode("list").alias("_r"), "hasMore").select("_r.*", "hasMore")


def schema_from_sample(spark: SparkSession, sample_path: str,
                       declared: dict[str, T.DataType] | None = None, *, multi_line: bool = False) -> T.StructType:
    """Infer the page schema once from a sample, then pin the declared columns.

    ``declared`` overrides inferred types, e.g. ``media`` as ``array<string>``
    so payload objects keep their raw text (inferred structs would re-encode
    them and change their checksums).
    """
    inferred = spark.read.option("multiLine", multi_line).json(sample_path).schema
    declared = declared or {}
    return T.StructType([T.StructField(f.name, declared.get(f.name, f.dataType), True) for f in inferred.fields])


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "s string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def conform_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Keep the target's columns in the target's order; extra input columns are
    dropped, missing ones become typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields])


def _jstr(c: Column) -> Column:
    """A scalar column as JSON text (``null`` for null): encode a one-element array, strip the brackets."""
    j = F.to_json(F.array(c))
    return j.substr(F.lit(2), F.length(j) - 2)


def chat_record_json(chat: DataFrame, *, extra: dict[str, str] | None = None) -> Column:
    """One staging chat record as JSON text; media elements are embedded raw."""
    media = F.when(F.col("media").isNull(), F.lit("null")).otherwise(
        F.concat(F.lit("["), F.array_join("media", ","), F.lit("]")))
    created = F.date_format("created_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    parts = [F.lit('{"id":'), _jstr(F.col("chat_id")),
             F.lit(',"fromUser":'), F.coalesce(F.to_json("fromUser"), F.lit("null")),
             F.lit(',"media":'), media,
             F.lit(',"createdAt":'), _jstr(created),
             F.lit(',"price":'), _jstr(F.col("price"))]
    for k, v in (extra or {}).items():
        parts += [F.lit(f',"{k}":{v}')]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def write_chat_pages(chat: DataFrame, path: str, *, page_size: int = 10, envelope: bool = False,
                     extra: dict[str, str] | None = None) -> DataFrame:
    """Write chat messages as JSON pages, one page per line, a folder per day.

    A page holds the messages of one day with the same ``chat_id div
    page_size``; ids are unique, so no page exceeds ``page_size`` records
    and no group grows with the data.  With ``envelope`` every page is
    wrapped as ``{"list": [...], "hasMore": ..}``; only the last page of the
    feed has ``hasMore`` false.  Returns the page index (day, page, rows).
    """
    recs = chat.select(F.to_date("created_ts").alias("page_date"),
                       F.expr(f"chat_id div {int(page_size)}").alias("page_no"),
                       "chat_id", chat_record_json(chat, extra=extra).alias("rec"))
    pages = (recs.groupBy("page_date", "page_no")
             .agg(F.sort_array(F.collect_list(F.struct("chat_id", "rec"))).alias("_rs"),
                  F.count(F.lit(1)).alias("n_rows")))
    body = F.concat(F.lit("["), F.array_join(F.transform("_rs", lambda r: r["rec"]), ","), F.lit("]"))
    if envelope:
        last = F.broadcast(pages.agg(F.max(F.struct("page_date", "page_no")).alias("_last")))
        pages = pages.crossJoin(last)
        more = F.when(F.struct("page_date", "page_no") == F.col("_last"), F.lit("false")).otherwise(F.lit("true"))
        body = F.concat(F.lit('{"list":'), body, F.lit(',"hasMore":'), more, F.lit("}"))
    out = pages.select("page_date", "page_no", "n_rows", body.alias("value"))
    out.select("page_date", "value").write.mode("overwrite").partitionBy("page_date").text(path)
    return out.select("page_date", "page_no", "n_rows")


def write_wall_pages(wall: DataFrame, path: str, *, page_size: int = 10) -> None:
    """Write wall posts (a row per medium: ``author_id, post_id, media_id, posted_ts``) as JSON pages, one page per line.

    A page holds the posts with the same ``post_id div page_size``, in one folder per posting day.
    """
    posted = F.date_format("posted_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    posts = wall.groupBy("author_id", "post_id", "posted_ts").agg(F.sort_array(F.collect_list("media_id")).alias("_ids"))
    media = F.concat(F.lit("["), F.array_join(F.transform("_ids", lambda m: F.concat(F.lit('{"id":'), m.cast("string"), F.lit("}"))), ","), F.lit("]"))
    rec = F.concat(F.lit('{"id":'), _jstr(F.col("post_id")), F.lit(',"author":'), F.to_json(F.struct(F.col("author_id").alias("id"))),
                   F.lit(',"media":'), media, F.lit(',"postedAt":'), _jstr(posted), F.lit("}"))
    pages = posts.groupBy(F.to_date("posted_ts").alias("page_date"), F.expr(f"post_id div {int(page_size)}").alias("page_no")).agg(
        F.sort_array(F.collect_list(F.struct("post_id", "author_id", rec.alias("rec")))).alias("_rs"))
    body = F.concat(F.lit("["), F.array_join(F.transform("_rs", lambda r: r["rec"]), ","), F.lit("]"))
    pages.select("page_date", body.alias("value")).write.mode("overwrite").partitionBy("page_date").text(path)


def flat_chat_view(staged: DataFrame) -> DataFrame:
    """Scalar projection of staged chat records (for reports and checks)."""
    media = F.col("media")
    return staged.select(
        F.col("id").alias("chat_id"), F.col("fromUser.id").alias("author_id"),
        F.array_join(media, "|").alias("media_text"),
        F.when(media.isNull(), F.lit(None)).otherwise(F.size(media)).cast("bigint").alias("n_media"),
        "price", F.col("createdAt").cast("timestamp_ntz").alias("created_ts"))
