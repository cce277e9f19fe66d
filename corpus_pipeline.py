"""Corpus pipeline over ``documents``: host rules, near copies, repeated passages, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``.  ``docs`` is a file scan (a
table, or the stored result of the stage before).  Extra columns are carried along; names that begin with an
underscore are the operators' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dimweave.llm import jaccard_join, mixing, packing, quality_rules, suffix_sort
from dimweave.llm.common import stored, table, with_row_id, word_count

#: Near copies: words of a shingle, and the least similarity in hundredths.
COPY_WORDS, COPY_PERCENT = 5, 80
#: Repeated passages: bytes of the shortest one. Of 51 words in a row, 99.9 % take up as many (English, the shortest, at sf0.1).
PASSAGE_BYTES = 240


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level rules keep."""
    rows = with_row_id(docs)
    judged = quality_rules.judge(rows.select("_rid", "source", "text"), ["_rid", "source"])
    return rows.join(judged.where("kept").select("_rid"), "_rid", "left_semi").select(*docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word Jaccard of 0.8 or more): the one of the smallest id. Texts without words stay."""
    rows = with_row_id(docs)
    found = stored(jaccard_join.cluster(docs, percent=COPY_PERCENT, size=COPY_WORDS).select("_rid", "doc_id", "_root"), "pipeline-copies")
    first = found.where("_root is not null").groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_rid")).alias("_first")).select(F.col("_first._rid").alias("_rid"))
    stay = first.unionByName(found.where("_root is null").select("_rid"))
    return rows.join(stay, "_rid", "left_semi").select(*docs.columns)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``PASSAGE_BYTES`` or more that occur elsewhere; null texts stay null."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    marked = docs.withColumn("_null", F.col("text").isNull())
    kept = suffix_sort.remove_repeats(marked, [*rest, "_null"], width=PASSAGE_BYTES, as_text=True)
    kept = kept.withColumn("text", F.when(~F.col("_null"), F.col("kept")))
    return kept.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: documents occur as often as their source's target asks for, the last time perhaps in part."""
    sized = docs.withColumn("_size", word_count(F.col("text")))
    mixed = mixing.mixed_rows(mixing.plan_mix(sized, "_size", "source", [F.col("doc_id"), F.col("_size")]), "_size", "text")
    return mixed.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def stored_order(docs: DataFrame) -> list[Column]:
    """Where a row was written: the number of its file (Spark numbers the files of a sorted result in its order), the file, the row in it.

    A scan deals files out by size, so its partitions do not follow that order.
    """
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids; sequences are numbered by shard in the order in which the mix was stored."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, order=stored_order(docs))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("suffix-array dedup", repeated_passages_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: Token packing has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
