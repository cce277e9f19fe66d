"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import centroids, chat_format, fingerprints, fm_index, html_extract, jaccard_join, k2_treap, mixing, packing, quality_model, quality_rules, suffix_sort, word_table
from .common import table, word_count


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality_model.fit(docs, labels)
    scored = quality_model.score(docs, weights, ["doc_id"])
    return scored.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fm_index.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], turns.schema)
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(own)))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.cluster(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_pages(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    # the curriculum's order: rows are sorted by their training positions, documents that are not taken come last
    mixed = mixing.plan_mix(docs, "size", "source", [F.col("doc_id"), F.col("size")]).orderBy(
        F.col("first_time").asc_nulls_last(), F.col("last_time").asc_nulls_last(), "doc_id")
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_sort.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id", "source"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_bpe_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = word_table.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    found = word_table.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2(F.col("text"), 256).alias("decoded_sha256"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, final = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(state, final).select(F.col("_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = k2_treap.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("_id").alias("item_id"), "rank", "doc_id", "score")


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_substring_dedup, op3_chat_formatting, op4_fingerprints, op5_packing, op6_ngram_jaccard_join, op7_html_extraction, op8_mixing, op9_suffix_dedup, op10_quality_rules,
                                  op11_bpe_word_table, op12_centroid_clustering, op13_ranked_search)}
