"""The layout by key hash: equal reads, pruned folders, no exchange of the stored rows."""

import re

import pytest
from pyspark.sql import functions as F

from dimweave.plans import fixtures as fx
from dimweave.schemas import DIM_SCHEMA
from dimweave.session import work_dir
from dimweave.sources.buckets import KeyBuckets

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def dim(spark):
    odd = fx.v_dim(spark, SF_SMALL).limit(3).withColumn("author_id", F.lit(None).cast("string"))
    return fx.v_dim(spark, SF_SMALL).unionByName(odd)


@pytest.fixture(scope="module")
def store(spark, dim):
    out = KeyBuckets(spark, f"{work_dir(spark, 't-buckets')}/dim", DIM_SCHEMA, buckets=8)
    out.write(dim)
    return out


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reads_equal_the_plain_table(store, dim):
    assert _same(store.read(), dim)
    author = dim.agg(F.max("author_id")).first()[0]
    assert store.lookup(author, "click").count() > 0
    assert _same(store.lookup(author, "click"), dim.where((F.col("author_id") == author) & (F.col("media_id") == "click")))
    assert store.lookup(None, "click").count() == 0 and store.lookup("nobody", "click").count() == 0
    with pytest.raises(ValueError):
        store.lookup("nobody")


def test_a_lookup_reads_one_folder(store):
    found = store.lookup("7", "click")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*key_bucket", plan) and "Exchange" not in plan
    assert len({f.split("key_bucket=")[1].split("/")[0] for f in store.read().inputFiles()}) == 8
    used = {r[0] for r in store._rows().where(F.col("key_bucket") == 3).select(F.input_file_name()).distinct().collect()}
    assert all("key_bucket=3" in f for f in used)


def test_touched_keys_prune_folders_and_do_not_shuffle_the_table(spark, store, dim):
    few = dim.where("author_id is not null").select("author_id", "media_id").distinct().limit(2)
    few = spark.createDataFrame(few.collect(), few.schema).unionByName(few.limit(0))
    touched = store.touched(few.withColumn("x", F.lit(1)))
    assert _same(touched, dim.join(few, ["author_id", "media_id"], "left_semi").select(*DIM_SCHEMA.names))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*\n[^\n]*FileScan", plan)
    asked = set(map(int, re.search(r"PartitionFilters: \[[^\]]*key_bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan).group(1).split(",")))
    assert len(asked) == 2  # of eight
    nothing = spark.createDataFrame([(None, "click")], "author_id string, media_id string")
    assert store.touched(nothing).count() == 0
    # beyond the bound the join still gives the same rows
    assert _same(store.touched(few, broadcast_rows=1), touched)
