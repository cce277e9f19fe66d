"""Small helpers: sizing suggestions, key split, group aggregates, JSON and time functions."""

import datetime as dt

from pyspark.sql import functions as F

from dimweave.functions.json import extract_typed, multi_extract
from dimweave.functions.numeric import round_ratio
from dimweave.functions.time import sql_datetime, utc_to_eastern, zoned_reinterpret
from dimweave.operators.joins import split_by_keys, with_group_aggregates
from dimweave.session import scale_conf


def test_scale_conf_sizes_partitions():
    c = scale_conf(100 << 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1 << 20, total_cores=16)["spark.sql.shuffle.partitions"] == "32"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_split_by_keys_null_key_is_never_matched(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    hit, miss = split_by_keys(rows, keys, ["k"])
    assert sorted(r.v for r in hit.collect()) == [1]
    assert sorted(r.v for r in miss.collect()) == [2, 3]


def test_group_aggregates_group_nulls_like_a_window(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 7)], "g string, v int")
    out = with_group_aggregates(rows, ["g"], {"tot": F.sum("v")})
    assert sorted(((r.g, r.v, r.tot) for r in out.collect()), key=repr) == sorted(
        [("a", 1, 3), ("a", 2, 3), (None, 5, 12), (None, 7, 12)], key=repr)


def test_json_and_time_functions(spark):
    df = spark.createDataFrame([('{"id":"101","duration":120}', dt.datetime(2025, 4, 15, 10, 0, 0, 123456))],
                               "b string, t timestamp_ntz")
    r = df.select(multi_extract("b", "id", "duration").alias("j"), extract_typed("b", "$.duration", "int").alias("d"),
                  extract_typed("b", "$.id", "int", strict=False).alias("i"),
                  utc_to_eastern("t").alias("e"), zoned_reinterpret("t").alias("z"),
                  sql_datetime("t").alias("s")).first()
    assert (r.j.id, r.j.duration, r.d, r.i) == ("101", "120", 120, 101)
    assert r.e == dt.datetime(2025, 4, 15, 6, 0, 0, 123456)      # EDT = UTC-4
    assert r.z == dt.datetime(2025, 4, 15, 14, 0, 0, 123456)
    assert r.s == "2025-04-15 10:00:00"                            # fraction dropped


def test_round_ratio_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (None, 4)], "n int, d int")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [0.33, None, None]
