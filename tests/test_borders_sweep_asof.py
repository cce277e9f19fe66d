"""Quantile cuts, the sweep join, day islands over cuts and point-in-time joins against plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators import origin as og
from dimweave.operators.asof import as_of_join
from dimweave.operators.borders import part_of, sampled_borders
from dimweave.operators.sweep import sweep_join

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_cuts_are_even_for_one_author_with_an_outlier_or_a_prefix(spark, kind):
    ids = [1000 + i for i in range(4000)] + [10 ** 15]
    rows = spark.createDataFrame([("7", i) for i in ids] + [("8", 5)], "author string, id bigint")
    if kind == "string":
        rows = rows.withColumn("id", F.concat(F.lit("media-2024-"), F.lpad(F.col("id").cast("string"), 16, "0")))
    borders = sampled_borders(rows, ["author", "id"], 16)
    parts = rows.withColumn("_p", part_of(["author", "id"], borders, ["string", kind]))
    counts = [r["count"] for r in parts.groupBy("_p").count().collect()]
    assert len(counts) >= 14 and max(counts) < 2.5 * len(ids) / 16
    bounds = parts.groupBy("_p").agg(F.min(F.struct("author", "id")).alias("lo"), F.max(F.struct("author", "id")).alias("hi")).orderBy("_p").collect()
    assert all(tuple(a["hi"]) <= tuple(b["lo"]) for a, b in zip(bounds, bounds[1:]))


def test_part_numbers(spark):
    rows = spark.range(-3, 30).select(F.col("id").cast("bigint").alias("v"))
    borders = [(0,), (5,), (5,), (5,), (11,), (20,)]
    got = rows.select("v", part_of(["v"], borders, ["bigint"]).alias("p"), part_of(["v"], borders, ["bigint"], below=True).alias("q")).collect()
    for r in got:
        assert (r.p, r.q) == (sum(b <= r.v for b, in borders), sum(b < r.v for b, in borders))
    assert rows.select(part_of(["v"], [], ["bigint"]).alias("p")).distinct().collect() == [(0,)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("parts", [1, 5, 40])
def test_sweep_join_equals_pairs(spark, small_batches, how, parts):
    rng = random.Random(parts)
    hot = 500
    values = [hot] * 60 + [rng.randint(0, 1000) for _ in range(120)] + [None, None, -5, 10 ** 12, 0]
    probe = [(i, v, f"p{i}") for i, v in enumerate(values)]
    band = [(k, a, a + w) for k in range(60) for a, w in [(rng.randint(-10, 1000), rng.choice([0, 1, 3, 50, 400, 5000]))]]
    band += [(100, None, 7), (101, 7, None), (102, 9, 3), (103, 500, 501), (104, 0, 10 ** 13)]
    got = sweep_join(spark.createDataFrame(probe, "i int, v bigint, name string"), spark.createDataFrame(band, "k int, lo bigint, hi bigint"),
                     value="v", lo="lo", hi="hi", how=how, parts=parts)
    want = []
    for i, v, name in probe:
        hits = [(k, a, z) for k, a, z in band if None not in (v, a, z) and a <= v < z]
        want += [(i, v, name, *h) for h in hits] or ([(i, v, name, None, None, None)] if how == "left" else [])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.columns == ["i", "v", "name", "k", "lo", "hi"]


def test_sweep_join_of_empty_sides(spark):
    probe = spark.createDataFrame([(1, 5)], "i int, v bigint")
    bands = spark.createDataFrame([], "lo bigint, hi bigint")
    assert [tuple(r) for r in sweep_join(probe, bands, value="v", lo="lo", hi="hi", how="left").collect()] == [(1, 5, None, None)]
    assert sweep_join(probe.where("false"), bands, value="v", lo="lo", hi="hi", how="left").count() == 0


def test_islands_of_a_hot_day_over_cuts(spark):
    rng = random.Random(4)
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(day, a, a + rng.choice([0, 2, 5, 60])) for a in (rng.randint(0, 60000) for _ in range(3000))] + [(other, 1, 5), (other, 5, 9), (other, 20, 21), (None, 3, 4)]
    rows += [(day, 10_000, 30_000)]  # one band over many ranges
    frame = spark.createDataFrame(rows, "posted_date date, first_media_id_v2 bigint, last_media_id_v2 bigint")
    want = []
    for d in (day, other, None):
        held = None
        for _, a, z in sorted(r for r in rows if r[0] == d):
            if held and a <= held[1]:
                held[1] = max(held[1], z)
            else:
                held = [a, z]
                want.append((d, held))
    want = sorted(((d, *h) for d, h in want), key=str)
    largest = {}
    for parts in (2, 32):
        got = og.merge_bands_by_date(frame, parts=parts).select("posted_date", "first_media_id_v2", "last_media_id_v2")
        assert sorted(map(tuple, got.collect()), key=str) == want
        borders = sampled_borders(frame, ["posted_date", "first_media_id_v2"], parts)
        ranges = frame.groupBy("posted_date", part_of(["posted_date", "first_media_id_v2"], borders, ["date", "bigint"]).alias("r")).count()
        largest[parts] = ranges.agg(F.max("count")).first()[0]
    assert largest[32] * 6 < largest[2]


def _versions():
    rng = random.Random(9)
    rows = []
    for author, n in (("hot", 300), ("b", 4), ("c", 1)):
        at = sorted(rng.sample(range(3000), n))
        for i, (s, e) in enumerate(zip(at, [*at[1:], None])):
            gap = e is not None and i % 5 == 0  # ends before the next one starts
            end = None if e is None else T0 + dt.timedelta(hours=e) - dt.timedelta(minutes=20 if gap else 0)
            rows.append((author, "m", i + 1, T0 + dt.timedelta(hours=s), end, i % 7 == 3, f"x{i}"))
    return rows + [(None, "m", 1, T0, None, False, "n"), ("d", "m", 1, None, None, False, "n"),
                   ("e", "m", 1, T0, T0, False, "zero"), ("e", "m", 2, T0, None, False, "after zero")]


DIM = "author_id string, media_id string, seen_count int, valid_from_ts timestamp_ntz, valid_to_ts timestamp_ntz, is_deleted boolean, note string"


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
@pytest.mark.parametrize("include_deleted", [False, True])
def test_as_of_join_equals_pairs(spark, unit, include_deleted):
    rng = random.Random(2)
    versions = _versions()
    facts = [(i, rng.choice(["hot", "hot", "hot", "b", "c", "e", "none"]), "m", T0 + dt.timedelta(minutes=rng.randint(-50, 200_000))) for i in range(400)]
    facts += [(1000, None, "m", T0), (1001, "hot", "m", None), (1002, "hot", None, T0), (1003, "e", "m", T0), (1003, "e", "m", T0), (1004, "d", "m", T0)]
    facts += [(2000 + i, r[0], "m", r[3]) for i, r in enumerate(versions[:40])]  # at the start itself
    want = []
    for i, a, m, t in facts:
        hits = [v for v in versions if None not in (a, m, t, v[0], v[3]) and v[0] == a and v[1] == m and v[3] <= t and (v[4] is None or t < v[4]) and (include_deleted or not v[5])]
        assert len(hits) <= 1
        want.append((i, a, m, t, *((hits[0][2], hits[0][6]) if hits else (None, None))))
    frame = spark.createDataFrame(facts, "i int, author_id string, media_id string, at timestamp_ntz")
    dim = spark.createDataFrame(versions, DIM)
    got = as_of_join(frame, dim, fact_ts="at", columns=["seen_count", "note"], include_deleted=include_deleted, bucket_unit=unit)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    inner = as_of_join(frame, dim, fact_ts="at", columns=["note"], prefix="v_", how="inner", include_deleted=include_deleted, bucket_unit=unit)
    assert inner.columns == ["i", "author_id", "media_id", "at", "v_note"]
    assert inner.count() == sum(w[4] is not None for w in want)


def test_as_of_join_makes_no_pairs_and_spreads_a_hot_key(spark):
    dim = spark.createDataFrame(_versions(), DIM)
    facts = spark.range(20_000).select(F.lit("hot").alias("author_id"), F.lit("m").alias("media_id"),
                                       (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 150_000).cast("int"))).alias("at"))
    joined = as_of_join(facts, dim, fact_ts="at", columns=["note"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    slices = facts.groupBy(F.date_trunc("day", "at")).count().agg(F.max("count"), F.count("*")).first()
    assert slices[0] <= 1440 and slices[1] >= 13
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(facts, dim.withColumn("at", F.lit(1)), fact_ts="at")
