"""Rejects of a run, the chain-rebuild run, the wall feed, apply by partition and the interval audit."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from dimweave.operators import audit, scd2
from dimweave.plans import fixtures as fx
from dimweave.plans.load import LEGACY_DIM_SCHEMA, DimensionStore, run_load, run_rebuild
from dimweave.schemas import WALL_PAGE_SCHEMA, conform_dim
from dimweave.session import local_path, work_dir
from dimweave.sources import partitioned as pt
from dimweave.streaming import ingest as ing

from conftest import SF_SMALL
from test_scd2_golden import batch_df, dim_df

RUN = dt.datetime(2025, 6, 1)


def _chat(spark, rows):
    """``rows``: (chat id, author, list of payload texts, day of May 2025)."""
    data = [(i, (a,), m, dt.datetime(2025, 5, d)) for i, a, m, d in rows]
    return spark.createDataFrame(data, "chat_id bigint, fromUser struct<id:string>, media array<string>, created_ts timestamp_ntz")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- rejects ----------------------------------------------------------------------------------

def test_run_saves_its_rejects(spark):
    store = DimensionStore(spark, work_dir(spark, "t-rejects"))
    chat = _chat(spark, [(1, "9", ['{"id":"1","duration":5}', '{"duration":6}'], 1), (2, None, ['{"id":"2","duration":5}', '{}'], 2), (3, "9", [], 3)])
    assert run_load(store, chat, RUN, run_id=1) == 1
    assert store.counts == {"read": 4, "accepted": 1, "rejected": 3}
    got = sorted((r.author_id or "", r.media_id or "", r.null_columns) for r in store.rejects().collect())
    assert got == [("", "", "author_id, media_id"), ("", "2", "author_id"), ("9", "", "media_id")]
    assert [(r.author_id, r.media_id) for r in store.current().collect()] == [("9", "1")]


def test_run_of_rejects_alone_and_of_nothing(spark):
    store = DimensionStore(spark, work_dir(spark, "t-rejects-alone"))
    assert store.rejects() is None
    assert run_load(store, _chat(spark, [(1, None, ['{"id":"1"}'], 1)]), RUN, run_id=1) is None
    assert store.counts == {"read": 1, "accepted": 0, "rejected": 1} and store.rejects().count() == 1
    assert run_load(store, _chat(spark, []), RUN, run_id=2) is None
    assert store.counts["read"] == 0 and store.rejects().count() == 0 and store.current().count() == 0


def test_run_keeps_stored_rows_without_a_key(spark):
    store = DimensionStore(spark, work_dir(spark, "t-odd"))
    good = dim_df(spark, ["1/1 d5 #1 [04-01T00:00,∅) x04-01T01:00 del=F cur=T"])
    store.dim.publish(good.unionByName(good.withColumn("media_id", F.lit(None).cast("string"))), ts_col="valid_from_ts")
    run_load(store, _chat(spark, [(1, "9", ['{"id":"1","duration":5}'], 1)]), RUN, run_id=1)
    assert sorted((r.author_id, r.media_id or "") for r in store.current().collect()) == [("1", ""), ("1", "1"), ("9", "1")]


# --- chain rebuild run ------------------------------------------------------------------------

def test_rebuild_run_told_twice_and_resumed(spark, monkeypatch):
    from dimweave.plans import load

    store = DimensionStore(spark, work_dir(spark, "t-rebuild"))
    first = _chat(spark, [(1, "9", ['{"id":"1","duration":5}'], 2), (2, "9", ['{"id":"1","duration":6}', '{"duration":1}'], 4)])
    with monkeypatch.context() as m:
        m.setattr(load, "append_snapshot", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_rebuild(store, first, RUN, run_id=7)
    assert store.dim.current_version() == 1
    assert run_rebuild(store, first, RUN, run_id=7) == 1 and run_rebuild(store, first, RUN, run_id=7) == 1
    rows = store.history().orderBy("valid_from_ts").collect()
    assert [(r.run_id, r.seen_count, r.is_current) for r in rows] == [(7, 1, False), (7, 2, True)]
    second = first.unionByName(_chat(spark, [(3, "9", ['{"id":"1","duration":7}'], 9), (4, "8", ['{"id":"1"}'], 1), (5, "8", ['{"id":"1"}'], 3)]))
    assert run_rebuild(store, second, RUN, run_id=8) == 2  # the 3rd lies inside the loaded range
    now = store.current(LEGACY_DIM_SCHEMA).orderBy("author_id", "valid_from_ts").collect()
    assert [(r.author_id, r.valid_from_ts.day, r.seen_count, r.is_current) for r in now] == [("8", 1, 1, True), ("9", 2, 1, False), ("9", 4, 2, False), ("9", 9, 3, True)]
    assert sorted(r.run_id for r in store.history().select("run_id").collect()) == [7, 7, 8, 8, 8, 8]
    assert run_rebuild(store, _chat(spark, [(6, "7", ['{"id":"1"}'], 20)]), RUN, run_id=9, replace_history=True) == 3
    assert {r.run_id for r in store.history().select("run_id").collect()} == {9}


# --- wall feed --------------------------------------------------------------------------------

def _wall_page(folder, name, days):
    folder.mkdir(exist_ok=True)
    rows = [{"id": 100 + d, "author": {"id": "5"}, "media": [{"id": d}, {"id": d + 50}], "postedAt": f"2025-01-{d:02d} 10:00:00"} for d in days]
    (folder / name).write_text(json.dumps(rows))


def test_wall_run_keeps_its_range_and_resumes(spark, tmp_path, monkeypatch):
    staging, ck = work_dir(spark, "t-wall"), work_dir(spark, "t-wall-ck")
    folder = tmp_path / "wall"
    _wall_page(folder, "1.json", [20, 9])
    with monkeypatch.context() as m:
        m.setattr(ing, "_end", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ing.ingest_wall(spark, str(folder), staging, ck, RUN)
    _wall_page(folder, "2.json", [15])  # inside what the broken run has staged itself
    got = ing.ingest_wall(spark, str(folder), staging, ck, RUN, max_files_per_trigger=1)
    assert got["inserted"] == 3
    _wall_page(folder, "3.json", [10, 25, 1])
    assert ing.ingest_wall(spark, str(folder), staging, ck, RUN)["inserted"] == 2  # a new run: the 10th is in range
    rows = ing.read_staging(spark, staging, WALL_PAGE_SCHEMA).collect()
    assert sorted(r.id for r in rows) == [101, 109, 115, 120, 125]
    assert all(len(r.media) == 2 for r in rows)


# --- apply by partition -----------------------------------------------------------------------

DIM = ["1/1 d1 #1 [01-05T00:00,02-05T00:00) x01-05T01:00 del=F cur=F", "1/1 d2 #2 [02-05T00:00,∅) x02-05T01:00 del=F cur=T",
       "2/1 d1 #1 [01-09T00:00,∅) x01-09T01:00 del=F cur=T", "3/1 d1 #1 [03-01T00:00,∅) x03-01T01:00 del=F cur=T"]


def _files(path):
    out = {}
    for base, _, names in os.walk(local_path(path)):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.join(base, n)] = os.stat(os.path.join(base, n)).st_mtime_ns
    return out


def test_an_apply_of_one_day_writes_one_month(spark):
    table = pt.PartitionedDimension(spark, f"{work_dir(spark, 't-part')}/dim")
    table.create(dim_df(spark, DIM))
    before = _files(table.data)
    batch = batch_df(spark, ["4/1 d1 [04-02T00:00) x04-03T00:00", "5/1 d1 [04-02T12:00) x04-03T00:00"])
    assert table.apply(batch) == ["2025-04-01"]
    after = _files(table.data)
    assert all(after[f] == t for f, t in before.items()) and {f.split("part=")[1][:10] for f in set(after) - set(before)} == {"2025-04-01"}
    # a newer version closes the one before it, which lies in another month
    assert table.apply(batch_df(spark, ["2/1 d9 [04-20T00:00) x04-21T00:00"])) == ["2025-01-01", "2025-04-01"]
    # told again, the match stays outside the chain and the older version opens again: its month alone changes
    assert table.apply(batch_df(spark, ["2/1 d9 [04-20T00:00) x04-21T00:00"])) == ["2025-01-01"]
    assert table.apply(batch_df(spark, ["3/1 d1 [03-01T00:00) x04-21T00:00"])) == []  # an exact match: nothing changes
    assert table.apply(batch_df(spark, [])) == []


def test_partition_apply_equals_the_whole_apply(spark):
    for unit in ("day", "month"):
        table = pt.PartitionedDimension(spark, f"{work_dir(spark, 't-part-all')}/dim", unit=unit)
        dim, batch = fx.v_dim(spark, SF_SMALL), fx.v_rescrape(spark, SF_SMALL)
        table.create(dim)
        table.apply(batch)
        assert _same(table.read(), conform_dim(scd2.apply_batch(dim, batch)))


def test_partition_apply_survives_a_crash_half_way(spark, monkeypatch):
    table = pt.PartitionedDimension(spark, f"{work_dir(spark, 't-part-crash')}/dim")
    table.create(dim_df(spark, DIM))
    batch = batch_df(spark, ["2/1 d9 [04-20T00:00) x04-21T00:00"])
    want = conform_dim(scd2.apply_batch(dim_df(spark, DIM), batch))
    with monkeypatch.context() as m:
        m.setattr(pt.PartitionedDimension, "_replace", lambda self, staged: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.apply(batch)
    # one of the two months is already replaced when the process dies
    staged = spark.read.text(table.notes).first()[0]
    rows = spark.read.schema(table._rows().schema).parquet(staged).where("part = '2025-01-01'")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table.data)
    again = pt.PartitionedDimension(spark, table.path)
    assert _same(again.read(), want)
    assert not again.recover()


# --- interval audit ---------------------------------------------------------------------------

def test_audit_lists_h4_and_h5(spark):
    h4 = scd2.apply_batch(dim_df(spark, ["932/132 d10 #1 [04-01T00:00,05-01T00:00) x04-01T01:00 del=T cur=F"]), batch_df(spark, ["932/132 d10 [04-01T00:00) x06-01T00:00"]))
    h5 = scd2.apply_batch(dim_df(spark, ["933/133 d10 #1 [04-01T00:00,∅) x04-01T01:00 del=F cur=T"]),
                          batch_df(spark, ["933/133 d10 [04-01T00:00) x06-01T00:00", "933/133 d20 [05-01T00:00) x06-01T00:00"]))
    fine = dim_df(spark, DIM)
    report = {r.author_id: r for r in audit.intervals(h4.unionByName(h5).unionByName(fine)).collect()}
    assert set(report) == {"932", "933"}
    assert report["932"].issue == "no current" and report["933"].issue == "several current,overlap"
    assert audit.intervals(fine).count() == 0 and audit.intervals(fine.where("false")).count() == 0


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_audit_of_a_hot_key_equals_plain_counting(spark, unit):
    rng = random.Random(6)
    t0, end = dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)
    rows = []
    for key, n in (("hot", 400), ("a", 5), ("b", 1), (None, 3)):
        for _ in range(n):
            start = t0 + dt.timedelta(hours=rng.randint(0, 2000))
            rows.append((key, "m", start, rng.choice([None, start, start + dt.timedelta(hours=rng.randint(1, 9))]), rng.random() < 0.1, rng.random() < 0.2))
    dim = spark.createDataFrame(rows, "author_id string, media_id string, valid_from_ts timestamp_ntz, valid_to_ts timestamp_ntz, is_current boolean, is_deleted boolean")
    want = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r[2], r[3] or end, r[4], r[5]) for r in rows if r[0] == key)
        gaps = overlaps = 0
        far = None
        for s, e, *_ in mine:
            gaps += far is not None and s > far
            overlaps += far is not None and s < far
            far = e if far is None else max(far, e)
        cur, dead = sum(m[2] for m in mine), sum(m[3] for m in mine)
        issue = [n for n, c in (("no current", cur == 0 and dead < len(mine)), ("several current", cur > 1), ("gap", gaps), ("overlap", overlaps)) if c]
        if issue:
            want[key] = (len(mine), cur, dead, gaps, overlaps, ",".join(issue))
    got = {r.author_id: tuple(r)[2:] for r in audit.intervals(dim, bucket_unit=unit).collect()}
    assert got == want
