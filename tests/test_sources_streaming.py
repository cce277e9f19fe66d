"""JSON page sources (pretty-printed arrays, envelopes, schema from a sample) and the
streaming ingest."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from dimweave.plans import fixtures as fx
from dimweave.plans.load import DimensionStore, run_load
from dimweave.schemas import CHAT_PAGE_SCHEMA
from dimweave.session import local_path, work_dir
from dimweave.sources import json_pages as jp
from dimweave.sources.tables import VersionedTable
from dimweave.streaming.ingest import ingest_pages, read_staging

from conftest import SF_SMALL

PAGE = [
    {"id": 7001, "fromUser": {"id": "901"}, "media": [{"id": "101", "duration": 120}, {"id": 102}],
     "createdAt": "2025-04-15 10:00:00", "price": 9.99, "mediaCount": 2, "files": None},
    {"id": 7002, "fromUser": {"id": "901"}, "media": [], "createdAt": "2025-04-16 10:00:00",
     "price": 0.0, "mediaCount": 0},
]


def _write_pretty(tmp_path, obj):
    p = tmp_path / "page.json"
    p.write_text(json.dumps(obj, indent=2))
    return str(p)


def test_pretty_printed_array_needs_multiline(spark, tmp_path):
    path = _write_pretty(tmp_path, PAGE)
    rows = jp.read_pages(spark, path, CHAT_PAGE_SCHEMA, multi_line=True).orderBy("id").collect()
    assert [r.id for r in rows] == [7001, 7002]
    # media elements keep their raw JSON text (key order and whitespace of the page),
    # so the md5 of a payload only changes when its text does
    assert [json.loads(m) for m in rows[0].media] == [{"id": "101", "duration": 120}, {"id": 102}]
    assert rows[0].media[0].index('"id"') < rows[0].media[0].index('"duration"')
    assert rows[0].mediaCount == 2


def test_one_page_per_line_keeps_compact_text(spark, tmp_path):
    p = tmp_path / "pages.json"
    p.write_text("\n".join(json.dumps(PAGE[i:i + 1], separators=(",", ":")) for i in range(2)))
    rows = jp.read_pages(spark, str(p), CHAT_PAGE_SCHEMA).orderBy("id").collect()
    assert rows[0].media == ['{"id":"101","duration":120}', '{"id":102}']


def test_envelope_unwrap(spark, tmp_path):
    path = _write_pretty(tmp_path, {"list": PAGE, "hasMore": False})
    rows = jp.read_envelope(spark, path, CHAT_PAGE_SCHEMA, multi_line=True).collect()
    assert len(rows) == 2 and all(r.hasMore is False for r in rows)


def test_schema_from_sample_pins_declared_columns(spark, tmp_path):
    path = _write_pretty(tmp_path, PAGE)
    schema = jp.schema_from_sample(spark, path, declared={"media": T.ArrayType(T.StringType())}, multi_line=True)
    assert schema["media"].dataType == T.ArrayType(T.StringType())
    assert "files" in schema.fieldNames()  # the sample's extra field is kept until conformed
    conformed = jp.conform_to_target(spark.read.schema(schema).option("multiLine", True).json(path),
                                     CHAT_PAGE_SCHEMA)
    assert conformed.columns == CHAT_PAGE_SCHEMA.fieldNames()


def test_written_pages_round_trip(spark):
    chat = fx.v_chat(spark, SF_SMALL)
    path = work_dir(spark, "t-pages")
    idx = jp.write_chat_pages(chat, path, page_size=10)
    assert idx.agg(F.max("n_rows")).first()[0] <= 10
    back = jp.flat_chat_view(jp.read_pages(spark, path, CHAT_PAGE_SCHEMA))
    assert back.count() == chat.count()


def test_stream_matches_batch_run(spark):
    """Streaming the pages into an empty store gives the same dimension as one batch run."""
    chat = fx.v_chat(spark, SF_SMALL)
    path = work_dir(spark, "t-stream-pages")
    jp.write_chat_pages(chat, path)
    root = work_dir(spark, "t-stream")
    store = DimensionStore(spark, f"{root}/store")
    run_ts = dt.datetime(2024, 2, 1)
    stats = ingest_pages(spark, path, store, f"{root}/staging", f"{root}/_ckpt", run_ts, max_files_per_trigger=20)
    assert stats["batches"] > 1
    assert stats["inserted"] == chat.where(F.col("created_ts").isNotNull()).count()
    ref = DimensionStore(spark, work_dir(spark, "t-batch"))
    run_load(ref, chat, run_ts, run_id=1, history=False)
    a, b = store.current(), ref.current()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # re-running the drained stream adds nothing
    again = ingest_pages(spark, path, store, f"{root}/staging", f"{root}/_ckpt", run_ts)
    assert again["inserted"] == 0


def _page(folder, name, days, **kw):
    rows = [{"id": 100 + d, "fromUser": {"id": "9"}, "media": [{"id": str(d), "duration": 5}], "createdAt": f"2025-01-{d:02d} 10:00:00",
             "price": 1.0} for d in days]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"list": rows, "hasMore": True} if kw.get("envelope") else rows, indent=kw.get("indent")))


def _days(frame, column):
    return sorted(r[0].day for r in frame.select(F.col(column).cast("timestamp_ntz")).collect())


def test_stream_keeps_every_batch_and_run(spark, tmp_path):
    """Newest-first pages, two folders with checkpoints of their own, nothing new, indented pages and envelopes."""
    store, run_ts = DimensionStore(spark, work_dir(spark, "t-keep")), dt.datetime(2025, 2, 1)
    staging, root = work_dir(spark, "t-keep-staging"), work_dir(spark, "t-keep-ck")
    first = tmp_path / "a"
    _page(first, "1.json", [20], indent=1)
    _page(first, "2.json", [9, 15], indent=1)
    got = ingest_pages(spark, str(first), store, staging, f"{root}/a", run_ts, max_files_per_trigger=1, multi_line=True)
    assert (got["batches"], got["inserted"]) == (2, 3)
    again = ingest_pages(spark, str(first), store, staging, f"{root}/a", run_ts, multi_line=True)
    assert again["inserted"] == 0 and not again["versions"]
    second = tmp_path / "b"
    _page(second, "1.json", [25, 12], envelope=True)  # the 12th lies inside the loaded range
    _page(second, "2.json", [3], envelope=True)
    got = ingest_pages(spark, str(second), store, staging, f"{root}/b", run_ts, max_files_per_trigger=1, envelope=True)
    assert got["inserted"] == 2
    assert _days(read_staging(spark, staging), "createdAt") == [3, 9, 15, 20, 25]
    assert _days(store.current(), "valid_from_ts") == [3, 9, 15, 20, 25]
    third = tmp_path / "c"
    _page(third, "1.json", [10])
    assert ingest_pages(spark, str(third), store, staging, f"{root}/c", run_ts)["inserted"] == 0


def test_stream_resumes_a_broken_run(spark, tmp_path, monkeypatch):
    """A run that dies after its first batch goes on under the same ranges; one that dies before its snapshot writes it later."""
    from dimweave.streaming import ingest as ing

    store, run_ts = DimensionStore(spark, work_dir(spark, "t-crash")), dt.datetime(2025, 2, 1)
    staging, ck = work_dir(spark, "t-crash-staging"), work_dir(spark, "t-crash-ck")
    folder = tmp_path / "p"
    _page(folder, "1.json", [9, 1])
    calls = []

    def broken(*a, **k):
        calls.append(1)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ing, "_apply_run", broken)
        with pytest.raises(RuntimeError):
            ingest_pages(spark, str(folder), store, staging, ck, run_ts)
    _page(folder, "2.json", [5, 20])
    with monkeypatch.context() as m:
        m.setattr(ing, "append_snapshot", broken)
        with pytest.raises(RuntimeError):
            ingest_pages(spark, str(folder), store, staging, ck, run_ts)
    got = ingest_pages(spark, str(folder), store, staging, ck, run_ts)
    assert got["inserted"] == 4 and len(got["versions"]) == 1
    assert _days(store.current(), "valid_from_ts") == [1, 5, 9, 20]
    assert spark.read.parquet(store.history_path).select("run_id").distinct().count() == 1


def test_time_range_is_scanned_when_not_recorded(spark):
    t = VersionedTable(spark, work_dir(spark, "t-range"))
    rows = spark.createDataFrame([(dt.datetime(2025, 1, 2),)], "valid_from_ts timestamp_ntz")
    t.publish(rows)
    assert t.time_range(ts_col="valid_from_ts") == (dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2))
    with pytest.raises(ValueError):
        t.time_range()


def test_publish_survives_a_dead_writer_and_refuses_a_second_one(spark, monkeypatch):
    rows = spark.createDataFrame([(1,)], "a int")
    t = VersionedTable(spark, work_dir(spark, "t-crash-publish"))
    t.publish(rows)
    with monkeypatch.context() as m:  # dies after the rows are written, before they are committed
        m.setattr(VersionedTable, "_commit", lambda self, row: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            t.publish(rows.union(rows))
    assert t.current_version() == 1 and t.read().count() == 1
    assert t.publish(rows.union(rows)) == 2 and t.read().count() == 2
    real, late = VersionedTable._commit, []

    def overtaken(self, row):  # another writer commits the same version first
        if not late:
            late.append(1)
            VersionedTable(spark, t.path).publish(rows)
        real(self, row)

    monkeypatch.setattr(VersionedTable, "_commit", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        t.publish(rows.union(rows))
    assert t.current_version() == 3 and t.read().count() == 1


def test_work_dir_under_checkpoint(spark):
    d = work_dir(spark, "x")
    root = spark.sparkContext.getCheckpointDir()
    assert d.startswith(root)
    assert local_path(d).startswith("/")
