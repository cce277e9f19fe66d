"""Golden cases of the type 2 apply (given/expect rows of the reference's unit tests).

Rows use the compact notation of FIXTURES.md:
``author/media dDURATION #seen [from,to) xEXTRACT del=? cur=?`` (times in 2025).
"""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from dimweave.operators.scd2 import apply_batch
from dimweave.schemas import DIM_SCHEMA, empty_dim

ROW = re.compile(r"(\d+)/(\d+) d(\d+)(?: #(\d+))? \[([\dT:-]+)(?:,([\dT:-]+|∅))?\) x([\dT:-]+)"
                 r"(?: del=([TF]) cur=([TF]))?")


def _ts(s):
    return None if s in (None, "∅") else dt.datetime.fromisoformat(f"2025-{s}:00")


def parse(line):
    m = ROW.fullmatch(line.strip())
    assert m, line
    a, med, d, seen, vf, vt, ex, dele, cur = m.groups()
    blob = f'{{"id":"{med}","duration":{d}}}'
    return dict(author_id=a, media_id=med, media_duration=int(d), media_blob=blob,
                seen_count=int(seen) if seen else None, valid_from_ts=_ts(vf), valid_to_ts=_ts(vt),
                is_deleted=dele == "T" if dele else None, is_current=cur == "T" if cur else None,
                extract_ts=_ts(ex))


def dim_df(spark, lines):
    if not lines:
        return empty_dim(spark)
    rows = []
    for ln in lines:
        r = parse(ln)
        r["checksum"] = None
        rows.append(tuple(r[f.name] for f in DIM_SCHEMA.fields))
    return spark.createDataFrame(rows, DIM_SCHEMA).withColumn("checksum", F.md5("media_blob"))


def batch_df(spark, lines):
    rows = []
    for ln in lines:
        r = parse(ln)
        rows.append((r["author_id"], r["media_id"], str(r["media_duration"]), r["media_blob"], 1,
                     r["valid_from_ts"], None, True, r["extract_ts"]))
    schema = ("author_id string, media_id string, media_duration string, media_blob string, "
              "seen_count int, valid_from_ts timestamp_ntz, valid_to_ts timestamp_ntz, "
              "is_current boolean, extract_ts timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def expect(lines):
    out = []
    for ln in lines:
        r = parse(ln)
        out.append((r["author_id"], r["media_id"], r["media_duration"], r["seen_count"],
                    r["valid_from_ts"], r["valid_to_ts"], r["is_deleted"], r["is_current"], r["extract_ts"]))
    return sorted(out, key=repr)


CASES = {
    "T1_includes_source_when_target_empty": (
        [], ["903/103 d240 [04-15T10:00) x04-16T00:00"],
        ["903/103 d240 #1 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T2_recalculates_history_for_matching_newer_source": (
        ["904/104 d120 #1 [04-01T08:00,∅) x04-01T09:00 del=F cur=T"],
        ["904/104 d120 [04-15T10:00) x04-16T00:00"],
        ["904/104 d120 #1 [04-01T08:00,04-15T10:00) x04-01T09:00 del=F cur=F",
         "904/104 d120 #2 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T3_keeps_target_and_adds_source_when_no_key_match": (
        ["905/105 d90 #1 [04-01T08:00,∅) x04-01T09:00 del=F cur=T"],
        ["906/106 d150 [04-15T10:00) x04-16T00:00"],
        ["905/105 d90 #1 [04-01T08:00,∅) x04-01T09:00 del=F cur=T",
         "906/106 d150 #1 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T4_builds_history_from_multiple_source_updates_when_target_empty": (
        [], ["907/107 d100 [04-10T09:00) x04-16T00:00", "907/107 d100 [04-15T10:00) x04-16T00:00"],
        ["907/107 d100 #1 [04-10T09:00,04-15T10:00) x04-16T00:00 del=F cur=F",
         "907/107 d100 #2 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T5_recomputes_history_when_source_is_older_than_matching_target": (
        ["908/108 d220 #1 [04-20T12:00,∅) x04-20T13:00 del=F cur=T"],
        ["908/108 d220 [04-10T09:00) x04-11T00:00"],
        ["908/108 d220 #1 [04-10T09:00,04-20T12:00) x04-11T00:00 del=F cur=F",
         "908/108 d220 #2 [04-20T12:00,∅) x04-20T13:00 del=F cur=T"]),
    "T6_marks_target_deleted_when_recent_backfill_omits_it": (
        ["911/111 d101 #2 [05-12T09:00,∅) x05-12T10:00 del=F cur=T",
         "911/111 d101 #1 [04-12T09:00,05-12T09:00) x04-12T10:00 del=F cur=F",
         "912/112 d202 #1 [04-10T08:00,∅) x04-10T09:00 del=F cur=T",
         "913/113 d303 #1 [04-15T18:00,∅) x04-15T20:00 del=F cur=T"],
        ["912/112 d202 [04-10T08:00) x06-10T09:00", "913/113 d303 [04-15T18:00) x06-10T09:00"],
        ["911/111 d101 #1 [04-12T09:00,05-12T09:00) x04-12T10:00 del=T cur=F",
         "911/111 d101 #2 [05-12T09:00,∅) x05-12T10:00 del=F cur=T",
         "912/112 d202 #1 [04-10T08:00,∅) x04-10T09:00 del=F cur=T",
         "913/113 d303 #1 [04-15T18:00,∅) x04-15T20:00 del=F cur=T"]),
    "T7_marks_deleted_when_backfill_misses_key": (
        ["914/114 d111 #1 [04-12T12:00,∅) x04-12T13:00 del=F cur=T",
         "915/115 d222 #1 [04-11T12:00,∅) x05-10T09:00 del=F cur=T",
         "916/116 d333 #1 [04-14T18:00,∅) x04-14T19:00 del=F cur=T"],
        ["915/115 d222 [04-11T12:00) x06-10T09:00", "916/116 d333 [04-14T18:00) x06-10T09:00"],
        ["914/114 d111 #1 [04-12T12:00,06-10T09:00) x04-12T13:00 del=T cur=F",
         "915/115 d222 #1 [04-11T12:00,∅) x05-10T09:00 del=F cur=T",
         "916/116 d333 #1 [04-14T18:00,∅) x04-14T19:00 del=F cur=T"]),
    "T8_reactivates_deleted_inactive_when_key_reappears": (
        ["917/117 d111 #2 [05-01T08:00,∅) x05-01T09:00 del=F cur=T",
         "917/117 d111 #1 [04-01T08:00,05-01T08:00) x06-10T08:00 del=T cur=F"],
        ["917/117 d111 [04-01T08:00) x07-10T09:00", "917/117 d111 [05-01T08:00) x07-10T09:00"],
        ["917/117 d111 #1 [04-01T08:00,04-01T08:00) x07-10T09:00 del=F cur=F",
         "917/117 d111 #2 [05-01T08:00,∅) x05-01T09:00 del=F cur=T"]),
    "T9_newer_source_differing_checksum": (
        ["920/120 d120 #1 [04-01T08:00,∅) x04-01T09:00 del=F cur=T"],
        ["920/120 d180 [04-15T10:00) x04-16T00:00"],
        ["920/120 d120 #1 [04-01T08:00,04-15T10:00) x04-01T09:00 del=F cur=F",
         "920/120 d180 #2 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T10_multiple_updates_target_empty_differing_checksum": (
        [], ["921/121 d100 [04-10T09:00) x04-16T00:00", "921/121 d130 [04-15T10:00) x04-16T00:00"],
        ["921/121 d100 #1 [04-10T09:00,04-15T10:00) x04-16T00:00 del=F cur=F",
         "921/121 d130 #2 [04-15T10:00,∅) x04-16T00:00 del=F cur=T"]),
    "T11_older_source_differing_checksum": (
        ["922/122 d220 #1 [04-20T12:00,∅) x04-20T13:00 del=F cur=T"],
        ["922/122 d180 [04-10T09:00) x04-11T00:00"],
        ["922/122 d180 #1 [04-10T09:00,04-20T12:00) x04-11T00:00 del=F cur=F",
         "922/122 d220 #2 [04-20T12:00,∅) x04-20T13:00 del=F cur=T"]),
    "T12_reactivates_deleted_differing_checksum": (
        ["923/123 d111 #1 [04-01T08:00,06-10T08:00) x06-10T08:00 del=T cur=F"],
        ["923/123 d222 [07-10T08:00) x07-10T09:00"],
        ["923/123 d111 #1 [04-01T08:00,07-10T08:00) x06-10T08:00 del=F cur=F",
         "923/123 d222 #2 [07-10T08:00,∅) x07-10T09:00 del=F cur=T"]),
}

COLS = ["author_id", "media_id", "media_duration", "seen_count", "valid_from_ts", "valid_to_ts",
        "is_deleted", "is_current", "extract_ts"]


@pytest.mark.parametrize("versioned", [True, False])
@pytest.mark.parametrize("name", sorted(CASES))
def test_golden(spark, name, versioned):
    before, batch, after = CASES[name]
    out = apply_batch(dim_df(spark, before), batch_df(spark, batch), dim_is_versioned=versioned)
    got = sorted((tuple(r) for r in out.select(*COLS).collect()), key=repr)
    assert got == expect(after)
    # the checksum is md5 of the blob for every row
    assert out.where(F.col("checksum") != F.md5("media_blob")).count() == 0


def test_known_md5(spark):
    df = spark.createDataFrame([('{"id":"103","duration":240}',)], "b string")
    assert df.select(F.md5("b")).first()[0] == "406bfcd69dc2ec1871fbcd692d186261"
