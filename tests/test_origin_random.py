"""Randomised differential test of origin-date attribution against the DuckDB oracle text:
shared posting minutes across authors, null posting times, null and zero durations,
media re-sent in later messages."""

import datetime as dt
import random
import re

import duckdb
import pandas as pd
import pytest

from dimweave.operators.origin import origin_date
from dimweave.plans.oracle_views import with_views
from dimweave.plans.q_origin import ORIGIN_BODY, WALL_CTES

BASE = dt.datetime(2024, 12, 30, 22)
OUT = ["created_date", "media_id", "media_duration", "msg_price", "media_count", "duration_ratio",
       "approx_origin_date"]
def _case(seed):
    r = random.Random(seed)
    minutes = [BASE + dt.timedelta(minutes=37 * i) for i in range(12)]
    wall = []
    for post in range(r.randint(5, 25)):
        ts = None if r.random() < 0.08 else r.choice(minutes)
        wall.append((str(r.randint(0, 2)), post, ts, 1000 + r.randint(0, 60) * 10))
    chat = []
    for msg in range(r.randint(1, 8)):
        created = BASE + dt.timedelta(hours=r.randint(0, 40))
        for _ in range(r.randint(1, 3)):
            chat.append((msg * 100, str(r.randint(0, 2)), 990 + r.randint(0, 70) * 10,
                         float(r.randint(1, 5)), r.choice([None, 0, 30, 60, 90]), created))
    return wall, chat


@pytest.mark.parametrize("seed", range(8))
def test_origin_date_matches_oracle(spark, seed):
    wall, chat = _case(seed)
    w = spark.createDataFrame(wall, "author_id string, post_id bigint, posted_ts timestamp_ntz, media_id bigint")
    c = spark.createDataFrame(chat, "chat_id bigint, author_id string, media_id bigint, msg_price double, "
                                    "media_duration int, created_ts timestamp_ntz")
    got = origin_date(c, w, min_year=2025, sort=False).select(*OUT).collect()

    con = duckdb.connect()
    con.register("w_raw", pd.DataFrame(wall, columns=["author_id", "post_id", "posted_ts", "media_id"]))
    con.register("c_raw", pd.DataFrame(chat, columns=["chat_id", "author_id", "media_id", "msg_price",
                                                      "media_duration", "created_ts"]))
    con.execute("create view w_in as select author_id, post_id, cast(posted_ts as timestamp) as posted_ts, "
                "media_id from w_raw")
    con.execute("create view c_in as select chat_id, author_id, media_id, msg_price, "
                "cast(media_duration as int) as media_duration, cast(created_ts as timestamp) as created_ts "
                "from c_raw")
    def own(text):
        return re.sub(r"\bv_wall\b", "w_in", re.sub(r"\bv_ochat\b", "c_in", text))

    want = con.sql(with_views(own(ORIGIN_BODY.format(min_year=2025)), {k: own(v) for k, v in WALL_CTES.items()})).fetchall()

    def norm(rows):
        return sorted((tuple(None if pd.isna(v) else v for v in row) for row in rows), key=repr)
    assert norm(tuple(r) for r in got) == norm(want), (seed, wall, chat)
