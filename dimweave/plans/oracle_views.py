"""The fixture views as DuckDB SQL, and a helper that prefixes them as CTEs.

Each oracle query is ``with_views(body)``: the body names the views it reads,
and the needed CTEs (with their dependencies) are emitted in order.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "v_chat": """
select event_id as chat_id, struct_pack(id := cast(user_id as varchar)) as fromUser,
  case event_type
    when 'error' then cast([] as varchar[])
    when 'signup' then cast(null as varchar[])
    when 'purchase' then list_value(
        concat('{"id":', cast(event_id % 97 as varchar), ',"duration":', json_extract_string(props, '$.k'), '}'),
        concat('{"id":', cast(event_id % 89 + 1000 as varchar), '}'))
    else list_value(concat('{"id":', cast(event_id % 97 as varchar), ',"duration":', json_extract_string(props, '$.k'), '}'))
  end as media,
  value as price, ts as created_ts
from events""",
    "v_wall": """
select cast(user_id % 10 as varchar) as author_id, event_id as post_id,
  cast(date_trunc('minute', ts) as timestamp) as posted_ts,
  cast(4000000000 as bigint) + event_id * 10 + (event_id * 37) % 23 - 11 as media_id
from events where event_type in ('view', 'click')""",
    "v_ochat": """
select event_id - event_id % 20 as chat_id, cast((event_id - event_id % 20) % 7 as varchar) as author_id,
  cast(4000000000 as bigint) + (event_id - event_id % 3) * 10 as media_id, value as msg_price,
  cast(json_extract_string(props, '$.k') as int) as media_duration, ts as created_ts
from events where event_type = 'purchase'""",
    "v_versions": """
select cast(user_id as varchar) as author_id, event_type as media_id,
  cast(json_extract_string(props, '$.k') as int) as media_duration, props as media_blob,
  ts as valid_from_ts, md5(props) as checksum
from events""",
    "v_dim": """
select author_id, media_id, media_duration, media_blob, seen_count, valid_from_ts,
  case when cast(author_id as int) % 10 = 3 then coalesce(valid_to_ts, timestamp '2024-02-01 00:00:00') else valid_to_ts end as valid_to_ts,
  cast(author_id as int) % 10 = 3 as is_deleted,
  (valid_to_ts is null and cast(author_id as int) % 10 <> 3) as is_current,
  timestamp '2024-02-01 00:00:00' as extract_ts, checksum
from (select *,
        cast(row_number() over (partition by author_id, media_id order by valid_from_ts) as bigint) as seen_count,
        lead(valid_from_ts) over (partition by author_id, media_id order by valid_from_ts) as valid_to_ts
      from v_versions
      where valid_from_ts >= timestamp '2024-01-08 00:00:00' and valid_from_ts < timestamp '2024-01-22 00:00:00') z""",
    "v_daily": """
select *, timestamp '2024-03-01 00:00:00' as extract_ts from v_versions
where valid_from_ts >= timestamp '2024-01-22 00:00:00'""",
    "v_backfill": """
select *, timestamp '2024-03-01 00:00:00' as extract_ts from v_versions
where valid_from_ts < timestamp '2024-01-08 00:00:00'""",
    "v_rescrape": """
select *, timestamp '2024-03-01 00:00:00' as extract_ts from v_versions
where (valid_from_ts >= timestamp '2024-01-10 00:00:00' and valid_from_ts < timestamp '2024-01-20 00:00:00'
       and cast(author_id as int) % 10 <> 7 and cast(author_id as int) % 20 <> 13)
   or (valid_from_ts >= timestamp '2024-01-22 00:00:00' and cast(author_id as int) % 10 in (1, 2))""",
    "v_merge_src": """
select author_id, media_id, media_duration, media_blob, valid_from_ts
from (select *, row_number() over (partition by author_id, media_id order by valid_from_ts) as rn
      from v_versions
      where (valid_from_ts >= timestamp '2024-01-22 00:00:00' and cast(author_id as int) % 10 in (1, 2, 6))
         or (valid_from_ts < timestamp '2024-01-08 00:00:00' and cast(author_id as int) % 10 in (4, 5))) z
where rn = 1""",
}

_ORDER = list(VIEW_SQL)


def _deps(sql: str, known: dict[str, str]) -> set[str]:
    return {n for n in known if re.search(rf"\b{n}\b", sql)}


def with_views(body: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the view CTEs (and extra named CTEs) it reads."""
    known = dict(VIEW_SQL)
    extra = dict(ctes or {})
    known.update(extra)
    order = _ORDER + list(extra)
    need: set[str] = set()
    todo = list(_deps(body, known))
    while todo:
        n = todo.pop()
        if n in need:
            continue
        need.add(n)
        todo.extend(d for d in _deps(known[n], known) if d != n)
    parts = [f"{n} as ({known[n].strip()})" for n in order if n in need]
    if not parts:
        return body.strip()
    return "with " + ",\n".join(parts) + "\n" + body.strip()
