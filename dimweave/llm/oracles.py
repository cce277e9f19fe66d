"""DuckDB texts of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
src as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source asc nulls last) - 1 as rk
  from sized group by source),
weighted as (
  select *, case rk % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as w, 2.0::double * source_size as cap from src),
tried as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over before, 0.0)) /
            (sum(w) over () - coalesce(sum(w) over before, 0.0)) as lvl
  from weighted
  window before as (order by cap / w, rk rows between unbounded preceding and 1 preceding)),
level as (
  select arg_min(lvl, (cap / w, rk)) filter (where lvl * w <= cap) as lvl from tried),
goal as (
  select source, source_size, case when level.lvl is null then cap else least(cap, level.lvl * w) end as target from weighted cross join level),
queue as (
  select s.doc_id, s.size, g.source_size, g.target,
         case when g.source_size > 0 then floor(g.target / g.source_size)::bigint else 0 end as whole,
         coalesce(sum(s.size) over (partition by s.source
             order by md5(concat_ws(chr(31), coalesce(s.doc_id::varchar, ''), s.size::varchar)), s.doc_id, s.size
             rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from sized s join goal g on s.source is not distinct from g.source),
took as (
  select *, greatest(0, least(size, round(target - whole * source_size)::bigint - before))::bigint as extra from queue)
select doc_id, size, source_size, target, (whole * size + extra)::bigint as taken,
       (case when size > 0 then whole else 0 end + case when extra > 0 then 1 else 0 end)::bigint as passes
from took
"""

OP10 = r"""
with base as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (
  select r, unnest(range(1, greatest(len(ws) - 1, 1))) as i, ws from base),
grams as (
  select r, i, struct_pack(a := ws[i], b := ws[i + 1], c := ws[i + 2]) as g from windows where i + 2 <= len(ws)),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from grams) where n >= 2),
hit as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from twice) group by r),
counted as (
  select b.r, doc_id, source, len(ws)::bigint as n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
         coalesce(hit.n, 0)::bigint as n_repeat_words
  from base b left join hit on hit.r = b.r),
facts as (
  select * exclude (lines), len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines from counted),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         2 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 20 * n_words as own_failed,
         10 * n_dup_lines > 3 * n_lines as line_failed
  from facts),
hosts as (
  select source, count(*) as n, sum((base_failed or own_failed or line_failed)::int) as f from judged group by source),
corpus as (
  select sum(n)::double as n, sum(f)::double / sum(n) as m, count(*) as k, sum(n * (f / n) * (f / n)) as sq from hosts),
prior as (
  select m, greatest(2.0, least(1000.0, case when sq / n - m * m - m * (1 - m) * k / n > 0
         then m * (1 - m) / (sq / n - m * m - m * (1 - m) * k / n) - 1 else 1000.0 end)) as w from corpus),
verdicts as (
  select source, (f + m * w) / (n + w) > 0.5 as rejected from hosts cross join prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or own_failed or rejected) as kept
from judged join verdicts on judged.source is not distinct from verdicts.source
"""

OP2 = r"""
with base as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
starts as (
  select r, unnest(range(1, len(ws) - 33)) as i, ws from base where len(ws) >= 35),
hashed as (
  select r, i, md5(array_to_string(ws[i:i + 34], ' ')) as h from starts),
twice as (
  select r, i from (select r, i, count(*) over (partition by h) as n from hashed) where n >= 2),
gone as (
  select distinct r, unnest(range(i, i + 35)) as p from twice),
gone_lists as (
  select r, list(p) as ps from gone group by r),
words as (
  select b.r, b.doc_id, ws, unnest(range(1, len(ws) + 1)) as p from base b),
kept as (
  select w.r, string_agg(ws[w.p], ' ' order by w.p) as t, count(*) as n
  from words w anti join gone g on w.r = g.r and w.p = g.p group by w.r)
select b.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(k.n, 0))::bigint as n_removed,
       sha256(coalesce(k.t, '')) as kept_sha256
from base b left join kept k on k.r = b.r
"""

OP6 = r"""
with recursive base as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
places as (
  select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) as i from base),
grams as (
  select distinct doc_id, array_to_string(ws[i:i + 2], ' ') as g from places),
sizes as (
  select b.doc_id, count(g.g) as n from base b left join grams g using (doc_id) group by b.doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as c from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by all),
links as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 90 * (p.n + q.n - c)),
edges as (
  select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id as r from sizes
  union
  select reach.doc_id, e.b from reach join edges e on e.a = reach.r)
select s.doc_id, s.n::bigint as n_shingles, min(r.r) as component_id
from sizes s join reach r on r.doc_id = s.doc_id group by all
"""

def _cluster_sql(rounds: int = 3) -> str:
    """Every distance computed anew in every round; a mean's floor from the remainder made positive."""
    steps = ["""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS k, x FROM v QUALIFY k < 16)"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS (SELECT r, vec_id, x, k, d FROM (
        SELECT v.r, v.vec_id, v.x, c.k, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{t} c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if t < rounds:
            steps.append(f"""m{t} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x
    FROM (SELECT k, j, sum(x[j]) AS s, count(*) AS n FROM a{t}, range(1, 65) g(j) GROUP BY k, j) GROUP BY k),
c{t + 1} AS (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN m{t} m USING (k))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"""


RANKED = r"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
n AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY ALL),
corpus AS (SELECT count(*) AS documents, sum(n) AS length FROM n),
m AS (SELECT doc_id, CAST(100 - 50 + (50 * n * documents) // length AS BIGINT) AS m FROM n, corpus),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, documents),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""


ORACLES = {"op6_ngram_jaccard_join": OP6, "op2_substring_dedup": OP2, "op8_mixing": OP8, "op10_quality_rules": OP10,
           "op12_centroid_clustering": _cluster_sql(), "op13_ranked_search": RANKED}
