"""Registered queries against their DuckDB texts, and the pipeline's decisions, on the small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dimweave.llm import common, fm_index, oracles, suffix_sort

from conftest import SF_SMALL


@pytest.mark.parametrize("key", sorted(oracles.ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{SF_SMALL}/{name}.parquet')")
    want = con.sql(oracles.ORACLES[key])
    got = entry.queries()[key](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    at = [got.columns.index(c) for c in want.columns]
    assert sorted(tuple(r[i] for i in at) for r in got.collect()) == sorted(want.fetchall())


def test_all_queries_are_registered():
    names = [k for k in entry.queries() if k == "pipeline" or k.startswith("op")]
    assert {k.split("_")[0] for k in names} == {"pipeline", *(f"op{n}" for n in range(1, 14))}


def _least_of_groups(docs, words=5, percent=80):
    """The smallest id of each group of near copies, by comparing all sets; texts without words are groups of their own."""
    sets = []
    for d in docs:
        w = [x.lower() for x in (d.text or "").encode().split()]
        sets.append({tuple(w[i:i + words]) for i in range(max(len(w) - words + 1, min(len(w), 1)))})
    root = list(range(len(docs)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for d, r in zip(docs, root):
        least[r] = min(least.get(r, d.doc_id), d.doc_id)
    return sorted(least.values())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen, columns = [docs], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF_SMALL).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen[-1].columns == columns, name
    _, ruled, unique, clean, mixed, packed = seen
    kept = {r.doc_id for r in entry.queries()["op10_quality_rules"](spark, SF_SMALL).where("kept").collect()}
    assert {r.doc_id for r in ruled.select("doc_id").collect()} == kept
    assert sorted(r.doc_id for r in unique.select("doc_id").collect()) == _least_of_groups(ruled.collect())
    assert suffix_sort.remove_repeats(clean, ["doc_id"]).agg({"n_removed": "sum"}).first()[0] < clean.selectExpr("sum(octet_length(text))").first()[0] / 100
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in mixed.select("doc_id").distinct().collect()}
    assert fm_index.remove_repeats(clean, ["doc_id"]).count() == clean.count()


def _rows(frame):
    return sorted((tuple(map(str, r)) for r in frame.collect()))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op6_ngram_jaccard_join", "op9_suffix_dedup", *(n for n, _ in corpus_pipeline.STAGES[:3])])
def test_rows_do_not_depend_on_how_files_are_dealt(spark, monkeypatch, tmp_path, name):
    """Executors that come or go change how a scan is cut between the jobs of one query."""
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run():
        if name in stages:
            return _rows(stages[name](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)))
        return _rows(entry.queries()[name](spark, str(tmp_path)))

    want, real, calls = run(), common.stored, []

    def dealt_anew(df, label):
        calls.append(label)
        spark.conf.set("spark.sql.files.minPartitionNum", str(1 + 7 * (len(calls) % 3)))
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 + 90_000 * (len(calls) % 2)))
        return real(df, label)

    import importlib
    for module in ("anchors", "jaccard_join", "quality_rules", "suffix_sort", "fm_index"):
        m = importlib.import_module(f"dimweave.llm.{module}")
        if hasattr(m, "stored"):
            monkeypatch.setattr(m, "stored", dealt_anew)
    monkeypatch.setattr(corpus_pipeline, "stored", dealt_anew)
    spark.conf.set("spark.sql.files.minPartitionNum", "13")
    try:
        assert run() == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
