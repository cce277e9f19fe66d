"""The pipeline's stages and the operators at places where a part of the job could be left out unseen."""

import hashlib
import random

import numpy as np

import corpus_pipeline
from dimweave.llm import mixing, packing, queries
from dimweave.llm.common import stored


def _near(a, b, words, percent):
    def grams(text):
        w = text.lower().split()
        return {tuple(w[i:i + words]) for i in range(max(len(w) - words + 1, min(len(w), 1)))}
    x, y = grams(a), grams(b)
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def test_near_copies_stage_against_brute_force(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        scattered = [f"x{i}" if i in (30, 80, 130, 180) else w for i, w in enumerate(base)]
        much = [f"y{i}" if i % 20 == 10 else w for i, w in enumerate(base)]
        texts += [" ".join(x) for x in (base, scattered, base + [f"z{rng.randrange(5000)}" for _ in range(30)], much, base[:150])]
    texts += ["", "one two three", "one two three", "one two", " ".join(texts[0].split()[:40])]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if _near(texts[i], texts[j], 5, 80):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert root != list(range(len(texts))) and any(_near(texts[i], texts[i + 1], 5, 80) and not _near(texts[i], texts[i + 1], 3, 90) for i in range(30))
    docs = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "near-copies")
    got = corpus_pipeline.near_copies_stage(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(root))


def test_ids_of_added_tokens_inside_texts():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"one {end} two", end, f"{end}{end} x", f"word{end}word", f"  {end}\n\n {end}tail  ", f"\u00e9\u2003{end}\u3000 y", "", "plain", "<|endoftext|", f"<|{end}|>"]
    got = packing.Encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)(texts)
    assert [x.tolist() for x in got] == [own.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_packing_finds_neighbours_in_far_files(spark, tmp_path):
    import public_tokenizers as P
    rng = random.Random(3)
    topics = [[f"{chr(97 + t)}{rng.randrange(100, 999)}" for _ in range(40)] for t in range(8)]
    rows = [(8 * f + t, " ".join(rng.choices(topics[t], k=60))) for f in range(6) for t in range(8)]
    for f in range(6):  # every file holds one document of each topic
        spark.createDataFrame(rows[8 * f:8 * f + 8], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    got = packing.pack(spark.read.parquet(str(tmp_path / "d")), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, window=512, shard=1500).collect()
    laid = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    near = [x.doc_id % 8 == y.doc_id % 8 for x, y in zip(laid, laid[1:]) if x.sequence_id == y.sequence_id]
    assert sum(near) > len(near) / 2
    assert sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values())


def test_packing_scores_all_terms_by_corpus_statistics():
    seed = np.append(np.repeat(np.arange(100, 120), 1), np.arange(200, 230))
    shares_rare = np.append(np.arange(100, 112), np.arange(500, 538))  # the twelve terms that are rarest here
    shares_many = np.append(np.arange(200, 230), np.arange(600, 620))
    docs = [x.astype(np.uint32) for x in (seed, shares_rare, shares_many, shares_many)]
    df = np.full(1000, 2)
    df[100:120] = 900  # common in the corpus
    index = packing.Bm25(docs, packing.Statistics(1000, 50.0, df))
    used = np.array([True, False, False, False])
    assert index.neighbours(0, used)[0] == 2


def test_mixing_query_returns_the_training_order(spark):
    """Positions by bisection of the integrated schedules, against the order of the query's rows."""
    import duckdb
    from conftest import SF_SMALL
    got = queries.op8_mixing(spark, SF_SMALL).collect()
    source = dict(duckdb.sql(f"select doc_id, source from read_parquet('{SF_SMALL}/documents.parquet')").fetchall())
    ranks = {s: i for i, s in enumerate(sorted({x for x in source.values() if x is not None}) + [None])}

    def reached(knots, share):
        def done(t):
            return sum((min(t, t1) - t0) * (w0 + w0 + (w1 - w0) * (min(t, t1) - t0) / (t1 - t0)) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]) if t > t0)
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if done(mid) < share * done(1.0) else (lo, mid)
        return lo

    at, queue = {}, {}
    for r in got:
        queue.setdefault(source[r.doc_id], []).append((hashlib.md5(f"{r.doc_id}\x1f{r.size}".encode()).hexdigest(), r.doc_id, r))
    for s, rows in queue.items():
        before = 0
        for _, i, r in sorted(rows, key=lambda x: x[:2]):
            if r.passes:
                at[i] = reached(mixing.SCHEDULES[ranks[s] % 3], min(1.0, (before + r.size / 2) / r.target))
            before += r.size
    times = [at.get(r.doc_id, 2.0) for r in got]
    assert len(set(times)) > 100 and all(a <= b + 1e-9 for a, b in zip(times, times[1:]))


def test_sequences_follow_the_stored_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing.pack, "__defaults__", tuple(6000 if x == packing.SHARD else x for x in packing.pack.__defaults__))
    rng = random.Random(6)
    n = 3000
    rows = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(5 if i < 1000 else 60 if i < 2000 else 20))) for i in range(n)]
    path = str(tmp_path / "mix")
    spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(12, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() > 2
        assert [r.doc_id for r in docs.collect()] != list(range(n))  # the scan does not follow the files
        got = corpus_pipeline.packing_stage(spark, docs, "").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    first = {}
    for r in got:
        first[r.doc_id] = min(first.get(r.doc_id, r.sequence_id), r.sequence_id)
    assert sorted(first) == list(range(n))
    # retrieval reorders inside a shard of 6,000 bytes (under 300 of the shortest texts), never beyond it
    order = sorted(first, key=lambda i: (first[i], i))
    assert max(abs(i - k) for k, i in enumerate(order)) < 400
