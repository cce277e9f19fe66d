"""Groups of near copies stay linear, passages below 400 bytes leave the pipeline, tasks keep to little room."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from dimweave.llm import jaccard_join, k2_treap, packing, word_table
from dimweave.llm.common import byte_rows, stored


def _watched(monkeypatch):
    """Rows of the tables that the join stores, by name."""
    rows = {}

    def counted(df, name):
        out = stored(df, name)
        rows.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(jaccard_join, "stored", counted)
    return rows


def test_columns_of_the_same_rows_are_multiplied_once(spark, monkeypatch):
    rng = random.Random(1)
    base = [f"w{rng.randrange(9000)}" for _ in range(2000)]
    texts = [" ".join(base), " ".join(base[:1700] + [f"x{k}" for k in range(320)]), "some other text of few words"]
    docs = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "two-long")
    rows = _watched(monkeypatch)
    got = {r.doc_id: r.component_id for r in jaccard_join.cluster(docs, percent=80, size=5).collect()}
    assert got == {0: 0, 1: 1, 2: 2}
    assert max(rows["jaccard-columns"]) <= 1


def test_what_is_near_a_group_is_not_multiplied_with_all_of_it(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(9000)}" for _ in range(200)]
    texts = [" ".join(base)]
    for k in range(240):
        copy = list(base)
        for at in rng.sample(range(5, 195), 4):
            copy[at] = f"x{k}-{at}"
        texts.append(" ".join(copy))
    docs = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "group")
    rows = _watched(monkeypatch)
    got = jaccard_join.cluster(docs, percent=80, size=5).collect()
    assert {r.component_id for r in got} == {0}  # all link with the base
    assert rows["jaccard-left"][0] < 4 * len(texts), rows


def test_pipeline_removes_passages_of_over_fifty_words(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 6)))
    passage = " ".join(word() for _ in range(55))
    assert corpus_pipeline.PASSAGE_BYTES < len(passage) < 400
    own = [" ".join(word() for _ in range(80)) for _ in range(6)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]} {passage}", own[3], f"{own[4]} {passage[:200]}", f"{own[5]} {passage[:200]}", None]
    docs = stored(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"), "passages")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages_stage(spark, docs, "").collect()}
    assert passage not in got[0] and passage not in got[1] and own[0][:-1] in got[0] and own[1][1:] in got[0] and own[2][:-1] in got[1]
    assert [got[k] for k in (2, 5)] == [texts[2], None]
    assert [len(got[k]) for k in (3, 4)] == [len(texts[3]), len(texts[4])]  # 200 bytes are too few


def test_counting_terms_takes_little_room():
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 5000, 400)) for _ in range(4000)])
    tracemalloc.start()
    for _, _, data, offsets in byte_rows(texts, min(k2_treap.PIECE, k2_treap.SHARD_BYTES)):
        k2_treap.term_counts(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6


def test_splitting_plain_texts_loads_no_library(monkeypatch):
    import public_tokenizers as P
    words = word_table.Vocabulary(P.path("byte_bpe_50k.json"), P.PATTERN)
    monkeypatch.setattr(word_table.Vocabulary, "_library", lambda self: pytest.fail("loaded"))
    assert words.splitter()("plain words, été") == ["plain", " words", ",", " été"]


def test_bm25_lists_shrink_with_the_documents_left():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 200, 60).astype(np.uint32) for _ in range(100)]
    index, whole = packing.Bm25(docs), packing.Bm25(docs)
    used = np.zeros(100, bool)
    for seed in range(99):
        used[seed] = True
        got = index.neighbours(seed, used)
        whole.gone = 100  # never shrinks
        assert got.tolist() == whole.neighbours(seed, used).tolist() and not used[got].any()
    assert len(index.doc) < len(whole.doc) / 2
