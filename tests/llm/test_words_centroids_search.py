"""Distinct-word encoding, incremental centroids and the K2-treap search against plain forms."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimweave.llm import centroids, k2_treap, queries, word_table
from dimweave.llm.common import stored

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers as P
    return word_table.Vocabulary(P.path("byte_bpe_50k.json"), P.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(vocabulary.path)
    out.no_truncation()
    out.no_padding()
    return out


END = "<|endoftext|>"
TEXTS = [None, "", " ", "\n\n  x", "it's we'll 12345  a\t\tb \r\n", f"one {END} two", END, f"{END}{END} x", f"w{END}w", f"  {END}\n\n {END}t  ", "<|endoftext|", f"<|{END}|>",
         "été naïve 中文字符 עברית 👍🏽 ‍﻿", " 　 y\x85z\x1c!", "a\x00b", "word " * 5000, "x" * 30_000, "same", "same", "ʼn՘࢏ 1\U00020000 \U000323b0\U0003fc3f"]


def test_ids_and_texts_equal_the_library(spark, vocabulary, library, monkeypatch):
    rows = [(i, t, 7, "clash") for i, t in enumerate(TEXTS)] + [(None, "null id", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _block int, _keys string").repartition(3)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, k) for i, t, _, k in rows)
    for block, portion in ((1 << 23, 1 << 19), (40, 16)):  # one block a task, and many
        monkeypatch.setattr(word_table, "PORTION", portion)
        monkeypatch.setattr(word_table.text_blocks, "__defaults__", (block,))
        got = word_table.encode_and_decode(docs, vocabulary, keep=["doc_id", "_keys"])
        assert got.columns == ["doc_id", "_keys", "ids", "text"]
        found = sorted((str(r.doc_id), list(r.ids), r._keys, r.text) for r in got.collect())
        assert [x[:3] for x in found] == want
        assert [x[3] for x in found] == [library.decode(w[1], skip_special_tokens=False) for w in want]
        assert sorted((str(r.doc_id), list(r.ids)) for r in word_table.encode(docs, vocabulary).collect()) == [w[:2] for w in want]


def test_words_of_all_signs(vocabulary, library):
    split = vocabulary.splitter()
    signs = [*range(0xD800), *range(0xE000, 0x12000), *range(0x1F000, 0x20000), *range(0x2A600, 0x2A700), *range(0x32300, 0x32400), *range(0xE0000, 0xE0200)]
    for k in range(0, len(signs), 4096):
        text = "".join(f"a{c}1 {c}{c} {c}!\n" for c in map(chr, signs[k:k + 4096]))
        assert split(text) == [text[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_each_word_is_encoded_once(spark, vocabulary, monkeypatch):
    texts = [" ".join(random.Random(i).choices(["red", "green", "blue", "grey"], k=50)) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    blocks = word_table.text_blocks(docs, "text", ["doc_id"], vocabulary, 300)
    assert blocks.where("_part < 0").count() > 8
    sent = blocks.where("_part >= 0").count()
    assert sent <= 8 * blocks.where("_part < 0").count()  # a block sends its distinct words, not its places

    class Counting(word_table.Vocabulary):
        def encoder(self):
            inner = super().encoder()

            def encode(words):
                if len(set(words)) != len(words):
                    raise AssertionError("a word twice")
                return inner(words)
            return encode

    own = Counting(vocabulary.path, vocabulary.pattern)
    parts = word_table.encoded_words(blocks, own)
    assert parts.count() == sent


def test_decode_of_any_ids(spark, vocabulary, library):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(50257) for _ in range(rng.choice([0, 1, 30]))]) for i in range(60)] + [(100, None), (101, [50256]), (102, [127, 50256, 220])]
    got = word_table.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary)
    assert sorted(map(tuple, got.collect())) == sorted((i, library.decode(x or [], skip_special_tokens=False)) for i, x in rows)
    for bad in (50257, -1, None):
        with pytest.raises(Exception):
            word_table.decode(spark.createDataFrame([(1, [5, bad])], "doc_id long, ids array<int>"), vocabulary).collect()


def test_query_op11_equals_the_library(spark, library):
    got = {r.doc_id: r for r in queries.op11_bpe_word_table(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# --- centroids --------------------------------------------------------------------------------

def _plain_clusters(rows, dim, k, rounds, seed=1):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * x) for x in v]))
    def name(r):
        return hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]
    cents = [x for _, x in sorted(kept, key=name)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        held = [[] for _ in cents]
        for _, x in kept:
            held[nearest(x)[1]].append(x)
        cents = [[sum(col) // len(h) for col in zip(*h)] if h else c for c, h in zip(cents, held)]
    out = [(i, *nearest(x)) for i, x in kept]
    per = Counter()
    for _, d, j in out:
        per[j] += d
    return sorted((str(i), j, d, per[j], sum(per.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, d, j in out)


def test_clusters_equal_plain_rounds(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(rng.choice([-1, 1]) * (d % 3), 0.4) for d in range(6)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 400)]  # a third of all rows equal
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (500, None), (501, [0.5] * 5), (502, [0.5] * 7), (503, [None] + [0.1] * 5),
             (504, [float("nan")] + [0.1] * 5), (505, [float("inf")] + [0.1] * 5), (506, [-0.0] * 6), (507, [1e-300, -1e-300] * 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("_x", F.lit(1)).withColumn("cluster", F.lit("x"))
    for k, rounds in ((16, 3), (3, 5), (600, 1)):
        state, final = centroids.cluster_vectors(frame, dim=6, k=k, rounds=rounds)
        got = centroids.with_inertia(state, final).select("_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == _plain_clusters(rows, 6, k, rounds)
        # the kept products are the ones a fresh multiplication gives
        for r in state.collect():
            assert r._dots == [sum(a * b for a, b in zip(r._x, c)) for c in final.tolist()]


def test_only_changed_components_are_multiplied():
    x, old = np.arange(24).reshape(4, 6), np.zeros((2, 6), np.int64)
    old[0], old[1] = 3, -2
    new = old.copy()
    new[0, 2], new[1, 5] = 9, 4

    class Watched(np.ndarray):
        seen: list = []

        def __getitem__(self, at):
            if isinstance(at, tuple):
                Watched.seen.append(np.asarray(at[1]).tolist())
            return np.asarray(super().__getitem__(at))

    got = centroids.updated_products(x.view(Watched), x @ old.T, new - old)
    assert (got == x @ new.T).all() and Watched.seen == [[2], [5]]


def test_vectors_none_few_or_too_large(spark):
    empty = spark.createDataFrame([(1, [0.1])], "vec_id long, embedding array<float>")
    state, final = centroids.cluster_vectors(empty)
    assert len(final) == 0 and centroids.with_inertia(state, final).count() == 0
    one = spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, embedding array<float>")
    assert [(r.cluster, r.distance, r.inertia) for r in centroids.with_inertia(*centroids.cluster_vectors(one)).collect()] == [(0, 0, 0)]
    with pytest.raises(Exception, match="in magnitude"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>"))


# --- search -----------------------------------------------------------------------------------

def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain_search(docs, items, top=50):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for k, t in items:
        found = []
        for i, c in counted:
            n, score = sum(c.values()), 0
            for w in set(_terms(t)) & set(c):
                m = 100 - 50 + 50 * n * n_docs // length
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i))
        out += [(str(k), r + 1, str(i), -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out)


def _corpus():
    rng = random.Random(7)
    words = [f"t{i}" for i in range(300)] + ["the"] * 60 + ["été", "中文", "É", "Ab9"]
    docs = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "\n", "-"]) for _ in range(rng.choice([1, 5, 40, 400])))) for i in range(400)]
    docs += [(i, docs[3][1]) for i in range(400, 600)]  # a third of all rows equal: ties
    docs += [(700, None), (701, ""), (702, " .,"), (703, "THE the The"), (5, "the t1 t2"), (None, "t1 t2 t3 é"), (None, "x" * 4000)]
    items = [(k, " ".join(rng.sample(words, rng.choice([1, 3, 30])))) for k in range(30)]
    return docs, items + [(30, None), (31, "nowhere"), (32, "the"), (32, docs[3][1]), (33, docs[3][1]), (34, "THE The the"), (35, "É été")]


@pytest.mark.parametrize("shard,terms", [((6 << 20, 4096), 100_000), ((3000, 64), 40)])
def test_search_equals_scoring_every_document(spark, monkeypatch, shard, terms):
    for name, value in (("SHARD_BYTES", shard[0]), ("SHARD_DOCS", shard[1]), ("ITEM_TERMS", terms), ("SEED_SHARES", 3), ("SPLIT", 4)):
        monkeypatch.setattr(k2_treap, name, value)
    docs, items = _corpus()
    frame = stored(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, _terms string").repartition(3), "search-docs")
    asked = stored(spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(1)), "search-items")
    got = k2_treap.ranked_search(frame, asked).collect()
    # item 32 has two rows, each ranked by itself
    assert sorted((str(r._id), r.rank, str(r.doc_id), r.score) for r in got) == _plain_search(docs, items)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.withColumn("text", F.lit(None).cast("string")), items)):
        assert k2_treap.ranked_search(stored(d, "none"), stored(i, "none")).count() == 0


def test_one_long_text_counts_like_many_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    text = " ".join(f"w{k}" for k in rng.integers(0, 50, 4000)).encode()
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = {int(h): int(c) for _, h, c in zip(*k2_treap.term_counts(data, bounds))}
    monkeypatch.setattr(k2_treap, "PIECE", 300)
    cut = {int(h): int(c) for _, h, c in zip(*k2_treap.term_counts(data, bounds))}
    assert cut == whole and sum(cut.values()) == 4000


def test_tree_holds_cells_and_maxima():
    rng = np.random.default_rng(5)
    for rows, cols, cells in ((1, 1, 1), (5, 9, 20), (300, 40, 900)):
        at = rng.permutation(rows * cols)[:cells]
        row, col, tf, m = at // cols, at % cols, rng.integers(1, 30, cells), rng.integers(50, 90, cols)
        tree = k2_treap.open_tree(*k2_treap.pack_tree(row, col, tf, m), m)
        value = dict(zip(zip(row.tolist(), col.tolist()), k2_treap.impact(tf, m[col]).tolist()))
        for r in range(rows):
            for c in range(cols):
                node = np.zeros(1, np.int64)
                for level in range(tree.depth):
                    side = 1 << (tree.depth - level)
                    inside = [v for (x, y), v in value.items() if x // side == r // side and y // side == c // side]
                    assert (max(inside) <= k2_treap.UNIT * int(tree.maxima[node[0]]) < max(inside) + k2_treap.UNIT) if inside else node[0] < 0
                    half = tree.depth - 1 - level
                    node = tree.child(node, np.array([2 * (r >> half & 1) + (c >> half & 1)]))
                    if node[0] < 0:
                        break
                held = node[0] >= 0
                assert held == ((r, c) in value)
                if held:
                    assert k2_treap.impact(tree.tf[node[0] - len(tree.maxima)], m[c]) == value[r, c]


def test_term_signs():
    text = "".join(map(chr, range(256))) + " ABCxyz09 Éé 中文"
    hashes, first = k2_treap.term_hashes(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert len(hashes) == len(_terms(text)) == first[1]
    assert pa.array(hashes).unique() is not None
