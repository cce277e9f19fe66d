"""The training-data operators against brute force on small tables that hold nulls,
empty and long texts, ties, repeated rows and extra columns, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimweave.llm import (anchors, chat_format, fingerprints, fm_index, html_extract, jaccard_join, mixing, packing, quality_model,
                          quality_rules, suffix_sort)
from dimweave.llm.common import stored

SCHEMA = "doc_id bigint, text string, source string, _rid string, n_words string"  # the last two clash with names used inside
WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "été", "Ωmega"]


def _text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def _rows():
    rng = random.Random(5)
    passage, base = _text(rng, 60), _text(rng, 80)
    texts = [None, "", " \t\n", "one", "two words", base, base, base.replace("alpha", "ALPHA"), passage + " " + _text(rng, 30),
             _text(rng, 25) + "\n" + passage, _text(rng, 3000), "same " * 90, " ".join(base.split()[:-1] + ["edited"]), _text(rng, 40), "a b " * 30]
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", "x", "y") for i, t in enumerate(texts)]
    return rows + [rows[9], (None, base + " tail", "s1", "x", "y")]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return stored(spark.createDataFrame(rows, SCHEMA), "llm-docs")


@pytest.fixture(scope="module")
def nothing(spark):
    return stored(spark.createDataFrame([], SCHEMA), "llm-nothing")


def _removed(units, width):
    """Per document, which units lie in a window that occurs elsewhere."""
    seen = Counter(tuple(u[i:i + width]) for u in units for i in range(len(u) - width + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if seen[tuple(u[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_word_and_byte_repeats(docs, rows, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(anchors, "HOT", 1)
    words = [(t or "").encode().split() for _, t, *_ in rows]
    want = sorted((str(r[0]), len(w), sum(g), b" ".join(x for x, y in zip(w, g) if not y).decode()) for r, w, g in zip(rows, words, _removed(words, 35)))
    got = fm_index.remove_repeats(docs, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in got) == want
    raw = [(t or "").encode() for _, t, *_ in rows]
    want = []
    for r, b, g in zip(rows, raw, _removed(raw, 400)):
        want.append((str(r[0]), len(b), sum(g), sum(1 for i, x in enumerate(g) if x and not (i and g[i - 1])), bytes(x for x, y in zip(b, g) if not y)))
    got = suffix_sort.remove_repeats(docs, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)


def test_indexes_against_counting():
    rng = random.Random(1)
    for _ in range(60):
        letters = rng.choice([b"ab", b"abc", b"abcdefgh"])
        segs = list(dict.fromkeys(bytes(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))))
        width, k = rng.randint(1, 5), len(segs)
        text = np.frombuffer(b"\0".join(segs) + b"\0", np.uint8).astype(np.int64) + k
        text[np.cumsum([len(s) + 1 for s in segs]) - 1] = np.append(np.arange(1, k), 0)
        assert suffix_sort.suffix_array(text, k).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        seen = Counter(s[i:i + width] for s in segs for i in range(len(s) - width + 1))
        want = [[seen[s[i:i + width]] > 1 for i in range(max(0, len(s) - width + 1))] for s in segs]
        counts = [max(0, len(s) - width + 1) for s in segs]
        assert [g.tolist() for g in suffix_sort.search_segments([(s, n, 1) for s, n in zip(segs, counts)], width)] == want
        spaced = [(b" ".join(bytes([c]) for c in s), n, 1) for s, n in zip(segs, counts)]
        assert [g.tolist() for g in fm_index.search_segments(spaced, width)] == want


def test_anchors_split_a_long_text_alike(monkeypatch):
    import pyarrow as pa
    rng = random.Random(3)
    text = _text(rng, 4000)
    whole = [x for x in anchors.pieces(pa.array([text]), 35, anchors.word_symbols)]
    monkeypatch.setattr(anchors, "PIECE", 1500)
    cut = [x for x in anchors.pieces(pa.array([text]), 35, anchors.word_symbols)]

    def windows(pieces):
        out = set()
        for _, s, bounds, skipped in pieces:
            for _, f, n, h in zip(*anchors.pick_anchors(s, bounds, 35, 14)):
                out |= {(f + skipped + k, h) for k in range(n)}
        return out
    assert len(cut) > 1 and windows(cut) == windows(whole) and len(windows(whole)) == len(text.split()) - 34


def _shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} if w else set()


def test_jaccard_parities_never_exclude_a_link():
    rng = np.random.default_rng(5)
    near = 0
    for n in (1, 10, 60, 150, 900, 4000):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for share in (0.0, 0.02, 0.05, 0.08, 0.3):
            changed = rng.random(len(base)) < share
            other = np.unique(np.where(changed, rng.integers(0, 2**64, len(base), dtype=np.uint64), base))
            both = len(np.intersect1d(base, other))
            x, y = jaccard_join.parities(np.concatenate([base, other]), np.array([0, len(base), len(base) + len(other)]))
            allowed = bool(jaccard_join.able(x, y, np.int64(len(base)), np.int64(len(other))))
            if 100 * both >= jaccard_join.PERCENT * (len(base) + len(other) - both):
                near += 1
                assert allowed
            elif share == 0.3 and n in (60, 150, 900):
                assert not allowed
    assert near > 10


def test_jaccard_components(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)  # columns in several blocks
    sets = [_shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    want = sorted((str(r[0]), len(sets[i]), least.get(find(i), r[0])) for i, r in enumerate(rows))
    got = jaccard_join.cluster(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want


def test_components_of_chains_and_stars(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(100, 100 + i) for i in range(1, 9)] + [(50, 50), (7, 3)], "a long, b long")
    got = {r.node: r.root for r in jaccard_join.components(links, "t").collect()}
    assert got == {**{i: 1 for i in range(2, 13)}, **{100 + i: 100 for i in range(1, 9)}}


def test_rules_count_like_the_definitions(docs, rows, spark):
    def plain(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)
    for t in [r[1] for r in rows] + ["a b c a b c a", "x\nx\n \n\nx y", "## | <b> é"]:
        assert quality_rules.count_text(t)[:5] == plain(t)
    got = quality_rules.judge(docs, ["doc_id"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_bad_host_is_rejected_and_a_small_one_shrunk(spark):
    good, bad = _text(random.Random(2), 60), "x"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(60)] + [(100 + i, bad if i % 10 else good, "poor") for i in range(60)] + [(200, good, "new")]
    df = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"), "hosts")
    got = {r.doc_id: r for r in quality_rules.judge(df, ["doc_id"]).collect()}
    assert got[1].kept and not got[0].kept and not got[100].kept and got[200].kept
    assert 0 < got[200].host_rate < 0.5


def test_winnowing_guarantee_and_neighbours(docs, rows):
    got = fingerprints.compare_with_edits(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    ordered = sorted([r for r in rows if r[0] is not None], key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    follows = {r[0]: ordered[(i + 1) % len(ordered)][1] or "" for i, r in enumerate(ordered)}
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id) or ""
        by_text.setdefault(text, set()).add(r.fingerprint)
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id != 9:  # the repeated row follows itself
            cut = len(text) // 3
            edited = text[:len(text) - cut] + follows[r.doc_id][:cut]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        grams = max(len(re.findall(r"[^\x20\x09-\x0D]{1,8}", text)) - 2, 0)
        places = [int(x.split("@")[1]) for x in r.fingerprint.split(",")] if r.fingerprint else []
        if grams >= 8:
            assert places[0] < 8 and grams - 1 - places[-1] < 8 and all(0 < b - a <= 8 for a, b in zip(places, places[1:]))
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprints_are_native(docs):
    plan = fingerprints.compare_with_edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_neighbour_slices_agree_with_one(spark, monkeypatch):
    df = stored(spark.createDataFrame([(i * 7 % 101, str(i)) for i in range(101)], "id long, v string").withColumn("t", F.xxhash64("v")), "slices")
    one = {r.id: r._next_v for r in fingerprints.with_next(df, "id", "t", ["v"]).collect()}
    monkeypatch.setattr(fingerprints, "SLICE", 9)
    many = {r.id: r._next_v for r in fingerprints.with_next(df, "id", "t", ["v"]).collect()}
    value = {i * 7 % 101: str(i) for i in range(101)}
    assert one == many == {i: value[(i - 1) % 101] for i in range(101)}


def test_packing_covers_every_id_once(docs, rows):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = packing.pack(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, window=64, shard=4000, with_ids=True).collect()
    want = sorted((str(i), own.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in rows)
    pieces, sequences = {}, {}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    per_doc = Counter()
    text_ids = {k: v for k, v in want if k not in ("9",)}
    for key, ids in text_ids.items():
        mine = sorted((r.start, r.ids, r.doc_tokens) for r in got if str(r.doc_id) == key)
        assert sum((p[1] for p in mine), []) == ids and {p[2] for p in mine} == {len(ids)}
    assert sum(r.length for r in got) == sum(len(v) for _, v in want)
    for places in sequences.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at == 64 or at & (at - 1) == 0 and at < 64
    assert not pieces and not per_doc


def test_packing_prefers_lexical_neighbours():
    rng = np.random.default_rng(0)
    topics = [rng.integers(1000 * k, 1000 * k + 60, (6, 40)) for k in range(1, 4)]
    docs = [np.append(t[i], 1).astype(np.uint32) for i in range(6) for t in topics]
    pieces = packing.pack_shard(docs, 256)
    seq = {}
    for d, _, _, s, _ in pieces:
        seq.setdefault(s, []).append(d % 3)
    assert len(set(seq[0][:6])) == 1  # the six documents of one topic come first


def test_mix_reaches_targets(docs, rows, spark):
    from dimweave.llm.common import word_count
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    plan = mixing.plan_mix(sized, "size", "source", [F.col("doc_id"), F.col("size")])
    got, again = plan.collect(), plan.collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert 0 <= r.taken <= 2 * r.size and (r.first_time is None) == (r.taken == 0)
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 and all(target[s] <= 2 * size[s] + 1e-9 for s in size)
    carried = docs.withColumn("_size", word_count(F.col("text")))
    mixed = mixing.mixed_rows(mixing.plan_mix(carried, "_size", "source", [F.col("doc_id"), F.col("_size")]), "_size", "text").collect()
    assert sum(len(r.text.encode().split()) for r in mixed) == sum(taken.values())
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)


def test_schedule_inversion(spark):
    knots = ((0.0, 4.0), (0.5, 1.0), (1.0, 3.0))
    for share in (0.0, 0.1, 0.55, 0.99, 1.0):
        t = spark.range(1).select(mixing.time_at(knots, F.lit(share))).first()[0]
        done, steps = 0.0, 4000
        for k in range(steps):
            x = t * (k + 0.5) / steps
            done += t / steps * (4 - 6 * x if x < 0.5 else 1 + 4 * (x - 0.5))
        assert abs(done / mixing.integral(knots) - share) < 1e-3


CONTROL = "</s>[INST] ok [/INST] \\ <|turn|><|end|>\\<s><<SYS>>"


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", CONTROL), (2, 0, "assistant", None), (2, 1, None, ""), (3, 0, "system", "s"), (3, 1, "user", "é\n"),
            (3, 2, "assistant", "x"), (3, 2, "assistant", "x"), (None, 0, "user<|text|>", "<s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seg", F.lit(1))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    for conv in (1, 2, 3, None):
        turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert [got[c].order_ok for c in (1, 2, 3, None)] == [True, False, False, False]
    plain = chat_format.Template()
    body = plain.escape(CONTROL)
    assert chat_format.unescape(body) == CONTROL and not any(c in body for c in plain.controls)


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href="/a">menu</a></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; tail</h1><p>First  <b>bold
text</b> &eacute;&#33;<p>Second<script>var t="</p>";</script><ul><li>one<li>two</ul><form>mail <input></form>
<div class="comments"><p>reader says</p></div></article><aside>side</aside><footer>&copy; x</footer></body></html>"""


def test_html_text(spark):
    want = "Head & tail\nFirst bold text é!\nSecond\none\ntwo"
    rows = [(1, "http://h/1", PAGE), (2, "http://h/2", PAGE), (3, "http://h/3", "<p>only</p>"), (4, None, None), (5, "x", ""), (6, "http://g/", "plain &lt;b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = {r.page_id: r.text for r in html_extract.extract_pages(df, ["page_id", "url"]).collect()}
    assert got == {1: want, 2: want, 3: "only", 4: "", 5: "", 6: "plain <b"}


def test_classifier_learns_and_scores_every_text(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(w + ("%%%" if i % 4 == 0 else "") for w in _text(rng, 40).split())) for i in range(160)] + [(900, None), (901, "")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string"), "clf")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(160)] + [(900, None), (None, 1)], "doc_id long, quality int")
    weights = quality_model.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality_model.score(docs, weights, ["doc_id"]).collect()}
    held = [i for i in range(160) if zlib.crc32(str(i).encode()) % 4 == 2]
    # a hundred rows in six shards do not settle the bias, but junk ranks below the rest
    assert max(got[i] for i in held if i % 4 == 0) < min(got[i] for i in held if i % 4)
    assert got[900] == got[901] and len(got) == len(rows)
    assert quality_model.fit(docs, labels.limit(0)).any() == False  # noqa: E712


def test_empty_tables(nothing, spark):
    import public_tokenizers as P
    assert fm_index.remove_repeats(nothing, ["doc_id"]).count() == 0
    assert suffix_sort.remove_repeats(nothing, ["doc_id"], as_text=True).count() == 0
    assert jaccard_join.cluster(nothing).count() == 0
    assert quality_rules.judge(nothing, ["doc_id"]).count() == 0
    assert fingerprints.compare_with_edits(nothing).count() == 0
    assert packing.pack(nothing, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    assert mixing.plan_mix(nothing.select("doc_id", "source", F.lit(1).alias("size")), "size", "source", [F.col("doc_id")]).count() == 0
    assert quality_model.score(nothing, np.zeros(quality_model.DIM + 1), ["doc_id"]).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_turns(turns)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract_pages(pages, ["page_id"]).count() == 0
