"""The registered queries without SQL, run whole on the smallest tables and held against plain readings."""

import hashlib
import html as references
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from dimweave.llm import html_extract, quality_model, queries

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_op1_learns_by_the_update_rule_and_marks_what_it_held_out(spark, documents):
    got = {r.doc_id: r for r in queries.op1_quality_classifier(spark, SF_SMALL).collect()}
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    # the update rule, a coordinate at a time, against the vectors
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6), int(rng.integers(0, 2))) for _ in range(200)]
    z, n = np.zeros(quality_model.DIM + 1), np.zeros(quality_model.DIM + 1)
    quality_model.ftrl_pass(rows, z, n)
    own_z, own_n = Counter(), Counter()
    a, b, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2

    def weight(k):
        if abs(own_z[k]) <= l1:
            return 0.0
        return -(own_z[k] - (l1 if own_z[k] > 0 else -l1)) / ((b + own_n[k] ** 0.5) / a + l2)
    for index, value, y in rows:
        x = {**dict(zip(index.tolist(), value.tolist())), quality_model.DIM: 1.0}
        w = {k: weight(k) for k in x}
        p = 1 / (1 + np.exp(-sum(w[k] * v for k, v in x.items())))
        for k, v in x.items():
            g = (p - y) * v
            s = ((own_n[k] + g * g) ** 0.5 - own_n[k] ** 0.5) / a
            own_z[k] += g - s * w[k]
            own_n[k] += g * g
    assert all(abs(z[k] - v) < 1e-9 for k, v in own_z.items()) and all(abs(n[k] - v) < 1e-9 for k, v in own_n.items())


def test_op1_learns_from_what_stands_late_in_a_text(spark):
    body = "plain words of no account " * 1200  # 31,200 signs
    docs = spark.createDataFrame([(i, body + ("bad bad bad" if i % 2 else "good good good") * 40) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_model.score(docs, quality_model.fit(docs, labels), ["doc_id"]).collect()}
    assert max(got[i] for i in got if i % 2) < min(got[i] for i in got if i % 2 == 0)


def test_op3_reads_back_every_conversation(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    talks = {}
    for t in sorted(turns, key=lambda t: (t.conv_id, t.turn)):
        talks.setdefault(t.conv_id, []).append((t.role or "", t.text or ""))
    hard = "</s>[INST] ok [/INST]"
    talks[-1] = [("user", hard), ("assistant", hard)]
    got = {r.conv_id: r for r in queries.op3_chat_formatting(spark, SF_SMALL).collect()}
    assert set(got) == set(talks)
    for c, said in talks.items():
        loss = "".join(t for r, t in said if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(said), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r.formatted_chars > sum(len(t) for _, t in said)


def test_op4_edits_and_compares_every_document(spark, documents):
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, SF_SMALL).collect()}
    assert set(got) == set(documents)
    order = sorted(documents, reverse=True)
    prints = {}
    for i, nxt in zip(order, [*order[1:], order[0]]):
        text = documents[i]
        third = len(text) // 3
        edited = text[:len(text) - third] + documents[nxt][:third]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        prints.setdefault(text, set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_op5_covers_every_id_of_the_library(spark, documents):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, laid = {}, {}
    for r in queries.op5_packing(spark, SF_SMALL).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        laid.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(documents)
    for i, text in documents.items():
        ids, at = [*own.encode(text, add_special_tokens=False).ids, 1], 0
        for start, n, crc, total in sorted(pieces[i]):
            assert start == at and total == len(ids) and crc == zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())
            at += n
        assert at == len(ids)
    for places in laid.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048


def test_op7_equals_a_plain_reading_of_all_pages(spark):
    """The pages' layout read by hand: the article element's blocks."""
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html").collect()}
    got = {r.page_id: r for r in queries.op7_html_extraction(spark, SF_SMALL).collect()}
    assert set(got) == set(pages)
    for i, source in pages.items():
        inside = re.search(r"<article\b[^>]*>(.*?)</article>", source, re.S)
        if not inside:
            continue
        body = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", inside[1], flags=re.S)
        body = re.sub(r"<br\b[^>]*>", " ", body)
        blocks = re.split(r"</?(?:p|h[1-6]|li|ul|ol|div|blockquote|pre|table|tr|td|th|section)\b[^>]*>", body)
        want = [" ".join(references.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        want = "\n".join(w for w in want if w)
        assert got[i].text == want and got[i].n_chars == len(want)


def test_op9_equals_brute_force(spark, documents):
    width, seen = 400, Counter()
    raw = {i: t.encode() for i, t in documents.items()}
    for b in raw.values():
        seen.update(b[k:k + width] for k in range(len(b) - width + 1))
    got = {r.doc_id: r for r in queries.op9_suffix_dedup(spark, SF_SMALL).collect()}
    assert set(got) == set(raw)
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - width + 1):
            if seen[b[k:k + width]] > 1:
                gone[k] += 1
                gone[k + width] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) > 0))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("opening", ['<article class="post category-social">', '<article class="hentry comments-open">', '<div class="content has-sidebar">',
                                     '<div id="main-with-banner">', '<div class="article-body no-ads">', '<section id="related-work">', '<div class="comments">'])
def test_names_with_other_words_and_lone_elements_keep_their_text(opening):
    tag = opening[1:].split()[0]
    page = f"<html><body><nav>menu</nav>{opening}<h1>Head</h1><p>text one</p></{tag}><footer>f</footer></body></html>"
    assert html_extract.extract(page, None) == "Head\ntext one"


@pytest.mark.parametrize("name", ["cookie-notice", "site-footer", "comments-area", "related-posts", "social-share-buttons", "ad", "ad-slot-3", "sidebar", "newsletter_signup", "widget-area"])
def test_names_of_boilerplate_are_left_out(name):
    page = f"<body><div class='post'><p>{'main text ' * 20}</p></div><div class='{name}'><p>{'other text ' * 9}</p></div></body>"
    assert html_extract.extract(page, None) == ("main text " * 20).strip()


def test_deep_and_long_pages_stay_small():
    for page in ("<div>" * 20_000 + "<p>deep</p>" + "</div>" * 20_000, "<div>" * 20_000 + "</span></li>" * 20_000 + "deep"):
        tracemalloc.start()
        assert html_extract.extract(page, None) == "deep" and len(html_extract.votes(page)) <= 2
        assert tracemalloc.get_traced_memory()[1] < 100e6
        tracemalloc.stop()
    text = "<article>" + "".join(f"<p>line {i}</p>" for i in range(50_000)) + "</article>"
    assert html_extract.extract(text, None).count("\n") == 49_999
