"""Routing for repeated windows: which places of the corpus must be compared.

A window is ``width`` consecutive symbols (words or bytes) of one document.
Every window picks an anchor inside it, the ``gram``-symbol piece of the
smallest hash (the rightmost on ties), so equal windows pick equal anchors at
equal places.  Windows whose anchor hash occurs once in the corpus occur once.
The others are cut out, one segment per anchor, covering just the windows that
picked it: each window of the corpus lies in one segment, and equal windows
lie in segments of the same anchor.  An index over whole anchor groups sees
every pair of equal windows, whatever the number of indexes.

Equal segments collapse to one text with its number of copies before they
travel.  An anchor picked by more than ``HOT`` distinct segments is refined
until its parts fit: its windows are halved by the anchor's place in them, and
each half is keyed by the anchor with the symbols next to it that all windows
of the half hold.  Equal windows fall in the same half and share those symbols,
so they stay together; the index takes the parts like other groups.  After
as many halvings as the width has binary digits a part is one window.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import byte_rows, stored, with_row_id

#: Distinct segments of one group that an index may gather: with twice the width
#: each, some MB of text and about a hundred bytes of index per byte of it.
HOT = 5000
#: Bytes handled at once, at some hundred bytes of room for each; also keeps places within 24 bits.
PIECE = 1 << 19
#: Bytes of distinct segments put into one index, but for a last whole anchor group.
SHARD = 1_000_000

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and their inverses, at least ``n`` of each."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _ODD[which]
        ups = np.full(size, base, np.uint64)
        downs = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        ups[0] = downs[0] = 1
        have = _POWERS[which] = (np.multiply.accumulate(ups), np.multiply.accumulate(downs))
    return have


def prefix_hash(symbols: np.ndarray, which: int = 0) -> np.ndarray:
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * powers(len(symbols) + 1, which)[0][:len(symbols)], out=out[1:])
    return out


def gram_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the pieces ``[start, end)`` from their prefix sums."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix), which)[1][starts] + (ends - starts).astype(np.uint64))


def byte_symbols(data: np.ndarray, _offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A symbol per byte; documents' bounds in symbols."""
    return mix(np.arange(1, 257, dtype=np.uint64))[data], _offsets


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each document's first word (one bound more than documents)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~space
    begins = inside[:-1].copy()
    begins[1:] &= space[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    begins[cut] |= ~space[cut]  # a document's first byte starts a word
    starts = np.flatnonzero(begins)
    stop = ~inside[1:]  # the next byte is no word byte
    stop[:-1] |= begins[1:]
    ends = np.flatnonzero(stop & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_bounds(data, offsets)
    return gram_hash(prefix_hash(byte_symbols(data, offsets)[0]), starts, ends), first


def pick_anchors(symbols: np.ndarray, bounds: np.ndarray, width: int, gram: int):
    """``(document, first window, windows, anchor hash)`` arrays; window starts count from the document's start."""
    n = len(symbols)
    empty = np.zeros(0, np.int64)
    if n < width:
        return empty, empty, empty, np.zeros(0, np.uint64)
    at = np.arange(n - gram + 1)
    hashes = gram_hash(prefix_hash(symbols), at, at + gram)
    low = np.uint64(0xFFFFFF)
    best = (hashes & ~low) | (low - at.astype(np.uint64))
    span, reach = width - gram + 1, 1
    while reach < span:  # doubling: minima over runs of `reach`
        step = min(reach, span - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    starts = np.repeat(bounds[:-1], np.maximum(np.diff(bounds) - width + 1, 0))
    counts = np.maximum(np.diff(bounds) - width + 1, 0)
    if not len(starts):
        return empty, empty, empty, np.zeros(0, np.uint64)
    begun = np.cumsum(counts) - counts
    inside = np.arange(len(starts)) - np.repeat(begun, counts)
    place = starts + inside
    anchor = (low - (best[place] & low)).astype(np.int64)
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] == 0)
    head = np.flatnonzero(fresh)
    doc = np.repeat(np.arange(len(counts)), counts)[head]
    return doc, inside[head], np.diff(np.append(head, len(anchor))), hashes[anchor[head]]


def pieces(column: pa.Array, width: int, symbols: Callable):
    """``(rows, symbols, bounds, skipped)`` pieces of whole rows; a longer row comes in pieces that overlap by a window less one."""
    for i, j, data, offsets in byte_rows(column, PIECE):
        if j - i > 1 or len(data) <= 2 * PIECE:
            s, bounds = symbols(data, offsets)
            yield np.arange(i, j), s, bounds, 0
        else:
            s, bounds = symbols(data, offsets)
            for k in range(0, max(len(s) - width + 1, 1), PIECE):
                part = s[k:k + PIECE + width - 1]
                yield np.arange(i, i + 1), part, np.array([0, len(part)]), k


def anchor_rows(docs: DataFrame, width: int, gram: int, symbols: Callable) -> DataFrame:
    """``_anchor, _rid, _first, _windows`` of every anchor of ``docs (_rid, _text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rid = b.column("_rid").to_numpy(zero_copy_only=False)
            for rows, s, bounds, skipped in pieces(b.column("_text"), width, symbols):
                doc, first, windows, anchor = pick_anchors(s, bounds, width, gram)
                if len(doc):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(rid[rows[doc]]), pa.array((first + skipped).astype(np.int32)), pa.array(windows.astype(np.int32))],
                        ["_anchor", "_rid", "_first", "_windows"])

    return docs.mapInArrow(run, "_anchor long, _rid long, _first int, _windows int")


def squeezed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` as zstd bytes (null: empty), for shuffles that carry whole texts."""
    types = dict(docs.dtypes)
    at = docs.columns.index("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = b.column("_text").cast(pa.large_binary()).to_pylist()
            yield b.set_column(at, "_text", pa.array([squeeze(t or b"") for t in texts], pa.binary()))

    return docs.mapInArrow(run, ", ".join(f"{c} {'binary' if c == '_text' else types[c]}" for c in docs.columns))


def halved(rows: DataFrame, width: int, gram: int, symbols: Callable, cut: Callable) -> DataFrame:
    """Splits segments by the anchor's place in their windows.

    All windows of a row hold ``_left`` symbols before the anchor and ``_right``
    after it; each of its two halves holds more of one side, and its
    ``_group`` is the hash of the anchor with those symbols.
    """
    room = width - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.to_pylist():
                data = np.frombuffer(x["_segment"], np.uint8)
                s, _ = symbols(data, np.array([0, len(data)]))
                prefix, second = prefix_hash(s), prefix_hash(s, 1)
                at = np.arange(room + 1)
                anchor = int(np.flatnonzero(gram_hash(prefix, at, at + gram) == np.uint64(x["_anchor"] % (1 << 64)))[-1])  # the rightmost in the first window
                left, right = x["_left"], x["_right"]
                middle = (left + room - right + 1) // 2
                parted = min(max(anchor - middle + 1, 0), x["_windows"])  # windows before this one hold `middle` symbols before the anchor
                for first, last, l, r in ((0, parted, middle, right), (parted, x["_windows"], left, room - middle + 1)):
                    if first < last:
                        group = gram_hash(second, np.array([anchor - l]), np.array([anchor + gram + r]), 1)
                        group = int((mix(group ^ np.uint64(l << 32 | r))).view(np.int64)[0])
                        text = next(iter(cut(x["_segment"], np.array([first]), np.array([last - first]))))
                        out.append(x | {"_group": group, "_left": l, "_right": r, "_offset": x["_offset"] + first, "_windows": last - first,
                                        "_segment": text, "_key": hashlib.blake2b(text, digest_size=16).digest()})
            yield pa.RecordBatch.from_pylist(out, schema=b.schema)

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in rows.dtypes))


def crowds(rows: DataFrame, name: str) -> DataFrame:
    """``_group`` of the groups of over ``HOT`` distinct segments, stored."""
    return stored(rows.select("_group", "_key").distinct().groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > HOT).drop("_n"), name)


def refined(rows: DataFrame, width: int, gram: int, symbols: Callable, cut: Callable, name: str) -> DataFrame:
    """Segments whose groups are crowded, halved until none is; parts of a group of one segment without copies are left out."""
    done = None
    while True:
        parts = stored(halved(rows, width, gram, symbols, cut), f"{name}-parts")
        several = stored(parts.groupBy("_group").agg(F.sum("_copies").alias("_n")).where("_n > 1").drop("_n"), f"{name}-several")
        parts = parts.join(several, "_group", "left_semi")
        full = crowds(parts.where(F.col("_left") + F.col("_right") < width - gram), f"{name}-crowds")
        fit = parts.join(full, "_group", "left_anti")
        done = fit if done is None else done.unionByName(fit)
        if not full.count():
            return done
        rows = parts.join(full, "_group", "left_semi")


def repeated_places(docs: DataFrame, width: int, gram: int, symbols: Callable, cut: Callable, index: Callable, name: str) -> tuple[DataFrame, DataFrame]:
    """``(docs, places)``: the documents with ``_rid``, and ``_rid, _first, _runs``: from ``_first`` on, runs of window starts whose window occurs elsewhere.

    ``cut(text, firsts, counts)`` yields a segment's bytes for every run of windows;
    ``index(segments)`` maps a list of (bytes, windows, copies) to a list of boolean arrays.
    """
    docs = with_row_id(docs)
    thin = docs.select("_rid", "_text")
    anchors = anchor_rows(thin, width, gram, symbols)
    # stored, so that the join below is of two plain shuffles and a hot anchor's partition can be split
    often = stored(anchors.groupBy("_anchor").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), f"{name}-often")
    chosen = anchors.join(often, "_anchor").groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct("_first", "_windows", "_anchor"))).alias("_picks"))
    with_text = squeezed(thin).join(chosen, "_rid")  # a document's own anchors: as long as its text at most

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rids = b.column("_rid").to_numpy(zero_copy_only=False)
            texts, lists = b.column("_text"), b.column("_picks")
            picks = lists.flatten()
            ends = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False)))
            first, windows = (picks.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            expand = zstandard.ZstdDecompressor().decompress
            lo = 0
            while lo < len(rids):  # some documents at a time
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + 4000, side="right")) - 1)
                found = [seg for r in range(lo, hi) for seg in cut(expand(texts[r].as_py()), first[ends[r]:ends[r + 1]], windows[ends[r]:ends[r + 1]])]
                at = slice(int(ends[lo]), int(ends[hi]))
                keys = [hashlib.blake2b(x, digest_size=16).digest() for x in found]
                yield pa.RecordBatch.from_arrays(
                    [picks.field(2)[at], pa.array(np.repeat(rids[lo:hi], np.diff(ends[lo:hi + 1]))), pa.array(first[at]), pa.array(windows[at]), pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                    ["_anchor", "_rid", "_first", "_windows", "_key", "_segment"])
                lo = hi

    segments = stored(with_text.mapInArrow(cut_out, "_anchor long, _rid long, _first int, _windows int, _key binary, _segment binary"), name)
    grouped = segments.withColumnRenamed("_anchor", "_group")
    full = crowds(grouped, f"{name}-crowds")
    texts = grouped.groupBy("_group", "_key", "_segment").agg(F.max("_windows").alias("_windows"), F.count("*").alias("_copies"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Gathers whole groups up to ``SHARD`` bytes of segments per index; a row per segment with hits.

        A group that is one text needs no index: its windows differ from each
        other (they would pick different anchors), so they repeat if the text
        has copies.
        """
        held: list = []
        size, last = 0, None

        def answer():
            of = Counter(x[0] for x in held)
            many = [x for x in held if of[x[0]] > 1]
            hits = index([(x[2], x[3], x[4]) for x in many]) if many else []
            alone = [x for x in held if of[x[0]] == 1 and x[4] > 1]
            out = []
            for x, hit in zip(many + alone, [*hits, *(np.ones(x[3], bool) for x in alone)]):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                if len(edge):
                    out.append((x[0], x[1], [{"_offset": int(a), "_count": int(e - a)} for a, e in zip(edge[::2], edge[1::2])]))
            columns = list(zip(*out)) or [(), (), ()]
            run = pa.list_(pa.struct([("_offset", pa.int32()), ("_count", pa.int32())]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), run))], ["_group", "_key", "_runs"])

        for b in batches:
            for x in zip(*(b.column(c).to_pylist() for c in ("_group", "_key", "_segment", "_windows", "_copies"))):
                if x[0] != last and size >= SHARD:
                    yield answer()
                    held, size = [], 0
                last = x[0]
                held.append(x)
                size += len(x[2])
        if held:
            yield answer()

    def searched(rows: DataFrame) -> DataFrame:
        spread = rows.select("_group", "_key", "_segment", "_windows", "_copies").repartition("_group").sortWithinPartitions("_group", "_key")
        return spread.mapInArrow(search, "_group long, _key binary, _runs array<struct<_offset: int, _count: int>>")

    if not full.count():
        hits = searched(texts)
    else:
        hits = searched(texts.join(full, "_group", "left_anti"))
        crowded = texts.join(full, "_group", "left_semi").withColumns(
            {"_anchor": F.col("_group"), "_own": F.col("_key"), "_offset": F.lit(0), "_left": F.lit(0), "_right": F.lit(0)})
        parts = refined(crowded, width, gram, symbols, cut, name)
        of_parts = stored(searched(parts.groupBy("_group", "_key", "_segment").agg(F.max("_windows").alias("_windows"), F.sum("_copies").alias("_copies"))), f"{name}-part-hits")
        moved = F.transform("_runs", lambda r: F.struct((r["_offset"] + F.col("_offset")).alias("_offset"), r["_count"].alias("_count")))
        own = parts.select("_group", "_key", "_anchor", "_own", "_offset").join(of_parts, ["_group", "_key"]).select("_anchor", "_own", moved.alias("_runs"))
        own = own.groupBy("_anchor", "_own").agg(F.flatten(F.collect_list("_runs")).alias("_runs"))
        hits = hits.unionByName(own.select(F.col("_anchor").alias("_group"), F.col("_own").alias("_key"), "_runs"))
    hits = stored(hits, f"{name}-hits")
    members = segments.select(F.col("_anchor").alias("_group"), "_key", "_rid", "_first")
    return docs, members.join(hits, ["_group", "_key"]).select("_rid", "_first", "_runs")


__all__ = ["HOT", "SHARD", "byte_symbols", "word_symbols", "word_bounds", "pick_anchors", "anchor_rows", "halved", "crowds", "refined", "repeated_places", "squeezed", "mix", "prefix_hash", "gram_hash", "powers"]
