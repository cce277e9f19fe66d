"""Substring de-duplication over bytes with suffix arrays built by induced sorting.

Windows are routed by their anchors (``anchors.py``).  A shard concatenates its
distinct segments, each closed by a separator of its own, and sorts all
suffixes by induced sorting: suffixes are classified, the leftmost-smaller
(LMS) substrings are sorted by a first induction, named, their string is sorted
recursively, and the array is induced from them in linear time.  Permuted
common prefixes then tell which windows share their whole width with a
neighbour in the array.

The first level works on a whole bucket at a time, the recursion, whose
alphabet is large, on blocks of buckets (numpy in the tasks).  LMS substrings
are told apart by 64-bit hashes.

Defined results: a null text is empty; removed bytes are taken from the UTF-8
form, so what is left of a text may cut a code point (``kept`` is binary);
repeated rows are repeats of each other; windows never cross documents; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .anchors import byte_symbols, gram_hash, prefix_hash, repeated_places, squeezed

WIDTH = 400
#: Hundredths of a window that an anchor covers.
GRAM = 40
#: Suffixes of a block in the recursion's induction.
BLOCK = 4096


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last counts as smaller."""
    n = len(text)
    change = np.empty(n, np.int8)
    change[:-1] = np.sign(text[1:] - text[:-1])
    change[-1] = 1
    at = np.where(change != 0, np.arange(n), n - 1)
    return change[np.minimum.accumulate(at[::-1])[::-1]] > 0


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, seps: int, bounds: np.ndarray) -> np.ndarray:
    """All suffixes' order from the order of the LMS suffixes, a bucket at a time.

    The first ``seps`` symbols occur once each.  ``bounds`` are the buckets' starts.
    """
    sa = np.full(len(text), -1, np.int64)
    sigma = len(bounds) - 1
    start, end = bounds[:-1], bounds[1:]
    symbols = text[lms]
    order = np.argsort(symbols, kind="stable")
    held = np.bincount(symbols, minlength=sigma)
    rank = np.arange(len(lms)) - np.repeat(np.cumsum(held) - held, held)
    grouped = lms[order]
    slots = symbols[order]
    sa[end[slots] - held[slots] + rank] = grouped
    begin = np.cumsum(held) - held
    fill = start.copy()

    def deal(found: np.ndarray, upward: bool) -> None:
        """Append to the buckets of the found suffixes, in the order found."""
        if not len(found):
            return
        to = text[found]
        by = np.argsort(to, kind="stable")
        to, found = to[by], found[by]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        size = np.diff(np.append(first, len(to)))
        offset = np.arange(len(to)) - np.repeat(first, size)
        bucket = to[first]
        if upward:
            sa[np.repeat(fill[bucket], size) + offset] = found
            fill[bucket] += size
        else:
            sa[np.repeat(fill[bucket], size) - 1 - offset] = found
            fill[bucket] -= size

    # larger suffixes, from the left
    first = sa[:seps] - 1
    deal(first[first >= 0], True)
    for c in range(seps, sigma):
        if start[c] == end[c]:
            continue
        done, others = start[c], []
        while done < fill[c]:
            before = sa[done:fill[c]] - 1
            done = fill[c]
            before = before[before >= 0]
            before = before[~smaller[before]]
            same = text[before] == c
            others.append(before[~same])
            own = before[same]
            sa[fill[c]:fill[c] + len(own)] = own
            fill[c] += len(own)
        before = grouped[begin[c]:begin[c] + held[c]] - 1
        others.append(before)
        deal(np.concatenate(others), True)
    # smaller suffixes, from the right
    larger = fill.copy()
    fill[:] = end
    for c in range(sigma - 1, seps - 1, -1):
        if start[c] == end[c]:
            continue
        done, others = end[c], []
        while done > fill[c]:
            before = sa[fill[c]:done][::-1] - 1
            done = fill[c]
            before = before[before >= 0]
            before = before[smaller[before]]
            to = text[before]
            others.append(before[(to != c) & (to >= seps)])
            own = before[to == c]
            sa[fill[c] - len(own):fill[c]] = own[::-1]
            fill[c] -= len(own)
        before = sa[start[c]:larger[c]][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before] & (text[before] >= seps)]
        others.append(before)
        deal(np.concatenate(others), False)
    return sa


def induce_blocks(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The same induction for a large alphabet, a block of neighbouring buckets at a time.

    Inside a bucket, suffixes of one type stand in the order of the suffixes
    that follow them.  A block is ordered by that until nothing moves, which
    takes as many rounds as its longest chain of followers within the block.
    """
    n = len(s)
    place = np.full(n + 1, n, np.int64)
    place[n] = -1
    size = np.bincount(s, minlength=sigma)
    end = np.cumsum(size)
    by_symbol = np.argsort(s, kind="stable")
    symbols = s[lms]
    held = np.bincount(symbols, minlength=sigma)
    order = np.argsort(symbols, kind="stable")
    slot = end[symbols[order]] - held[symbols[order]] + np.arange(len(lms)) - np.repeat(np.cumsum(held) - held, held)
    place[lms[order]] = slot

    def settle(of: np.ndarray, slots: np.ndarray, upward: bool) -> None:
        cuts = np.flatnonzero(np.diff(s[of])) + 1
        if len(cuts):
            cuts = cuts[np.concatenate([[True], cuts[1:] // BLOCK != cuts[:-1] // BLOCK])]
        edges = np.concatenate([[0], cuts, [len(of)]])
        blocks = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        for lo, hi in blocks if upward else reversed(blocks):
            group, to = of[lo:hi], slots[lo:hi]
            high = s[group] * (n + 2) + 1
            before = None
            while True:
                rank = np.argsort(high + place[group + 1])
                if before is not None and np.array_equal(rank, before):
                    break
                place[group[rank]] = to
                before = rank

    larger = by_symbol[~smaller[by_symbol]]
    if len(larger):
        many = np.bincount(s[larger], minlength=sigma)
        settle(larger, (end - size)[s[larger]] + np.arange(len(larger)) - np.repeat(np.cumsum(many) - many, many), True)
    rest = by_symbol[smaller[by_symbol]]
    place[rest] = -1
    many = np.bincount(s[rest], minlength=sigma)
    settle(rest, (end - many)[s[rest]] + np.arange(len(rest)) - np.repeat(np.cumsum(many) - many, many), False)
    sa = np.empty(n, np.int64)
    sa[place[:n]] = np.arange(n)
    return sa


def order_lms(s: np.ndarray, sa: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """LMS suffixes in order, given an induction that has sorted the LMS substrings."""
    n = len(s)
    place = np.full(n, -1, np.int64)
    place[lms] = np.arange(len(lms))
    ordered = sa[place[sa] >= 0]
    prefix = prefix_hash(s.astype(np.uint64) + np.uint64(1))
    until = np.append(lms[1:], n - 1)[place[ordered]] + 1
    piece = gram_hash(prefix, ordered, until)
    names = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    if names[-1] + 1 == len(lms):
        return ordered
    reduced = np.empty(len(lms), np.int64)
    reduced[place[ordered]] = names
    return lms[sort_recursively(reduced, int(names[-1]) + 1)]


def sort_recursively(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of a string of names that ends with its only 0."""
    if sigma == len(s):
        return np.argsort(s)
    smaller = smaller_types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        lms = order_lms(s, induce_blocks(s, smaller, lms, sigma), lms)
    return induce_blocks(s, smaller, lms, sigma)


def suffix_array(text: np.ndarray, seps: int) -> np.ndarray:
    """Suffix array of a text whose first ``seps`` symbols occur once each and that ends with symbol 0."""
    n = len(text)
    smaller = smaller_types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    bounds = np.concatenate([[0], np.cumsum(np.bincount(text))])
    if len(lms) > 1:
        lms = order_lms(text, induce(text, smaller, lms, seps, bounds), lms)
    return induce(text, smaller, lms, seps, bounds)


def permuted_prefixes(data: np.ndarray, room: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(plcp, phi)``: common prefix of every suffix with the one before it in the array.

    Only suffixes whose preceding symbols differ from their neighbour's are
    compared, eight bytes at a time; the others follow by subtraction.
    ``room`` is the distance to the separator.
    """
    n = len(sa)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    packed = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    packed = packed[:-1] | packed[1:] << np.uint64(8)
    packed = packed[:-2] | packed[2:] << np.uint64(16)
    packed = packed[:-4] | packed[4:] << np.uint64(32)
    at = np.arange(n)
    known = phi >= 0
    same = known & (at > 0) & (phi > 0)
    same[same] = (data[at[same] - 1] == data[phi[same] - 1]) & (room[at[same] - 1] > 0) & (room[phi[same] - 1] > 0)
    start = np.flatnonzero(~same)
    value = np.zeros(len(start), np.int64)
    most = np.where(phi[start] >= 0, np.minimum(room[start], room[phi[start]]), 0)
    alive = np.flatnonzero(most > 0)
    while len(alive):
        i = start[alive]
        odd = packed[i + value[alive]] ^ packed[phi[i] + value[alive]]
        zero = odd == 0
        lowest = odd & (~odd + np.uint64(1))
        value[alive] += np.where(zero, 8, np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3)
        alive = alive[zero]
        alive = alive[value[alive] < most[alive]]
    value = np.minimum(value, most)
    base = np.maximum.accumulate(np.where(same, 0, at))
    whole = np.zeros(n, np.int64)
    whole[start] = value
    return whole[base] - (at - base), phi


def search_segments(segments: list[tuple[bytes, int, int]], width: int = WIDTH) -> list[np.ndarray]:
    """For each (bytes, windows, copies): which windows occur twice or more in all."""
    count = len(segments)
    lengths = np.array([len(s) for s, _, _ in segments])
    data = np.frombuffer(b"\x00".join(s for s, _, _ in segments) + b"\x00", np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    text = data.astype(np.int64) + count
    text[ends] = np.append(np.arange(1, count), 0)
    room = np.repeat(ends, lengths + 1) - np.arange(len(text))
    sa = suffix_array(text, count)
    plcp, phi = permuted_prefixes(data, room, sa)
    hit = np.flatnonzero(plcp >= width)
    repeated = np.zeros(len(text), bool)
    repeated[hit] = True
    repeated[phi[hit]] = True
    return [np.ones(w, bool) if c > 1 else repeated[s:s + w] for s, (_, w, c) in zip(starts.tolist(), segments)]


def cut_bytes(text: bytes, firsts: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> Iterator[bytes]:
    for f, c in zip(firsts.tolist(), counts.tolist()):
        yield text[f:f + c + width - 1]


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", width: int = WIDTH, as_text: bool = False) -> DataFrame:
    """``keep`` columns, ``n_bytes, n_removed, n_spans, kept``: binary, or a string without the code points that a cut went through."""
    names = [f"_k{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].cast("string").alias("_text"))
    src, places = repeated_places(
        src, width, max(width * GRAM // 100, 1), byte_symbols, lambda t, f, c: cut_bytes(t, f, c, width), lambda s: search_segments(s, width), "suffix-segments")
    moved = F.transform("_runs", lambda r: F.struct((r["_offset"] + F.col("_first")).alias("_first"), r["_count"].alias("_count")))
    marks = places.select("_rid", moved.alias("_runs")).groupBy("_rid").agg(F.flatten(F.collect_list("_runs")).alias("_runs"))
    joined = squeezed(src).join(marks, "_rid", "left").drop("_rid")
    types = dict(src.dtypes)

    kind = pa.string() if as_text else pa.binary()

    def finish(left: bytes):
        return left.decode("utf-8", "ignore") if as_text else left

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            total, gone, spans, kept = [], [], [], []
            for t, runs in zip(b.column("_text"), b.column("_runs").to_pylist()):
                t = expand(t.as_py())
                total.append(len(t))
                if not runs:
                    gone.append(0)
                    spans.append(0)
                    kept.append(finish(t))
                    continue
                change = np.zeros(len(t) + 1, np.int32)
                for r in runs:
                    change[r["_first"]] += 1
                    change[r["_first"] + r["_count"] + width - 1] -= 1
                removed = np.cumsum(change[:-1]) > 0
                gone.append(int(removed.sum()))
                spans.append(int(np.count_nonzero(np.diff(np.concatenate([[False], removed]).astype(np.int8)) > 0)))
                kept.append(finish(np.frombuffer(t, np.uint8)[~removed].tobytes()))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, kind)],
                                             [*names, "n_bytes", "n_removed", "n_spans", "kept"])

    out = joined.mapInArrow(strip, ", ".join(f"{n} {types[n]}" for n in names) + ", n_bytes long, n_removed long, n_spans long, kept " + ("string" if as_text else "binary"))
    return out.withColumnsRenamed(dict(zip(names, keep)))


__all__ = ["suffix_array", "sort_recursively", "permuted_prefixes", "search_segments", "remove_repeats", "WIDTH", "GRAM"]
