"""Substring de-duplication over words with a compressed FM-index per shard.

The corpus' windows are routed by their anchors (``anchors.py``); each shard
holds whole anchor groups, concatenates their distinct segments and builds an
FM-index: the Burrows-Wheeler transform of the word numbers in a wavelet
matrix of packed bits with sampled counts.  The segments are streamed through
backward search, all window ends in step, which gives matching statistics up
to the window width; windows whose interval stands for two or more places
are reported.

Defined results: null, empty and blank texts have no words; repeated rows are
repeats of each other; windows never cross documents; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .anchors import repeated_places, squeezed, word_symbols

WIDTH = 35
GRAM = 14


class WaveletMatrix:
    """Packed bits per level with a count per 64 bits; answers how often a symbol occurs before a place."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = ((values >> level) & 1).astype(bool)
            padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
            padded[:len(bits)] = bits
            packed = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(len(bits) - int(bits.sum()))
            values = np.concatenate([values[~bits], values[bits]])

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The place that ``at`` maps to below all levels along each symbol's bits."""
        at = at.astype(np.int64)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][block] + np.bitwise_count(self.words[k][block] & mask)
            at = np.where((symbols >> level) & 1, self.zeros[k] + ones, at - ones)
        return at


def suffix_array(text: np.ndarray, longest: int) -> np.ndarray:
    """Order of all suffixes by doubling; separators are distinct, so ``longest`` symbols decide."""
    n = len(text)
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    reach = 1
    while reach <= longest:
        key = rank * (n + 1)
        key[:n - reach] += rank[reach:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.ones(n, np.int64)
        fresh[0] = 0
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n - 1:
            break
        reach *= 2
    return order


class FMIndex:
    """Index over segments of word numbers; an occurrence weighs as many as its segment has copies."""

    def __init__(self, segments: list[np.ndarray], copies: np.ndarray):
        lengths = np.array([len(s) for s in segments])
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths - 1
        count = len(segments)
        text = np.empty(int(self.ends[-1]), np.int64)
        inside = np.ones(len(text), bool)
        inside[self.ends - 1] = False
        text[self.ends - 1] = np.arange(count)  # a separator of its own after each
        text[inside] = np.concatenate(segments) + count
        order = suffix_array(text, int(lengths.max()) + 1)
        self.text, self.inside = text, inside
        _, compact = np.unique(text, return_inverse=True)
        self.symbol = np.where(inside, compact, 0)
        sigma = int(compact.max()) + 1
        last = compact[order - 1]  # the symbol before each suffix
        self.matrix = WaveletMatrix(last, sigma)
        every = np.arange(sigma)
        self.base = self.matrix.descend(every, np.zeros(sigma, np.int64))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(compact, minlength=sigma))])
        owner = np.repeat(np.arange(count), lengths + 1)
        self.weight = np.concatenate([[0], np.cumsum(copies[owner[order]])])

    def repeated(self, ends: np.ndarray, width: int, least: int = 2) -> np.ndarray:
        """Whether the ``width`` symbols before each place have at least ``least`` occurrences."""
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text), np.int64)
        alive = np.arange(len(ends))
        for step in range(1, width + 1):
            c = self.symbol[ends[alive] - step]
            shift = self.first[c] - self.base[c]
            lo = shift + self.matrix.descend(c, lo)
            hi = shift + self.matrix.descend(c, hi)
            keep = self.weight[hi] - self.weight[lo] >= least
            alive, lo, hi = alive[keep], lo[keep], hi[keep]
        out = np.zeros(len(ends), bool)
        out[alive] = True
        return out


def search_segments(segments: list[tuple[bytes, int, int]], width: int = WIDTH) -> list[np.ndarray]:
    """For each (words joined by one space, windows, copies): which windows occur twice or more in all."""
    split = [s.split() for s, _, _ in segments]
    words = np.empty(sum(map(len, split)), object)
    words[:] = [w for s in split for w in s]
    numbers, _ = pd.factorize(words)
    ends = np.cumsum([len(s) for s in split])
    coded = np.split(numbers, ends[:-1])
    index = FMIndex(coded, np.array([c for _, _, c in segments]))
    counts = np.array([w for _, w, _ in segments])
    at = np.repeat(index.starts + width, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.split(index.repeated(at, width), np.cumsum(counts)[:-1])


def cut_words(text: bytes, firsts: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> Iterator[bytes]:
    words = text.split()
    for f, c in zip(firsts.tolist(), counts.tolist()):
        yield b" ".join(words[f:f + c + width - 1])


def remove_repeats(docs: DataFrame, keep: list[str], text: str = "text", width: int = WIDTH) -> DataFrame:
    """``keep`` columns, ``n_words, n_removed, kept`` (the words that stay, joined by one space)."""
    names = [f"_k{i}" for i in range(len(keep))]
    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs[text].cast("string").alias("_text"))
    src, places = repeated_places(
        src, width, GRAM, word_symbols, lambda t, f, c: cut_words(t, f, c, width), lambda s: search_segments(s, width), "fm-segments")
    moved = F.transform("_runs", lambda r: F.struct((r["_offset"] + F.col("_first")).alias("_first"), r["_count"].alias("_count")))
    marks = places.select("_rid", moved.alias("_runs")).groupBy("_rid").agg(F.flatten(F.collect_list("_runs")).alias("_runs"))
    joined = squeezed(src).join(marks, "_rid", "left").drop("_rid")
    types = dict(src.dtypes)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            total, gone, kept = [], [], []
            for t, runs in zip(b.column("_text"), b.column("_runs").to_pylist()):
                words = expand(t.as_py()).split()
                total.append(len(words))
                if runs:
                    change = np.zeros(len(words) + 1, np.int32)
                    for r in runs:
                        change[r["_first"]] += 1
                        change[r["_first"] + r["_count"] + width - 1] -= 1
                    stays = np.cumsum(change[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             [*names, "n_words", "n_removed", "kept"])

    out = joined.mapInArrow(strip, ", ".join(f"{n} {types[n]}" for n in names) + ", n_words long, n_removed long, kept string")
    return out.withColumnsRenamed(dict(zip(names, keep)))


__all__ = ["FMIndex", "WaveletMatrix", "suffix_array", "search_segments", "remove_repeats", "WIDTH", "GRAM"]
