"""Lexical retrieval packing.

Every document is encoded once; document frequencies and the mean length are
counted over all of them.  Documents are then ordered by their weightiest
shared terms, wherever they were stored, (or by an order that the caller
gives) and cut into shards of at most ``SHARD`` bytes of text and one more
document.  A shard has a BM25 inverted index over token ids with the corpus'
statistics: the current seed document asks it, with all its terms, for its
best unused neighbours, which fill the seed's window greedily; the last one
is cut where the window is full and seeds the next window.  What remains at a
shard's end is cut into sequences whose lengths are powers of two, which need
no padding.  A neighbour that was routed to another shard is not found.

Defined results: a null or empty text is its closing id alone; ties in score
go to the earlier document of the shard; repeated rows are documents of their
own; documents longer than a window run through several; an empty table gives
no pieces.  Only the named columns are read.  Sequence numbers rise with the
order of the shards and start anew in the high bits for each partition.
Shards, and so windows, depend on how the session deals out the ordered rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .anchors import byte_symbols, gram_hash, prefix_hash
from .common import stored, with_row_id

WINDOW = 2048
END = 1
SHARD = 3_000_000
#: BM25 constants, and how many of a document's weightiest terms route it to a shard.
K1, B, ROUTE = 1.2, 0.75, 3
#: Numbers of the corpus statistics that are summed in one group.
STATISTICS_BLOCK = 1 << 12
#: White space beyond the ASCII signs; texts that hold any are encoded whole.
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def added_tokens(ranks_path: str) -> dict[str, int]:
    """Added tokens of the vocabulary file beside the ranks, which ``tokenizers`` finds inside texts too."""
    with open(ranks_path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class Encoder:
    """Token ids of the byte-level BPE vocabulary, equal to the ``tokenizers`` ids of ``byte_bpe_50k.json``.

    A text is first cut at the literal added tokens, which have ids of their own.

    The split pattern never joins a sign to white space after it, so a text is
    encoded by its units (white space and the signs up to the next white
    space), each distinct unit of a run of texts once, by ``tiktoken`` over the
    same vocabulary's ranks.
    """

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = added_tokens(ranks_path) if added is None else added
        longest = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(b) for b in ranks]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, each closed by ``END``."""
        if self.cuts is None or not any(self.cuts.search(t) for t in texts):
            return self._plain(texts)
        parts = [self.cuts.split(t) for t in texts]  # every second part is an added token
        plain = iter(self._plain([x for p in parts for x in p[::2]]))
        out = []
        for p in parts:
            ids = [np.array([self.added[x]], np.uint32) if k % 2 else next(plain)[:-1] for k, x in enumerate(p)]
            out.append(np.concatenate([*ids, np.array([END], np.uint32)]))
        return out

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The same for texts without added tokens."""
        odd = {i for i, t in enumerate(texts) if _OTHER_SPACE.search(t)}
        raw = [b"" if i in odd else t.encode("utf-8", "surrogatepass") for i, t in enumerate(texts)]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        space = (data == 32) | ((data >= 9) & (data <= 13))
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        flat, first = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if len(starts):
            key = gram_hash(prefix_hash(byte_symbols(data, offsets)[0]), starts, ends)
            unit, distinct_keys = pd.factorize(key)  # hashed, not sorted
            example = np.empty(len(distinct_keys), np.int64)
            example[unit[::-1]] = np.arange(len(unit))[::-1]
            sizes, begins, ids = self._units(data.tobytes(), starts[example], ends[example], data)
            many = sizes[unit]
            last = np.cumsum(many)
            flat = ids[np.repeat(begins[unit] - (last - many), many) + np.arange(last[-1])]
            first = np.concatenate([[0], last])[np.searchsorted(starts, offsets)]
        close = np.array([END], np.uint32)
        return [np.array([*self.whole(t), END], np.uint32) if i in odd else np.concatenate([flat[first[i]:first[i + 1]], close])
                for i, t in enumerate(texts)]


    def _units(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(sizes, first, ids)`` of units: unit ``k`` has ``sizes[k]`` ids from ``first[k]`` on.

        Those that begin with white space and end in another sign are encoded
        in one text: a word never goes through their borders, so the ids'
        lengths in bytes tell which are whose.
        """
        def space(at):
            return (data[at] == 32) | ((data[at] >= 9) & (data[at] <= 13))

        inner = space(starts) & ~space(ends - 1)
        sizes, ids = np.zeros(len(starts), np.int64), np.zeros(0, np.uint32)
        together = np.flatnonzero(inner)
        if len(together):
            last = np.cumsum((ends - starts)[together])
            bytes_of = np.repeat(ends[together] - last, (ends - starts)[together]) + np.arange(last[-1])
            ids = np.array(self.whole(data[bytes_of].tobytes().decode("utf-8", "surrogatepass")), np.uint32)
            done = np.searchsorted(np.cumsum(self.lengths[ids]), last)
            sizes[together] = np.diff(done + 1, prepend=0)
        alone = np.flatnonzero(~inner)
        found = [self.whole(joined[a:b].decode("utf-8", "surrogatepass")) for a, b in zip(starts[alone].tolist(), ends[alone].tolist())]
        sizes[alone] = [len(f) for f in found]
        order = np.concatenate([together, alone])
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        begins = np.zeros(len(starts), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, begins, ids


class Statistics(NamedTuple):
    """What BM25 needs of the whole corpus: documents, their mean length and each id's document frequency."""

    documents: int
    mean: float
    df: np.ndarray

    def idf(self) -> np.ndarray:
        return np.log1p(np.maximum(self.documents - self.df + 0.5, 0) / (self.df + 0.5))


def distinct(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and how often each occurs, without sorting all; ``place`` is room for a number per id of the vocabulary."""
    at = np.arange(len(ids))
    place[ids] = at
    terms = ids[place[ids] == at]  # where an id occurs last
    terms = terms[np.argsort(terms, kind="stable")]
    place[terms] = np.arange(len(terms))
    return terms, np.bincount(place[ids], minlength=len(terms))


def statistics_of(docs: list[np.ndarray], vocabulary: int) -> np.ndarray:
    """Document frequency of every id, then the number of documents and of ids."""
    out, place = np.zeros(vocabulary + 2, np.int64), np.zeros(vocabulary, np.int64)
    for d in docs:
        at = np.arange(len(d))
        place[d] = at
        out[d[place[d] == at]] += 1
    out[vocabulary:] = len(docs), sum(map(len, docs))
    return out


def summed(parts: np.ndarray) -> Statistics:
    return Statistics(int(parts[-2]), float(parts[-1]) / max(int(parts[-2]), 1), parts[:-2])


class Bm25:
    """Inverted index over documents' token ids, weighted by ``statistics`` (those of the documents themselves if none are given)."""

    def __init__(self, docs: list[np.ndarray], statistics: Statistics | None = None):
        n = len(docs)
        lengths = np.array([len(d) for d in docs])
        statistics = statistics or summed(statistics_of(docs, max(int(d.max(initial=0)) for d in docs) + 1))
        place = np.zeros(len(statistics.df), np.int64)
        found = [distinct(d, place) for d in docs]
        term, tf = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(term, kind="stable")
        term, tf, self.doc = term[order], tf[order], np.repeat(np.arange(n), [len(t) for t, _ in found])[order]
        start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        terms, df = term[start], np.diff(np.append(start, len(term)))
        self.start = np.append(start, len(term))
        weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / max(statistics.mean, 1)))
        self.weight = weight * np.repeat(statistics.idf()[terms], df)
        # a seed's query: all its terms that another document has too
        place = np.repeat(np.arange(len(df)), df)
        shared = np.flatnonzero(df[place] > 1)
        order = shared[np.argsort(self.doc[shared], kind="stable")]
        self.query, self.bounds = place[order], np.searchsorted(self.doc[order], np.arange(n + 1))
        self.n, self.gone = n, 0

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term with the seed, best first; used ones never come back."""
        gone = int(np.count_nonzero(used))
        if 4 * (gone - self.gone) >= self.n - self.gone:  # the lists shrink with the documents left
            keep = ~used[self.doc]
            self.start = np.concatenate([[0], np.cumsum(keep)])[self.start]
            self.doc, self.weight, self.gone = self.doc[keep], self.weight[keep], gone
        terms = self.query[self.bounds[seed]:self.bounds[seed + 1]]
        spans = list(zip(self.start[terms].tolist(), self.start[terms + 1].tolist()))
        if not spans:
            return np.zeros(0, np.int64)
        docs = np.concatenate([self.doc[i:j] for i, j in spans])
        score = np.bincount(docs, np.concatenate([self.weight[i:j] for i, j in spans]), self.n)
        score[used] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def pack_shard(docs: list[np.ndarray], window: int = WINDOW, statistics: Statistics | None = None) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` pieces; every token lies in one."""
    index = Bm25(docs, statistics)
    used = np.zeros(len(docs), bool)
    pieces, sequence, filled, free = [], 0, 0, 0
    left = sum(map(len, docs))
    room = window if left >= window else 1 << (left.bit_length() - 1)
    queue: list[int] = []
    seed = -1
    while left:
        while queue and used[queue[-1]]:
            queue.pop()
        if not queue and seed >= 0:
            queue = index.neighbours(seed, used)[::-1].tolist()
        if queue:
            doc = queue.pop()
        else:
            while used[free]:
                free += 1
            doc = free
        used[doc] = True
        if seed < 0:
            seed = doc
        at, size = 0, len(docs[doc])
        while at < size:
            step = min(size - at, room - filled)
            pieces.append((doc, at, step, sequence, filled))
            at, filled, left = at + step, filled + step, left - step
            if filled == room:
                sequence, filled = sequence + 1, 0
                room = window if left >= window else 1 << (left.bit_length() - 1) if left else 0
                # a document cut here seeds the next window; else the next one laid does
                seed, queue = (doc if at < size else -1), []
    return pieces


def route(ids: np.ndarray, idf: np.ndarray, mean: float, place: np.ndarray) -> list[int]:
    """The ``ROUTE`` weightiest terms of a document whose ``idf`` is not 0, best first; -1 where there are fewer."""
    terms, tf = distinct(ids, place)
    weight = idf[terms] * tf / (tf + K1 * (1 - B + B * len(ids) / max(mean, 1)))
    best = np.argsort(-weight, kind="stable")[:ROUTE]
    return [t if w > 0 else -1 for t, w in zip(terms[best].tolist(), weight[best].tolist())] + [-1] * (ROUTE - len(best))


def corpus_statistics(coded: DataFrame, vocabulary: int, kind: str) -> Statistics:
    """Over all rows of ``_ids``; one fixed-size vector per task, summed by blocks."""
    names = ["_block", "_counts"]
    blocks = -(-(vocabulary + 2) // STATISTICS_BLOCK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(blocks * STATISTICS_BLOCK, np.int64)
        for b in batches:
            total[:vocabulary + 2] += statistics_of([np.frombuffer(x.as_buffer(), kind) for x in b.column("_ids")], vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([x.tobytes() for x in total.reshape(blocks, -1)], pa.binary())], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            for k, counts in zip(b.column("_block").to_pylist(), b.column("_counts").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names)

    parts = coded.select("_ids").mapInArrow(count, "_block int, _counts binary").repartition("_block").mapInArrow(add, "_block int, _counts binary")
    out = np.zeros((blocks, STATISTICS_BLOCK), np.int64)
    for row in parts.collect():  # vocabulary + 2 numbers in all
        out[row["_block"]] = np.frombuffer(row["_counts"], np.int64)
    return summed(out.reshape(-1)[:vocabulary + 2])


def pack(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
         window: int = WINDOW, shard: int = SHARD, with_ids: bool = False, order: list[Column] | None = None) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``, if asked for).

    Shards are runs of the documents in the given ``order``, or else in that of their ``route``.
    """
    id_type = dict(docs.dtypes)[doc_id]
    added = added_tokens(ranks_path)
    with open(ranks_path, "rb") as f:
        vocabulary = max([sum(1 for _ in f) - 1, *(int(x) for x in added.values())]) + 1
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    places = [c.alias(f"_place{k}") for k, c in enumerate(order or [])]
    src = with_row_id(docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"), *places))
    given = [c for c in src.columns if c.startswith("_place")]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks_path, pattern, added)
        for b in batches:
            texts = [t or "" for t in b.column("_text").to_pylist()]
            ends = np.cumsum([len(t) + 1 for t in texts])
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SHARD, side="right")))
                ids = [x.astype(kind).tobytes() for x in encode(texts[i:j])]
                rest = [b.column(c).slice(i, j - i) for c in ("_id", "_rid", *given)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array([len(t) + 1 for t in texts[i:j]], pa.int64()), pa.array(ids, pa.binary())],
                                                 ["_id", "_rid", *given, "_size", "_ids"])
                i = j

    kinds = dict(src.dtypes)
    coded = stored(src.mapInArrow(code, ", ".join(f"{c} {kinds[c]}" for c in ("_id", "_rid", *given)) + ", _size long, _ids binary"), "packing-ids")
    statistics = docs.sparkSession.sparkContext.broadcast(corpus_statistics(coded, vocabulary, kind))
    routes = [f"_route{k}" for k in range(ROUTE)]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = np.where(statistics.value.df > 1, statistics.value.idf(), 0)  # a term of one document leads nowhere
        place = np.zeros(vocabulary, np.int64)
        for b in batches:
            found = np.array([route(np.frombuffer(x.as_buffer(), kind), idf, statistics.value.mean, place) for x in b.column("_ids")], np.int64).reshape(-1, ROUTE)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("_id", "_rid", "_size", "_ids")), *(pa.array(x) for x in found.T.copy())], ["_id", "_rid", "_size", "_ids", *routes])

    if order is None:
        coded = coded.mapInArrow(routed, f"_id {id_type}, _rid long, _size long, _ids binary, " + ", ".join(f"{c} long" for c in routes))
    by = [*(given or routes), "_rid"]
    laid = coded.repartitionByRange(*by).sortWithinPartitions(*by).select("_id", "_size", "_ids")
    fields = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, ids, size = TaskContext.get().partitionId() << 36, [], [], 0

        def answer():
            nonlocal base
            pieces = pack_shard(held, window, statistics.value)
            doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
            parts = [held[d][s:s + n].astype("<u4") for d, s, n, _, _ in pieces]
            columns = [pa.array([ids[d] for d in doc], pa_kind), pa.array(start), pa.array(length), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                       pa.array([len(held[d]) for d in doc], pa.int64()), pa.array(sequence + base), pa.array(offset)]
            base += int(sequence[-1]) + 1
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
            names = [doc_id, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays(columns, names[:len(columns)])

        for b in batches:
            pa_kind = b.column("_id").type
            for i, n, x in zip(b.column("_id").to_pylist(), b.column("_size").to_pylist(), b.column("_ids")):
                held.append(np.frombuffer(x.as_py(), kind))
                ids.append(i)
                size += n
                if size >= shard:
                    yield answer()
                    held, ids, size = [], [], 0
        if held:
            yield answer()

    return laid.mapInArrow(run, f"`{doc_id}` {id_type}, {fields}")


__all__ = ["Encoder", "Statistics", "Bm25", "pack_shard", "route", "corpus_statistics", "pack", "WINDOW", "END", "SHARD"]
