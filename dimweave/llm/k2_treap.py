"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are dealt into shards where they lie.  A shard's grid has a row per
distinct term (the common ones first, so that full cells lie together) and a
column per document (by length); a filled cell is a term of a document.  The
grid is a quadtree: a node covers a square, four bits tell which quarters hold
anything, and every node has the greatest impact inside, stored as the
difference from its parent's.  Children are found by counting bits, so the tree
holds no pointers.  A cell keeps the term's occurrences, from which the exact impact follows.

All items descend a shard's tree together.  A node of the search is a range of
documents with the nodes of an item's terms over that range: each term follows
its row's path, and the range's bound is the sum of weights times maxima.  The
ranges of the greatest bounds are split first, an item's ranges whose bound is
under its ``top``-th best score so far are dropped, and a range of one document
has its exact score, so the result is exact.

Some shards, chosen by hash, are searched first; the ``top``-th best score found there is
where the others start from, so that they return few rows.  Items are searched
in blocks of about ``ITEM_TERMS`` terms, each a pass over the index.

Defined results: null and empty texts have no terms and are in no ranking;
items without terms known to the corpus have no rows; a repeated document or
item row counts and is ranked each by itself; equal scores go to the smaller
id, null ids last; empty tables give no rows; only the named columns are read.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from dimweave.session import work_dir

from .anchors import gram_hash, mix, prefix_hash
from .common import byte_rows, stored

TOP = 50
#: Bytes of text and documents of a shard, but for a last whole document.
SHARD_BYTES, SHARD_DOCS = 6 << 20, 4096
#: One shard in so many is searched first.
SEED_SHARES = 32
#: Terms of the items that one pass over the index takes, and the ranges an item splits at once.
ITEM_TERMS, SPLIT = 100_000, 48
#: Impacts are below a million; a node keeps its maximum in units of this size, rounded up, in 16 bits.
UNIT = 16
#: Bytes whose terms are counted at once, at some fifty bytes of room for each.
PIECE = 1 << 20

_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LOWER = mix(np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + np.uint64(1))


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of some documents, and each document's first term (one bound more)."""
    inside = _TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    begins[cut] |= inside[cut]
    stop = np.ones(len(data), bool)
    stop[:-1] = ~inside[1:] | begins[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stop & inside) + 1
    return gram_hash(prefix_hash(_LOWER[data]), starts, ends), np.searchsorted(starts, offsets)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, hash, occurrences)`` of every term of every document; one long document is read piece by piece."""
    if len(offsets) > 2 or len(data) <= 2 * PIECE:
        hashes, first = term_hashes(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    else:
        found, at = [], 0
        while at < len(data):
            gap = np.flatnonzero(~_TERM[data[at + PIECE:at + 2 * PIECE]])
            end = at + PIECE + int(gap[0]) if len(gap) else len(data)
            found.append(np.unique(term_hashes(data[at:end], np.array([0, min(end, len(data)) - at]))[0], return_counts=True))
            at = end
        hashes, many = (np.concatenate(x) for x in zip(*found))
        distinct, inverse = np.unique(hashes, return_inverse=True)
        return np.zeros(len(distinct), np.int64), distinct, np.bincount(inverse, weights=many).astype(np.int64)
    distinct, inverse = np.unique(hashes, return_inverse=True)
    key, many = np.unique(owner * max(len(distinct), 1) + inverse, return_counts=True)
    return key // max(len(distinct), 1), distinct[key % max(len(distinct), 1)], many


class Corpus(NamedTuple):
    """Documents with a term, and the terms of all of them."""

    documents: int
    length: int


def corpus_of(docs: DataFrame, text: str = "text") -> Corpus:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2, np.int64)
        for b in batches:
            for _, _, data, offsets in byte_rows(b.column("_text"), PIECE):
                inside = _TERM[data]
                begins = inside.copy()
                begins[1:] &= ~inside[:-1]
                begins[offsets[:-1][np.diff(offsets) > 0]] |= inside[offsets[:-1][np.diff(offsets) > 0]]
                many = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
                total += np.count_nonzero(many), many.sum()
        yield pa.RecordBatch.from_arrays([pa.array(total[:1]), pa.array(total[1:])], ["_n", "_l"])

    parts = docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(count, "_n long, _l long")
    row = parts.agg(F.sum("_n"), F.sum("_l")).first()
    return Corpus(row[0] or 0, row[1] or 0)


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of each number at its even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree(NamedTuple):
    """A K2-treap: ``depth`` levels, quarters' ``bits``, ``maxima`` of the inner nodes in units, ``tf`` of the cells, ``m`` of the columns.

    Nodes are numbered from the root down, level by level; bit ``4 * node + quarter`` of ``bits``
    says whether the quarter (row half, column half) holds a node, which is
    numbered one more than the bits set before it.
    """

    depth: int
    bits: np.ndarray
    before: np.ndarray
    maxima: np.ndarray
    tf: np.ndarray
    m: np.ndarray

    def child(self, node: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The numbers of the nodes' quarters; -1 where nothing is."""
        at = 4 * node + quarter
        byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
        held = (byte >> bit) & 1
        rank = self.before[at >> 3] + np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
        return np.where(held, rank + 1, -1)


def pack_tree(row: np.ndarray, col: np.ndarray, tf: np.ndarray, m: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """``(depth, bits, differences, tf)`` of a grid's cells, packed."""
    depth = max(int(row.max()).bit_length(), int(col.max()).bit_length(), 1)
    code = (_spread(row) << np.uint64(1)) | _spread(col)
    order = np.argsort(code)
    code, tf = code[order], tf[order]
    high = -(-impact(tf, m[col[order]]) // UNIT)
    levels = []  # from the cells up: codes and maxima
    for _ in range(depth + 1):
        levels.append((code, high))
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        code, high = parent[first], np.maximum.reduceat(high, first)
    levels.reverse()
    places, less, nodes = [], [levels[0][1]], 0
    for (above, most), (code, high) in zip(levels[:-1], levels[1:]):
        mine = np.searchsorted(above, code >> np.uint64(2))
        places.append(4 * (nodes + mine) + (code & np.uint64(3)).astype(np.int64))
        less.append(most[mine] - high)
        nodes += len(above)
    flags = np.zeros(4 * nodes, np.uint8)
    flags[np.concatenate(places)] = 1
    squeeze = zstandard.ZstdCompressor(level=3).compress
    differences = np.concatenate(less[:-1]).astype("<u2")  # the cells' own follow from their occurrences
    return depth, squeeze(np.packbits(flags, bitorder="little").tobytes()), squeeze(differences.tobytes()), squeeze(tf.astype("<u4").tobytes())


def open_tree(depth: int, bits: bytes, differences: bytes, tf: bytes, m: np.ndarray) -> Tree:
    expand = zstandard.ZstdDecompressor().decompress
    packed = np.frombuffer(expand(bits), np.uint8)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
    maxima = np.frombuffer(expand(differences), "<u2").astype(np.int32)
    flags = np.unpackbits(packed, bitorder="little")[:4 * len(maxima)].reshape(-1, 4)
    many = flags.sum(axis=1, dtype=np.int64)
    first, last = 0, 1  # a level's nodes; the next level's follow them
    for _ in range(depth - 1):
        below = many[first:last]
        held = slice(last, last + int(below.sum()))
        maxima[held] = np.repeat(maxima[first:last], below) - maxima[held]
        first, last = last, held.stop
    return Tree(depth, packed, before, maxima, np.frombuffer(expand(tf), "<u4").astype(np.int64), m)


def search_tree(tree: Tree, item: np.ndarray, row: np.ndarray, weight: np.ndarray, floor: np.ndarray, ids: np.ndarray, top: int = TOP):
    """``(item, column, score)`` of each item's best columns, best first in bound; ``floor`` is the least score asked per item.

    ``item, row, weight`` name the terms, in item order; ``ids`` orders columns of equal score.
    """
    inner, columns, least = len(tree.maxima), len(tree.m), floor.copy()
    best: list[tuple] = [(np.zeros(0, np.int64),) * 3]
    # open ranges (owner, level, column prefix, bound) and their terms' nodes, grouped by range
    owner, range_of = np.unique(item, return_inverse=True)
    level, prefix = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
    node, path, times = np.zeros(len(row), np.int64), row, weight
    bound = np.bincount(range_of, weights=times * (UNIT * int(tree.maxima[0]))).astype(np.int64)
    parked: list[tuple] = []

    def merged(ranges: list[tuple]) -> tuple:
        shift = np.cumsum([0] + [len(r[0]) for r in ranges[:-1]])
        return tuple(np.concatenate([r[k] + s if k == 4 else r[k] for r, s in zip(ranges, shift)]) for k in range(8))

    def chosen(ranges: tuple, keep: np.ndarray) -> tuple:
        number = np.cumsum(keep) - 1
        mine = keep[ranges[4]]
        return (*(x[keep] for x in ranges[:4]), number[ranges[4][mine]], *(x[mine] for x in ranges[5:]))

    ranges = (owner, level, prefix, bound, range_of, node, path, times)
    while len(ranges[0]):
        owner, bound = ranges[0], ranges[3]
        alive = bound >= np.maximum(least[owner], 1)
        ranges = chosen(ranges, alive)
        owner, bound = ranges[0], ranges[3]
        order = np.lexsort((-bound, owner))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        now, rest = chosen(ranges, place < SPLIT), chosen(ranges, place >= SPLIT)
        # split: every term's node into its two quarters along the row's path
        owner, level, prefix, bound, range_of, node, path, times = now
        half = (path >> (tree.depth - 1 - level[range_of])) & 1
        children = [tree.child(node, 2 * half + side) for side in (0, 1)]
        node = np.stack(children, axis=1).reshape(-1)
        at = np.repeat(2 * range_of, 2) + np.tile([0, 1], len(range_of))
        path, times = np.repeat(path, 2), np.repeat(times, 2)
        found = node >= 0
        node, at, path, times = node[found], at[found], path[found], times[found]
        owner, level, prefix = np.repeat(owner, 2), np.repeat(level + 1, 2), np.stack([2 * prefix, 2 * prefix + 1], axis=1).reshape(-1)
        cell = node >= inner
        high = np.empty(len(node), np.int64)
        high[~cell] = UNIT * tree.maxima[node[~cell]].astype(np.int64)
        high[cell] = impact(tree.tf[node[cell] - inner], tree.m[prefix[at[cell]]])
        bound = np.zeros(len(owner), np.int64)
        np.add.at(bound, at, times * high)
        after = (owner, level, prefix, bound, at, node, path, times)
        done = (level == tree.depth) & (bound > 0)
        if done.any():
            best.append((owner[done], prefix[done], bound[done]))
            o, c, s = (np.concatenate(x) for x in zip(*best))
            order = np.lexsort((ids[c], -s, o))
            o, c, s = o[order], c[order], s[order]
            rank = np.arange(len(o)) - np.searchsorted(o, o)
            full = rank == top - 1
            least[o[full]] = np.maximum(least[o[full]], s[full])
            keep = (rank < top) & (s >= floor[o])
            best = [(o[keep], c[keep], s[keep])]
        ranges = merged([rest, chosen(after, (level < tree.depth) & (bound > 0))])
    return best[0] if len(best) == 1 else tuple(np.concatenate(x) for x in zip(*best))


def build_index(docs: DataFrame, corpus: Corpus, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index, a row per shard; partitioned by whether the shard is searched first."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        ids, found, size, documents = [], [], 0, 0

        def shard() -> pa.RecordBatch:
            owner, hashes, tf = (np.concatenate(x) for x in zip(*found))
            names = pa.concat_arrays(ids)
            n = np.bincount(owner, weights=tf, minlength=len(names)).astype(np.int64)
            order = np.argsort(-n, kind="stable")  # columns by length
            order = order[n[order] > 0]
            column = np.full(len(names), -1)
            column[order] = np.arange(len(order))
            m = np.array([50 + 50 * int(x) * corpus.documents // corpus.length for x in n[order]], np.int64)
            terms, term = np.unique(hashes, return_inverse=True)
            held = np.bincount(term)
            row = np.empty(len(terms), np.int64)
            row[np.argsort(-held, kind="stable")] = np.arange(len(terms))
            depth, bits, differences, cells = pack_tree(row[term], column[owner], tf, m)
            lists = pa.ListArray.from_arrays
            return pa.RecordBatch.from_arrays(
                [lists(pa.array([0, len(order)], pa.int32()), names.take(pa.array(order))), lists(pa.array([0, len(m)], pa.int32()), pa.array(m)),
                 lists(pa.array([0, len(terms)], pa.int32()), pa.array(terms.view(np.int64))), lists(pa.array([0, len(terms)], pa.int32()), pa.array(held.astype(np.int32))),
                 pa.array([squeeze(row.astype("<u4").tobytes())], pa.binary()), pa.array([depth], pa.int32()), pa.array([bits], pa.binary()), pa.array([differences], pa.binary()),
                 pa.array([cells], pa.binary()), pa.array([int(mix(terms[:1])[0] % np.uint64(SEED_SHARES)) == 0])],
                names_of_columns)

        for b in batches:
            for i, j, data, offsets in byte_rows(b.column("_text"), min(PIECE, SHARD_BYTES)):
                owner, hashes, tf = term_counts(data, offsets)
                found.append((owner + documents, hashes, tf))
                ids.append(b.column("_id").slice(i, j - i))
                size, documents = size + len(data), documents + j - i
                if size >= SHARD_BYTES or documents >= SHARD_DOCS:
                    if any(len(x[0]) for x in found):
                        yield shard()
                    ids, found, size, documents = [], [], 0, 0
        if any(len(x[0]) for x in found):
            yield shard()

    names_of_columns = ["_ids", "_m", "_terms", "_held", "_rows", "_depth", "_bits", "_less", "_tf", "_first"]
    shards = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(
        run, f"_ids array<{kind}>, _m array<long>, _terms array<long>, _held array<int>, _rows binary, _depth int, _bits binary, _less binary, _tf binary, _first boolean")
    path = work_dir(docs.sparkSession, "treap-index")
    shards.write.partitionBy("_first").parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``_item, _id, _term`` of every item row's distinct terms, stored; ``_item`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_rows(b.column("_text"), PIECE):
                owner, hashes, _ = term_counts(data, offsets)
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays([b.column("_item").slice(i, j - i).take(at), b.column("_id").slice(i, j - i).take(at), pa.array(hashes.view(np.int64))], ["_item", "_id", "_term"])

    rows = items.select(F.monotonically_increasing_id().alias("_item"), F.col(item_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return stored(rows.mapInArrow(run, f"_item long, _id {dict(items.dtypes)[item_id]}, _term long"), "treap-item-terms")


def weighted_terms(terms: DataFrame, index: DataFrame, corpus: Corpus) -> DataFrame:
    """``_item, _id, _term, _weight`` for the terms that documents hold, by their document frequency over all shards; stored."""
    asked = terms.select("_term").distinct()
    held = index.select(F.explode(F.arrays_zip("_terms", "_held")).alias("_x")).select(F.col("_x._terms").alias("_term"), F.col("_x._held").alias("_held"))
    df = held.join(asked, "_term", "left_semi").groupBy("_term").agg(F.sum("_held").alias("_df"))
    ratio = F.lit(float(2 * corpus.documents + 2)) / (2 * F.col("_df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long")
    return stored(terms.join(df, "_term").select("_item", "_id", "_term", weight.alias("_weight")).where("_weight > 0"), "treap-weights")


def search(index: DataFrame, weights: DataFrame, top: int = TOP) -> DataFrame:
    """``_item, _id, doc_id, score, rank`` of every item row's best documents."""
    spark = index.sparkSession
    kind, item_kind = index.schema["_ids"].dataType.elementType.simpleString(), dict(weights.dtypes)["_id"]
    blocks = max(-(-weights.count() // ITEM_TERMS), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                terms = b.column("_terms")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                asked = b.column("_asked")[k].values
                item, floor = (asked.field(f).to_numpy(zero_copy_only=False) for f in (0, 1))
                lists = asked.field(2)
                of = np.repeat(np.arange(len(item)), lists.value_lengths().to_numpy(zero_copy_only=False))
                flat = lists.flatten()
                term, weight = flat.field(0).to_numpy(zero_copy_only=False).view(np.uint64), flat.field(1).to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
                here = terms[at] == term
                rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(b.column("_rows")[k].as_py()), "<u4").astype(np.int64)
                m = b.column("_m")[k].values.to_numpy(zero_copy_only=False)
                tree = open_tree(*(b.column(c)[k].as_py() for c in ("_depth", "_bits", "_less", "_tf")), m)
                ids = b.column("_ids")[k].values
                order = np.empty(len(ids), np.int64)
                order[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                o, c, s = search_tree(tree, of[here], rows[at[here]], weight[here], floor, order, top)
                yield pa.RecordBatch.from_arrays([pa.array(item[o]), ids.take(pa.array(c)), pa.array(s)], ["_item", "doc_id", "score"])

    def ranked(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)

    def asked_of(block: int, floors: DataFrame | None) -> DataFrame:
        """One row: the items of a block with their least scores and terms."""
        mine = weights.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block)
        lists = mine.groupBy("_item").agg(F.collect_list(F.struct("_term", "_weight")).alias("_list"))
        lists = lists.withColumn("_floor", F.lit(0).cast("long")) if floors is None else lists.join(floors, "_item", "left").withColumn("_floor", F.coalesce("_floor", F.lit(0).cast("long")))
        return lists.agg(F.collect_list(F.struct("_item", "_floor", "_list")).alias("_asked"))

    def searched(shards: DataFrame, asked: DataFrame) -> DataFrame:
        pairs = shards.select("_ids", "_m", "_terms", "_rows", "_depth", "_bits", "_less", "_tf").crossJoin(F.broadcast(asked))  # one row of about ITEM_TERMS terms
        return pairs.mapInArrow(run, f"_item long, doc_id {kind}, score long")

    found = None
    for block in range(blocks):
        first = stored(ranked(searched(index.where("_first"), asked_of(block, None))), "treap-first")
        floors = first.where(F.col("rank") == top).select("_item", F.col("score").alias("_floor"))
        rest = searched(index.where("not _first"), asked_of(block, floors))
        both = ranked(rest.unionByName(first.drop("rank")))
        both = stored(both, "treap-ranked") if blocks > 1 else both
        found = both if found is None else found.unionByName(both)
    names = weights.select("_item", "_id").distinct()
    return found.join(names, "_item").select("_item", "_id", "doc_id", "score", "rank")


def ranked_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """``_item, _id, doc_id, score, rank``: the best documents of every item row."""
    corpus = corpus_of(docs, text)
    index = build_index(docs, corpus, doc_id, text)
    return search(index, weighted_terms(item_terms(items, item_id, text), index, corpus), top)


__all__ = ["term_hashes", "term_counts", "corpus_of", "pack_tree", "open_tree", "search_tree", "build_index", "item_terms", "weighted_terms", "search", "ranked_search"]
