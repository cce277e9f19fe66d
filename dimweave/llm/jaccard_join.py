"""N-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix has a row per distinct shingle set (equal sets are one
row) and a column per shingle.  Columns have one order for all rows, and the
first ones of a row, as many as its size bound asks for, must meet any
partner's, so the product over those columns finds every pair.  The order is
made so that little is left to multiply:

* First come ``SHARE`` times as many columns, chosen by hash, as a row needs on
  average.  Their occurrences are counted exactly, in one shuffle, and the
  rarest come first.  A column that occurs once meets nothing, so a
  row with enough of them is done.
* A row that holds too few of those goes on with the others, the longest
  shingles first, since these are rare.
* Columns that at least one of ``OFTEN`` rows hold, by a count in hashed cells
  while the rows are read, come last of all, and are spread by row.

Overlap counts are accumulated per pair, and pairs that the size-derived bounds
rule out are discarded; for the pairs left over the product is completed over
all columns, which gives the exact overlap.

A row also has the parities of its columns over ``PARITIES`` hashed
buckets.  Two rows differ in at least as many columns as parities, and their
sizes say in how many a linked pair may differ, so a pair over that bound is
discarded where it arises; no linked pair is.

A group of near copies is not multiplied out: a first product pairs each row
with the likest of ``REACH`` neighbours in a column (by size, then at random),
of which its ``NEAREST`` likest are tried; their links are joined to
components.  A second one pairs each row with the likest in a column of all rows of other
components, which brings in what the first left beside a group.  The last
product skips pairs inside a component.  Columns that the same rows hold are one column
with a weight.  Long
columns are cut into row blocks, and each pair of blocks is a group of its own.

Defined results: words are lower-cased in A-Z only; a text of fewer words
than a shingle has one shingle, the whole sequence; null, empty and blank texts have none,
and are linked with nothing; repeated rows and equal sets share a
component; a null id never names a component that has another id; an empty table gives an empty
result; only the named columns are read.  Shingles are told apart by 64-bit
hashes, sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .anchors import gram_hash, mix, prefix_hash, squeezed, word_bounds
from .common import BROADCAST_ROWS, byte_rows, dropped, stored, with_row_id

SHINGLE = 3
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 90
#: Columns counted exactly, for each that the size bound asks of a row on average.
SHARE = 2.0
#: A column of one in so many rows is frequent, and the binary digits of the number of cells its rows are spread over.
OFTEN, SPREAD_BITS = 1024, 8
#: Cells of the count that finds frequent columns.
CELLS = 1 << 20
#: Entries of a column that are multiplied in one group.
BLOCK = 3000
#: Parities of a row (8 numbers of 64 bits) in the bound on differing columns.
PARITIES = 512
BITS = [f"_s{k}" for k in range(PARITIES // 64)]
#: Entries before one in its column among which the first product looks for the likest, and how many of a row's it tries.
REACH, NEAREST = 12, 3
#: Bytes of text handled at once, at some hundred bytes of room for each.
PIECE = 1 << 19


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, bounds, lengths)``: sorted distinct shingle hashes per document, and the bytes of each one's words."""
    upper = (data >= 65) & (data <= 90)
    data = data + (upper.astype(np.uint8) << 5)
    starts, ends, first = word_bounds(data, offsets)
    words = gram_hash(prefix_hash(mix(np.arange(1, 257, dtype=np.uint64))[data]), starts, ends)
    prefix = prefix_hash(words)
    count = np.diff(first)
    many = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(count)), many)
    at = np.repeat(first[:-1], many) + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    until = at + np.minimum(size, np.repeat(count, many))
    hashes = gram_hash(prefix, at, until)
    total = np.concatenate([[0], np.cumsum(ends - starts)])
    lengths = total[until] - total[at]
    order = np.lexsort((hashes, owner))
    hashes, owner, lengths = hashes[order], owner[order], lengths[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(len(count) + 1)), lengths[fresh]


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many first columns of a row of ``n`` must hold one of any partner's."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def parities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, whether an odd number of its columns falls in each of ``PARITIES`` buckets; ``len(BITS)`` numbers each."""
    out = np.zeros((len(bounds) - 1) * len(BITS), np.uint64)
    bucket = mix(hashes ^ np.uint64(0x3C6EF372FE94F82A)) & np.uint64(PARITIES - 1)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    np.bitwise_xor.at(out, owner * len(BITS) + (bucket >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bucket & np.uint64(63)))
    return out.reshape(-1, len(BITS)).view(np.int64)


def differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many parities differ (the count wants unsigned numbers: it takes the absolute value of others)."""
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def able(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether rows of sizes ``n`` and ``m`` may link: they differ in no more columns than their sizes allow, as far as parities ``x`` and ``y`` tell."""
    differ = differences(x, y)
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, root`` of every linked node, root the smallest id, from links ``a, b``: alternating large and small stars.

    The least neighbours are stored, so that a join with them is of two plain
    shuffles and a hot node's edges can be split.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), name)
    while True:
        both = edges.union(edges.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m")), name)
        # every edge ends in the least node of its component: stars
        if not edges.join(low, "u").where("v != _m").limit(1).count() + edges.join(low.select(F.col("u").alias("v"), "_m"), "v").where("v != _m").limit(1).count():
            dropped(edges)
            return low.where("u != _m").select(F.col("u").alias("node"), F.col("_m").alias("root"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u != v").distinct()
        large = stored(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("_m").alias("v")).union(joined.select(F.col("v").alias("u"), F.col("_m").alias("v"))).where("u != v").distinct()
        after = stored(small, name)
        dropped(edges, low, large)
        edges = after


def _pairs(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, likest: bool = False):
    """Pairs between the rows ``left`` and ``right`` (sorted by size) that sizes, parities and components allow, ordered; only the likest of each left row, if asked for, in the left row's order and with the share of columns that differ."""
    out = []
    for i in left.tolist():
        lo, hi = np.searchsorted(n[right], [-(-percent * n[i] // 100), 100 * n[i] // percent + 1])
        j = right[lo:hi]
        j = j[comp[j] != comp[i]]
        j = j[able(bits[i], bits[j], n[i], n[j], percent)]
        if likest and len(j):
            share = differences(bits[i], bits[j]) / (n[i] + n[j])
            best = int(np.argmin(share))
            out.append((sig[i:i + 1], sig[j[best:best + 1]], share[best:best + 1]))
        elif len(j):
            out.append((np.full(len(j), sig[i]), sig[j], np.zeros(len(j))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    a, b, share = (np.concatenate(x) for x in zip(*out))
    return (a, b, share) if likest else (np.minimum(a, b), np.maximum(a, b), share)


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The pairs ``a, b`` whose full rows link: the product is completed over all columns of ``texts (_set, _text)``, zstd bytes."""
    left = texts.select(F.col("_set").alias("a"), F.col("_text").alias("_left"))
    right = texts.select(F.col("_set").alias("b"), F.col("_text").alias("_right"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for k in range(0, b.num_rows, 256):  # some pairs' texts at a time
                part = b.slice(k, 256)
                texts = dict(zip(part.column("a").to_pylist(), part.column("_left"))) | dict(zip(part.column("b").to_pylist(), part.column("_right")))
                number = {x: i for i, x in enumerate(texts)}
                raw = pa.array([expand(x.as_py()) for x in texts.values()], pa.large_binary())
                sets = []
                for _, _, data, offsets in byte_rows(raw, PIECE):
                    hashes, bounds, _ = shingle_sets(data, offsets, size)
                    sets += [hashes[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
                keep = []
                for x, y in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                    x, y = sets[number[x]], sets[number[y]]
                    common = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                kept = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(kept), part.column("b").filter(kept)], ["a", "b"])

    return full.mapInArrow(multiply, "a long, b long")


def described(src: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """``(rows, cells)`` of ``src (_rid, _id, _text)``, from one stored pass.

    ``rows``: ``_rid, _id, _one, _two, _n`` and the parities per document; ``_one, _two`` name its set.
    ``cells``: ``_one, _n``: cells of the column count that stand out in a task, and their counts.
    """
    kind = dict(src.dtypes)["_id"]
    names = ["_rid", "_id", "_one", "_two", "_n", *BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, cell = np.zeros(CELLS, np.int64), None
        for b in batches:
            cell = b.column("_id").type
            for i, j, data, offsets in byte_rows(b.column("_text"), PIECE):
                hashes, bounds, _ = shingle_sets(data, offsets, size)
                total += np.bincount((hashes >> np.uint64(44)).astype(np.int64), minlength=CELLS)
                n = np.diff(bounds)
                names_of_set = []
                for salt in (0xA5A5A5A55A5A5A5A, 0x0F1E2D3C4B5A6978):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(salt)))])
                    names_of_set.append(mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ (n.astype(np.uint64) << np.uint64(40))).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column("_rid").slice(i, j - i), b.column("_id").slice(i, j - i), *map(pa.array, names_of_set), pa.array(n), *(pa.array(x) for x in parities(hashes, bounds).T.copy())], names)
        if cell is not None:
            out = np.flatnonzero(total >= 4 * total.mean() + 16)
            nulls = lambda t: pa.nulls(len(out), t)
            yield pa.RecordBatch.from_arrays([nulls(pa.int64()), nulls(cell), pa.array(out), nulls(pa.int64()), pa.array(total[out]), *(nulls(pa.int64()) for _ in BITS)], names)

    found = stored(src.mapInArrow(run, f"_rid long, _id {kind}, _one long, _two long, _n long, " + ", ".join(f"{c} long" for c in BITS)), "jaccard-rows")
    return found.where("_rid is not null"), found.where("_rid is null").select("_one", "_n")


def first_columns(src: DataFrame, frequent: np.ndarray, percent: int, size: int) -> DataFrame:
    """``_column, _one, _info`` of every set that a batch meets: its columns that are counted, and the later ones it needs for lack of those.

    ``_info`` holds, from its lowest bit, whether the column is a late one, ``SPREAD_BITS`` bits that number a
    frequent column's cell (0: not frequent), which are also crossed with ``_column``, and how many columns of the set are counted.
    """
    share = min(SHARE * (100 - percent) / 100, 1.0)
    limit = np.uint64(int(share * (1 << 32)))
    cells = src.sparkSession.sparkContext.broadcast(frequent)  # CELLS booleans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in byte_rows(b.column("_text"), PIECE):
                hashes, bounds, lengths = shingle_sets(data, offsets, size)
                n = np.diff(bounds)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)))])
                one = mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ (n.astype(np.uint64) << np.uint64(40))).view(np.int64)
                owner = np.repeat(np.arange(len(n)), n)
                keep = np.zeros(len(n), bool)
                keep[np.unique(one, return_index=True)[1]] = True
                common = cells.value[(hashes >> np.uint64(44)).astype(np.int64)]
                counted = ~common & ((mix(hashes ^ np.uint64(0x243F6A8885A308D3)) >> np.uint64(32)) < limit)
                missing = prefix_length(n, percent) - np.bincount(owner[counted], minlength=len(n))
                short = np.flatnonzero(~counted & (missing > 0)[owner] & keep[owner])
                order = np.lexsort((hashes[short], -lengths[short], common[short], owner[short]))
                short = short[order]
                rank = np.arange(len(short)) - np.searchsorted(owner[short], owner[short])
                late = short[rank < missing[owner[short]]]
                at = np.concatenate([np.flatnonzero(counted & keep[owner]), late])
                mine = one[owner[at]]
                spread = np.where(common[at], mix(mine.view(np.uint64)) % np.uint64((1 << SPREAD_BITS) - 1) + np.uint64(1), np.uint64(0))
                many = np.bincount(owner[counted], minlength=len(n))[owner[at]]
                info = (many << (SPREAD_BITS + 1)) | (spread.astype(np.int64) << 1) | ~counted[at]
                yield pa.RecordBatch.from_arrays([pa.array((hashes[at] ^ (spread << np.uint64(40))).view(np.int64)), pa.array(mine), pa.array(info)], ["_column", "_one", "_info"])

    return src.select("_text").mapInArrow(run, "_column long, _one long, _info long")


def entries_of(src: DataFrame, sets: DataFrame, frequent: np.ndarray, percent: int, size: int) -> DataFrame:
    """``_column, _set, _n`` and the parities: the first columns of every set that another set holds too, stored."""
    # one shuffle; a column that is not frequent is in one of OFTEN rows at most, and Spark's window spills
    columns = first_columns(src, frequent, percent, size).repartition("_column").groupBy("_column", "_one").agg(F.min("_info").alias("_info"))
    of_info = {"_late": F.col("_info") % 2 == 1, "_spread": F.shiftright("_info", 1) % (1 << SPREAD_BITS), "_counted": F.shiftright("_info", SPREAD_BITS + 1)}
    counts = columns.withColumn("_c", F.count("*").over(Window.partitionBy("_column"))).withColumns(of_info)
    shared = counts.where("_c > 1 or _spread > 0").withColumn("_column", F.col("_column").bitwiseXOR(F.shiftleft("_spread", 40)))
    need = F.expr(f"_n - ({percent} * _n + 99) div 100 + 1")
    # sets that share half of their name (none in practice) keep all their columns
    asked = sets.groupBy("_one").agg(F.max(need).alias("_need"), F.count("*").alias("_sets"))
    of_set = Window.partitionBy("_one")
    ranked = shared.join(asked, "_one").withColumns({
        "_alone": F.col("_counted") - F.count(F.when(~F.col("_late"), 1)).over(of_set),
        "_rank": F.row_number().over(of_set.orderBy("_late", "_c", "_column"))})
    first = ranked.where("_late or _sets > 1 or _rank + _alone <= _need").select("_column", "_one")
    return stored(first.join(sets.select("_one", "_set", "_n", *BITS), "_one").drop("_one"), "jaccard-entries")


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """``_rid, <doc_id>, n_shingles, component_id, _root`` per row (``_root`` numbers the component; null without shingles); ``_rid`` numbers the rows of ``docs`` as ``with_row_id`` does."""
    src = with_row_id(docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")))
    rows, cells = described(src, size)
    name = ["_one", "_two", "_n"]
    sets = stored(rows.where("_n > 0").groupBy(*name).agg(F.min("_rid").alias("_set"), F.min("_id").alias("_least"), *(F.min(c).alias(c) for c in BITS)), "jaccard-sets")
    held = rows.where("_n > 0").count()
    often = cells.groupBy("_one").agg(F.sum("_n").alias("_n")).where(F.col("_n") * OFTEN >= held).select("_one")
    frequent = np.zeros(CELLS, bool)
    frequent[[r["_one"] for r in often.collect()]] = True  # numbers of cells, CELLS at most
    entries = entries_of(src, sets, frequent, percent, size)

    def texts_of(pairs: DataFrame) -> DataFrame:
        """The texts that stored pairs ask for, from one document of each set, stored as zstd."""
        asked = pairs.select(F.col("a").alias("_set")).union(pairs.select(F.col("b").alias("_set"))).distinct()
        asked = stored(asked.select(F.col("_set").alias("_rid")), "jaccard-asked")
        thin = src.select("_rid", "_text")
        small = asked.count() <= BROADCAST_ROWS  # of one number each; else the texts travel
        found = squeezed(thin.join(F.broadcast(asked), "_rid", "left_semi")) if small else squeezed(thin).join(asked, "_rid", "left_semi")
        return stored(found.select(F.col("_rid").alias("_set"), "_text"), "jaccard-texts")

    def checked(pairs: DataFrame, name: str) -> DataFrame:
        texts = texts_of(pairs)
        links = stored(verified(pairs, texts, percent, size), name)
        dropped(texts)
        return links

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each entry's row with the one of the ``REACH`` before it in its column that differs least; a column may run over partitions."""
        held = None
        for b in batches:
            now = [b.column(c).to_numpy(zero_copy_only=False) for c in ("_column", "_set", "_n", *BITS)]
            old = 0 if held is None else len(held[0])
            column, node, n, *bits = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            held = [x[-REACH:] for x in (column, node, n, *bits)]
            bits = np.stack(bits, axis=1)
            best, least = np.zeros(len(node), np.int64), np.full(len(node), np.inf)
            for step in range(1, REACH + 1):
                y = np.arange(max(old, step), len(node))
                y = y[(column[y] == column[y - step]) & (node[y] != node[y - step])]
                y = y[able(bits[y - step], bits[y], n[y - step], n[y], percent)]
                share = differences(bits[y - step], bits[y]) / (n[y - step] + n[y])
                nearer = share < least[y]
                best[y[nearer]], least[y[nearer]] = step, share[nearer]
            y = np.flatnonzero(best)
            x = y - best[y]
            yield pa.RecordBatch.from_arrays([pa.array(node[y]), pa.array(node[x]), pa.array(least[y])], ["a", "b", "_share"])

    # sizes that differ by a tenth or less mostly share a band; equal rows keep their order in every column
    ordered = ("_column", F.floor(F.ln("_n") * 10), F.xxhash64("_set"))
    chain = entries.repartitionByRange(*ordered).sortWithinPartitions(*ordered)

    # these two rounds only have to unite near copies; what they leave out, the last product finds
    def tried(near: DataFrame, name: str) -> DataFrame:
        """Links among the ``NEAREST`` likest of each row's pairs ``a, b, _share``."""
        likest = Window.partitionBy("a").orderBy("_share", "b")
        close = near.groupBy("a", "b").agg(F.min("_share").alias("_share")).withColumn("_rank", F.row_number().over(likest)).where(F.col("_rank") <= NEAREST)
        close = stored(close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-close")
        links = checked(close, f"{name}-links")
        dropped(close)
        return links

    def parts_of(roots: DataFrame) -> DataFrame:
        """Block pairs of the columns that hold several components, one column for all that the same rows hold."""
        labelled = entries.join(roots.withColumnRenamed("node", "_set"), "_set", "left").withColumn("_comp", F.coalesce("root", "_set")).drop("root")
        held = labelled.groupBy("_column").agg(F.count("*").alias("_m"), F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"), F.bit_xor(F.xxhash64("_set")).alias("_p"), F.bit_xor(F.xxhash64(F.lit(1), "_set")).alias("_q"))
        mixed = stored(held.where("_lo != _hi").groupBy("_m", "_p", "_q").agg(F.min("_column").alias("_column"), F.count("*").alias("_weight")).drop("_p", "_q"), "jaccard-columns")
        blocks = F.ceil(F.col("_m") / BLOCK).cast("int")
        parts = (labelled.join(mixed.select("_column", "_weight", blocks.alias("_blocks")), "_column")
                 .withColumn("_mine", F.pmod(F.xxhash64("_set"), F.col("_blocks")).cast("int"))
                 .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
                 .select("_column", F.least("_mine", "_other").alias("_r"), F.greatest("_mine", "_other").alias("_s"), "_mine", "_n", "_set", "_comp", "_weight", *BITS))
        return parts.repartition("_column", "_r", "_s").sortWithinPartitions("_column", "_r", "_s", "_n", "_set")

    def multiplied(likest: bool):
        """The product of each (column, block pair), gathered until it ends: pairs with the weight of their columns, or each row's likest with its share."""

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            names = ("_column", "_r", "_s", "_mine", "_n", "_set", "_comp", "_weight", *BITS)

            def answer(rows, cuts):
                _, r, s, mine, n, node, comp, weight, *bits = rows
                bits = np.stack(bits, axis=1)
                out, of = [], []
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    at = np.arange(lo, hi)
                    if r[lo] == s[lo] and likest:
                        found = [_pairs(node, n, comp, bits, at, at, percent, True)]
                    elif r[lo] == s[lo]:
                        found = [_pairs(node, n, comp, bits, at[k:k + 1], at[k + 1:], percent) for k in range(len(at) - 1)]
                    else:
                        found = [_pairs(node, n, comp, bits, at[mine[at] == r[lo]], at[mine[at] == s[lo]], percent, likest)]
                    out += found
                    of += [weight[lo]] * sum(len(x[0]) for x in found)
                a, b, share = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                times = np.array(of, np.int64)
                if len(a):
                    (a, b), first, of_pair = np.unique(np.stack([a, b]), axis=1, return_index=True, return_inverse=True)
                    times, share = np.bincount(of_pair.reshape(-1), weights=times, minlength=len(a)).astype(np.int64), share[first]
                return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(share if likest else times)], ["a", "b", "_share" if likest else "_common"])

            for b in batches:
                now = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
                held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
                new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0) | (np.diff(held[2]) != 0)) + 1
                if len(new):
                    yield answer(held, np.concatenate([[0], new]))
                    held = [x[new[-1]:] for x in held]
            if held is not None and len(held[0]):
                yield answer(held, np.array([0, len(held[0])]))

        return product

    first = tried(chain.mapInArrow(neighbours, "a long, b long, _share double"), "jaccard")
    roots = components(first, "jaccard-components")
    first = first.union(tried(parts_of(roots).mapInArrow(multiplied(True), "a long, b long, _share double"), "jaccard-other"))
    roots = components(first, "jaccard-components")
    counts = parts_of(roots).mapInArrow(multiplied(False), "a long, b long, _common long").groupBy("a", "b").agg(F.sum("_common").alias("_common"))
    sizes = sets.select("_set", "_n")
    sized = (counts.join(sizes.select(F.col("_set").alias("a"), F.col("_n").alias("_na")), "a")
             .join(sizes.select(F.col("_set").alias("b"), F.col("_n").alias("_nb")), "b"))
    # overlap <= common first columns + what the longer of the two rests holds
    rest = F.expr(f"({percent} * greatest(_na, _nb) + 99) div 100 - 1")
    enough = (100 + percent) * (F.col("_common") + rest) >= percent * (F.col("_na") + F.col("_nb"))
    left = stored(sized.where(enough).select("a", "b"), "jaccard-left")
    second = checked(left, "jaccard-more-links")
    roots = components(first.union(second), "jaccard-components")
    dropped(entries, left)

    # names are given to distinct sets, then to rows; stored, so that a hot component or set can be split in the joins
    rooted = sets.join(roots.withColumnRenamed("node", "_set"), "_set", "left").select(*name, "_least", F.coalesce("root", "_set").alias("_root"))
    least = stored(rooted.groupBy("_root").agg(F.min("_least").alias("_least")), "jaccard-names")
    named = stored(rooted.drop("_least").join(least, "_root"), "jaccard-named")
    out = rows.select("_rid", "_id", *name).join(named, name, "left")
    return out.select("_rid", F.col("_id").alias(doc_id), F.col("_n").alias("n_shingles"), F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_id")).alias("component_id"), "_root")


__all__ = ["shingle_sets", "prefix_length", "parities", "able", "described", "first_columns", "entries_of", "components", "verified", "cluster", "PERCENT", "SHINGLE"]
