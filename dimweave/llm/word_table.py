"""BPE encoding and decoding by a distinct-word table.

Texts are cut at the vocabulary's literal added tokens and split into words by
its pattern: pieces whose ids do not depend on what surrounds them.  A run of
documents with about ``BLOCK`` characters becomes a block: its distinct words,
and for each place the number of its word.  The words of all blocks are dealt
by hash into ``PARTS`` parts of one table of distinct words, and each is encoded
once.  The ids return in two joins, by word to the blocks that hold it, then
by block to the places, where a word's number becomes its ids.  Decoding joins
the ids' places with the vocabulary's id-to-piece table (broadcast: a row per entry
of the vocabulary, whatever the data); bytes that are no UTF-8 become U+FFFD.

Between tasks travel a block's distinct words and their ids, a packed row per
block and part; a block's places, a small number per word of text, stay where
they were stored, in buckets by block. No row is made per occurrence.  A word's group has one entry per block at most, so none grows
when one document, or one word, makes up a third of the corpus.  A document is
never cut: a longer one is a block of its own.

Defined results: null and empty texts have no ids and decode to the empty
text, as do null and empty lists of ids; repeated rows are handled each; an
empty table gives an empty result; columns that are carried along may have any
names but ``ids`` and ``text``.  A null or negative id, or one that the
vocabulary lacks, fails the run.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import bucketed

#: Characters (or ids) of a block, but for a last whole document.
BLOCK = 1 << 23
#: Characters that are split, and places that are filled, at once.
PORTION = 1 << 19
#: Parts of the table of distinct words; one task holds one part at a time.
PARTS = 1024
#: A place where no word of the pattern goes through: white space after something else.
_GAP = regex.compile(r"(?<=\S)\s")


class Vocabulary:
    """A byte-level BPE vocabulary file of ``tokenizers`` and the pattern that splits its words.

    No match of the pattern may hold white space after another character.
    """

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, pattern
        with open(path, encoding="utf-8") as f:
            loaded = json.load(f)
        self.added = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self._ids = loaded["model"]["vocab"]

    def _library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def splitter(self) -> Callable[[str], list[str]]:
        """Splits a text into words; a literal added token is a word of its own.

        The pattern's module knows letters and digits of a later Unicode than
        ``tokenizers``; a text with a sign that Python's own, older table has not
        assigned is split by the library.
        """
        find = regex.compile(self.pattern).findall
        longest = sorted(self.added, key=len, reverse=True)
        cuts = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        newer = np.zeros(0x110000, bool)
        signs = regex.findall(r"[\p{L}\p{N}\s]", "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000)))))
        newer[[ord(c) for c in signs if unicodedata.category(c) == "Cn"]] = True
        slow = None  # the library takes room; few texts ask for it

        def plain(text: str) -> list[str]:
            nonlocal slow
            if text.isascii() or not newer[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")].any():
                return find(text)
            slow = slow or self._library().pre_tokenizer.pre_tokenize_str
            return [text[i:j] for _, (i, j) in slow(text)]

        def split(text: str) -> list[str]:
            if cuts is None or not cuts.search(text):
                return plain(text)
            return [w for k, part in enumerate(cuts.split(text)) for w in ([part] if k % 2 else plain(part))]

        return split

    def encoder(self) -> Callable[[list[str]], list[list[int]]]:
        """The ids of each word by itself."""
        encode = self._library().encode_batch
        return lambda words: [e.ids for e in encode(words, add_special_tokens=False)]

    def pieces(self) -> list[bytes | None]:
        """The bytes of every id; none for numbers that are no id.

        The file writes a byte as a printable sign: those of Latin-1 as
        themselves, the others in order as the code points from 256 on.
        """
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte = {chr(b): b for b in own}
        byte |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
        held = {i: bytes(byte[sign] for sign in piece) for piece, i in self._ids.items()}
        held |= {i: piece.encode() for piece, i in self.added.items()}
        return [held.get(i) for i in range(max(held) + 1)]


def _portions(text: str, size: int) -> Iterator[str]:
    """``text`` in portions of about ``size`` characters that split into words alike."""
    at = 0
    while len(text) - at > size and (gap := _GAP.search(text, at + size)):
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:]


def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as zstd, their low bytes first, then the next ones."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class _Block:
    """Documents being gathered; a place holds a number, by ``number`` or as given."""

    def __init__(self):
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.keys, self.codes, self.bounds, self.filled = [], [np.zeros(0, np.uint32)], [0], 0

    def add(self, parts: Iterator[list]) -> None:
        """Appends a document, given in lists of words or of ids."""
        end = self.bounds[-1]
        for part in parts:
            words = part and isinstance(part[0], str)
            self.codes.append(np.fromiter(map(self.number.__getitem__, part) if words else part, np.uint32, len(part)))
            end += len(part)
        self.bounds.append(end)

    def rows(self, block: int) -> pa.RecordBatch:
        """The row of the block, then one per part with its words in the order of their numbers."""
        flat, words = np.concatenate(self.codes), list(self.number)
        keys = pa.concat_arrays(self.keys)
        part, lists = np.zeros(0, np.uint32), []
        if words:
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")  # the commonest get the small numbers
            new = np.empty(len(order), np.uint32)
            new[order] = np.arange(len(order), dtype=np.uint32)
            flat = new[flat]
            raw = [words[k].encode() for k in order.tolist()]
            part = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % PARTS
            by_part = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[by_part])) + 1
            lists = [[raw[k] for k in x] for x in np.split(by_part, cuts)]
        n = len(lists) + 1
        squeeze = zstandard.ZstdCompressor(level=3).compress
        nulls = lambda kind: pa.nulls(n - 1, kind)
        of_block = lambda value: pa.concat_arrays([value, nulls(value.type)])
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array([-1, *(zlib.crc32(x[0]) % PARTS for x in lists)], pa.int32()),
             of_block(pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)), of_block(pa.array([self.bounds], pa.list_(pa.int64()))),
             of_block(pa.array([_squeezed(flat)], pa.binary())), pa.array([_squeezed(part), *(_squeezed(np.array([len(w) for w in x])) for x in lists)], pa.binary()),
             pa.array([None, *(squeeze(b"".join(x)) for x in lists)], pa.binary())],
            ["_block", "_part", "_keys", "_bounds", "_codes", "_sizes", "_words"])


def _blocks(rows: DataFrame, value: Column, keep: list[str], reader: Callable, size: int, name: str) -> DataFrame:
    """The stored blocks of a table.

    A block's own row (``_part`` -1) has the kept columns of its documents as ``_keys``,
    where each begins and the last one ends among the places (``_bounds``), the
    places' numbers (``_codes``), and for each number its word's part (``_sizes``).  Its
    other rows have a part's words in the order of their numbers: their lengths (``_sizes``)
    and bytes (``_words``).  ``reader()`` makes a function from a value to its size and lists.
    """
    kinds = dict(rows.dtypes)
    key = F.struct(F.lit(0).alias("k"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))  # the kept columns may have any names
    shape = "struct<" + ", ".join(["k: int", *(f"k{i}: {kinds[c]}" for i, c in enumerate(keep))]) + ">"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, block, done = reader(), None, TaskContext.get().partitionId() << 32
        for b in batches:
            keys, values, begin = b.column("_key"), b.column("_value"), 0
            for i in range(b.num_rows):
                block = block or _Block()
                filled, parts = read(values[i].as_py())
                block.add(parts)
                block.filled += filled + 1
                if block.filled >= size:
                    block.keys.append(keys.slice(begin, i + 1 - begin))
                    yield block.rows(done)
                    begin, block, done = i + 1, None, done + 1
            if block:
                block.keys.append(keys.slice(begin))
        if block:
            yield block.rows(done)

    source = rows.select(key.alias("_key"), value.alias("_value"))
    return bucketed(source.mapInArrow(run, f"_block long, _part int, _keys array<{shape}>, _bounds array<long>, _codes binary, _sizes binary, _words binary"), name, "_block")


def text_blocks(docs: DataFrame, text: str, keep: list[str], vocabulary: Vocabulary, size: int = BLOCK) -> DataFrame:
    """Stored blocks of texts; the numbers stand for words."""

    def reader():
        split = vocabulary.splitter()
        return lambda text: (len(text or ""), map(split, _portions(text or "", PORTION)))

    return _blocks(docs, F.col(text).cast("string"), keep, reader, size, "words-blocks")


def id_blocks(rows: DataFrame, ids: str, keep: list[str], size: int = BLOCK) -> DataFrame:
    """Stored blocks of token ids; the numbers are the ids."""
    return _blocks(rows, F.col(ids).cast("array<int>"), keep, lambda: lambda ids: (len(ids or ()), [ids or []]), size, "ids-blocks")


def encoded_words(blocks: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``_block, _part, _sizes, _ids``: for every part of a block, how many ids each word has, and the ids.  Each distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, expand = vocabulary.encoder(), zstandard.ZstdDecompressor().decompress
        now, known = None, {}
        for b in batches:
            sizes, ids = [], []
            for part, lengths, words in zip(b.column("_part").to_pylist(), b.column("_sizes").to_pylist(), b.column("_words").to_pylist()):
                if part != now:
                    now, known = part, {}
                ends, raw = np.cumsum(_numbers(lengths)).tolist(), expand(words)
                listed = [raw[i:j] for i, j in zip([0, *ends], ends)]
                new = [w for w in listed if w not in known]
                known.update(zip(new, encode([w.decode() for w in new])))
                found = [known[w] for w in listed]
                sizes.append(_squeezed(np.fromiter(map(len, found), np.uint32, len(found))))
                ids.append(_squeezed(np.fromiter((i for f in found for i in f), np.uint32)))
            yield pa.RecordBatch.from_arrays([b.column("_block"), b.column("_part"), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], ["_block", "_part", "_sizes", "_ids"])

    parts = blocks.where("_part >= 0").select("_block", "_part", "_sizes", "_words").repartition("_part").sortWithinPartitions("_part")
    return parts.mapInArrow(run, "_block long, _part int, _sizes binary, _ids binary")


def _placed(codes: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, first: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values in place of the codes, and the documents' bounds among them; code ``c`` has ``sizes[c]`` values from ``first[c]`` on."""
    out = [flat[:0]]
    for k in range(0, len(codes), PORTION):
        part = codes[k:k + PORTION]
        many = sizes[part]
        last = np.cumsum(many)
        out.append(flat[np.repeat(first[part] - (last - many), many) + np.arange(last[-1])])
    return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes[codes])])[bounds]


def _words_of(part: np.ndarray, lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(sizes, first, flat)`` of a block's words, from the parts of its numbers and the parts' ids."""
    sizes, flat = np.zeros(len(part), np.int64), [np.zeros(0, np.uint32)]
    by_part = np.argsort(part, kind="stable")
    begin = dict(zip(*np.unique(part[by_part], return_index=True)))
    order = []
    for p, n, ids in sorted(lists):
        n = _numbers(n)
        at = by_part[begin[p]:begin[p] + len(n)]
        sizes[at] = n
        order.append(at)
        flat.append(_numbers(ids))
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    if len(order) != len(part):
        raise ValueError("a word of a block has no ids")
    first = np.zeros(len(part), np.int64)
    first[order] = np.cumsum(sizes[order]) - sizes[order]
    return sizes, first, np.concatenate(flat)


def placed(blocks: DataFrame, keep: list[str], ids: DataFrame | None, vocabulary: Vocabulary | None) -> DataFrame:
    """A row per document: the kept columns, ``ids`` if the words' ids are given, ``text`` decoded from the ids if the vocabulary is given."""
    whole = blocks.where("_part < 0").select("_block", "_keys", "_bounds", "_codes", "_sizes")
    inside = blocks.schema["_keys"].dataType.elementType
    coded = ids is not None
    if coded:
        lists = ids.groupBy("_block").agg(F.collect_list(F.struct("_part", F.col("_sizes").alias("_n"), "_ids")).alias("_lists"))  # PARTS at most
        whole = whole.join(lists.hint("merge"), "_block", "left")  # none: the block has no words
    table = blocks.sparkSession.sparkContext.broadcast(vocabulary.pieces()) if vocabulary else None
    names = [n for n, t in (("ids", ids), ("text", table)) if t is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                keys = b.column("_keys")[k].values
                bounds = b.column("_bounds")[k].values.to_numpy(zero_copy_only=False)
                now = _numbers(b.column("_codes")[k].as_py())
                if coded:
                    lists = [(x["_part"], x["_n"], x["_ids"]) for x in b.column("_lists")[k].as_py() or ()]
                    now, bounds = _placed(now, bounds, *_words_of(_numbers(b.column("_sizes")[k].as_py()), lists))
                at = 0
                while at < len(bounds) - 1:  # some documents at a time
                    until = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PORTION, side="right")) - 1)
                    part, ends, out = now[bounds[at]:bounds[until]], bounds[at:until + 1] - bounds[at], []
                    if coded:
                        out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(part.astype(np.int32))))
                    if table is not None:
                        piece, ends = table.value.__getitem__, ends.tolist()
                        texts = [b"".join(map(piece, part[i:j].tolist())).decode("utf-8", "replace") for i, j in zip(ends, ends[1:])]
                        out.append(pa.array(texts, pa.string()))
                    yield pa.RecordBatch.from_arrays([*(keys.field(i + 1).slice(at, until - at) for i in range(len(inside) - 1)), *out], [*(f"k{i}" for i in range(len(inside) - 1)), *names])
                    at = until

    shape = [f"{f.name} {f.dataType.simpleString()}" for f in inside[1:]] + [{"ids": "ids array<int>", "text": "text string"}[n] for n in names]
    return whole.mapInArrow(run, ", ".join(shape)).toDF(*keep, *names)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | tuple = ("doc_id",)) -> DataFrame:
    """The kept columns and ``ids`` of every row."""
    blocks = text_blocks(docs, text, list(keep), vocabulary)
    return placed(blocks, list(keep), encoded_words(blocks, vocabulary), None)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", keep: list[str] | tuple = ("doc_id",)) -> DataFrame:
    """The kept columns and the ``text`` of every row's ids."""
    return placed(id_blocks(rows, ids, list(keep)), list(keep), None, vocabulary)


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | tuple = ("doc_id",)) -> DataFrame:
    """The kept columns, ``ids``, and ``text`` decoded from them, in one pass over the blocks."""
    blocks = text_blocks(docs, text, list(keep), vocabulary)
    return placed(blocks, list(keep), encoded_words(blocks, vocabulary), vocabulary)


__all__ = ["Vocabulary", "text_blocks", "id_blocks", "encoded_words", "placed", "encode", "decode", "encode_and_decode"]
