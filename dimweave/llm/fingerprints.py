"""Document fingerprints by winnowing, in DataFrame functions only.

A text is cut into tokens: words, and long words into runs of ``TOKEN`` signs.
Every ``GRAM`` consecutive tokens have a rolling hash; of every ``WINDOW`` consecutive
hashes the smallest is chosen, the rightmost on ties.  The chosen hashes with
their positions are the fingerprint, so texts that share
``WINDOW + GRAM - 1`` tokens in a row share a hash.

A hash and its place share one number: 40 bits of hash above 23 bits that fall
with the place, so the minimum of a window is its rightmost smallest hash.

Defined results: a null text is empty; a text without words has an empty
fingerprint; one shorter than a gram or a window has a single hash; two empty
fingerprints are alike (1.0); equal ids are ordered by content, null ids come last;
a repeated row follows its equal; the next of a lone document is itself; an
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

TOKEN = 8
GRAM = 3
WINDOW = 8
PLACE = 23
#: Documents of a neighbourhood slice, and slices at most.
SLICE, SLICES = 2000, 4096


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the chosen numbers (hash and place) of ``text`` in reading order.

    Each step is a column of its own that the next refers to more than once,
    so it is computed once per row.
    """
    tokens, grams, low = f"{out}_t", f"{out}_g", f"{out}_m"
    n = F.size(tokens)
    df = df.withColumn(tokens, F.regexp_extract_all(F.col(text), F.lit(f"[^\\x20\\x09-\\x0D]{{1,{TOKEN}}}"), F.lit(0)))

    def packed(h: Column, place: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(h, 24), PLACE) + (F.lit((1 << PLACE) - 1) - place % (1 << PLACE))

    rolling = F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: packed(F.xxhash64(*[F.get(tokens, i + k) for k in range(GRAM)]), i))
    alone = F.array(packed(F.xxhash64(F.array_join(tokens, "\n")), F.lit(0)))
    df = df.withColumn(grams, F.when(n >= GRAM, rolling).when(n > 0, alone).otherwise(F.array().cast("array<bigint>"))).drop(tokens)
    reach, source = 1, grams
    while reach < WINDOW:  # minima over runs of 1, 2, 4, ... hashes
        name = f"{low}{reach}"
        df = df.withColumn(name, F.zip_with(F.col(source), F.slice(F.col(source), F.lit(1 + reach), F.greatest(F.size(source), F.lit(0))), lambda a, b: F.least(a, b)))
        df = df if source == grams else df.drop(source)
        reach, source = 2 * reach, name
    windows = F.greatest(F.size(grams) - WINDOW + 1, F.least(F.size(grams), F.lit(1)))
    df = df.withColumn(out, F.array_distinct(F.slice(F.col(source), F.lit(1), windows)))
    return df.drop(source, grams)


def hashes(chosen: str) -> Column:
    return F.transform(F.col(chosen), lambda x: F.shiftright(x, PLACE))


def positions(chosen: str) -> Column:
    """Places (token numbers, modulo 2^23) of the chosen grams."""
    return F.transform(F.col(chosen), lambda x: F.lit((1 << PLACE) - 1) - x.bitwiseAND(F.lit((1 << PLACE) - 1)))


def as_text(chosen: str) -> Column:
    """``hash@place`` items in reading order."""
    mask = F.lit((1 << PLACE) - 1)
    return F.array_join(F.transform(F.col(chosen), lambda x: F.concat(F.lower(F.hex(F.shiftright(x, PLACE))), F.lit("@"), (mask - x.bitwiseAND(mask)).cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Share of the distinct hashes that two fingerprints have in common, from columns of hashes."""
    common = F.size(F.array_intersect(F.col(a), F.col(b)))
    either = F.size(F.array_distinct(F.col(a))) + F.size(F.array_distinct(F.col(b))) - common
    return F.when(either > 0, common / either).otherwise(F.lit(1.0))


def with_next(df: DataFrame, doc_id: str, tie: str, carry: list[str]) -> DataFrame:
    """Adds ``_next_<c>`` of the row that follows by descending id; the first row follows the last.

    Ids are cut at quantiles into slices; a slice is ordered by itself, and
    the first row of each is also sent, as a ghost, to the end of the slice before it.
    The quantiles (at most ``SLICES``) are all that reaches the driver.
    """
    count = df.select(F.count("*")).first()[0]
    parts = max(1, min(SLICES, -(-count // SLICE)))
    cuts = df.agg(F.percentile_approx(doc_id, [k / parts for k in range(1, parts)], 10 * SLICES)).first()[0] if parts > 1 else []
    borders = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]) if cuts else None
    slice_of = F.size(F.filter(borders, lambda c: c < F.col(doc_id))) if borders is not None else F.lit(0)
    rows = df.withColumn("_slice", slice_of)
    # one row per slice
    tops = rows.groupBy("_slice").agg(F.max(F.struct(doc_id, tie)).alias("_top"))
    tops = tops.withColumn("_ghost", F.coalesce(F.lead("_slice").over(W.orderBy("_slice")), F.min("_slice").over(W.partitionBy())))
    is_top = F.struct(doc_id, tie).eqNullSafe(F.col("_top"))
    sent = (rows.join(F.broadcast(tops), "_slice")
            .withColumn("_to", F.explode(F.when(is_top, F.array(F.struct(F.col("_slice").alias("s"), F.lit(False).alias("g")), F.struct(F.col("_ghost").alias("s"), F.lit(True).alias("g"))))
                                         .otherwise(F.array(F.struct(F.col("_slice").alias("s"), F.lit(False).alias("g"))))))
            .select(*df.columns, F.col("_to.s").alias("_slice"), F.col("_to.g").alias("_is_ghost")))
    order = W.partitionBy("_slice").orderBy("_is_ghost", F.col(doc_id).desc_nulls_last(), F.col(tie).desc())
    return sent.withColumns({f"_next_{c}": F.lead(c).over(order) for c in carry}).where(~F.col("_is_ghost")).drop("_slice", "_is_ghost")


def compare_with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last third (code points, rounded down) replaced by
    the beginning of the next document by descending id.
    """
    src = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    src = src.withColumn("_tie", F.xxhash64("_text"))
    printed = with_fingerprint(src, "_text", "_fp")
    rows = with_next(printed, "_id", "_tie", ["_text", "_fp"])
    rows = rows.withColumns({"_n": F.char_length("_text")})
    third = F.floor(F.col("_n") / 3).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), F.col("_n") - third), F.substring("_next__text", F.lit(1), third)))
    rows = rows.select("_id", "_n", F.sha2("_edited", 256).alias("_sha"), "_edited", "_fp", "_next__fp")
    rows = with_fingerprint(rows, "_edited", "_efp").drop("_edited")
    rows = rows.withColumns({"_own": hashes("_fp"), "_other": hashes("_efp"), "_next": hashes("_next__fp")})
    return rows.select(F.col("_id").alias(doc_id), F.col("_n").cast("long").alias("n_chars"), F.col("_sha").alias("edited_sha256"), as_text("_fp").alias("fingerprint"),
                       as_text("_efp").alias("edited_fingerprint"), likeness("_own", "_other").alias("near_edited"), likeness("_own", "_next").alias("near_next"))


__all__ = ["with_fingerprint", "hashes", "positions", "as_text", "likeness", "with_next", "compare_with_edits", "TOKEN", "GRAM", "WINDOW"]
