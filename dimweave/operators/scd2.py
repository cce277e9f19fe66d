"""SCD type 2 dimension maintenance.

``apply_batch``   checksum-aware apply with soft delete and reactivation.
``rebuild_chain`` plain chain rebuild of the touched keys (no delete, no checksum).
``as_of`` / ``current`` point-in-time and current reads.

Physical shape of ``apply_batch``: the batch is reduced to its distinct keys
(broadcast behind a size check) and to a one-row bounds relation; dimension
rows of keys the batch does not touch only get their delete flag recomputed
against the bounds (no shuffle).  Touched rows and batch rows are unioned and
hash-partitioned once on (key, day of start); every window afterwards
partitions by a superset of that, and the per-key chains are stitched across
days from a small summary, so a hot key is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..schemas import DIM_COLUMNS, KEY, LEGACY_DIM_COLUMNS, reject_null_keys
from .chains import chain_links, time_bucket
from .dedupe import asc, keep_first
from .joins import DEFAULT_BROADCAST_ROWS, broadcast_if_small, split_by_keys

VF, VT, EX = "valid_from_ts", "valid_to_ts", "extract_ts"


def add_checksum(df: DataFrame, blob: str = "media_blob", out: str = "checksum") -> DataFrame:
    """md5 of the raw payload text: whitespace and key order count."""
    return df.withColumn(out, F.md5(F.col(blob)))


def dedupe_batch(batch: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Checksum each batch row, keep the earliest extract per (key, checksum, start)."""
    b = add_checksum(batch)
    return keep_first(b, [*key, "checksum", VF], [EX, "media_blob", "media_duration"])


def batch_bounds(batch: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row: min/max start and max extract of the de-duplicated batch (nulls when empty).

    De-duplication keeps the earliest extract per (key, checksum, start), so
    the max extract is the max over those groups of their min extract: a
    two-level aggregate with map-side partial aggregation, never a row-level
    window.
    """
    per = (add_checksum(batch).groupBy(*key, "checksum", VF)
           .agg(F.min(EX).alias(EX)))
    return per.agg(F.min(VF).alias("min_src_ts"), F.max(VF).alias("max_src_ts"),
                   F.max(EX).alias("max_extract_ts"))


def _in_window(matched):
    vf = F.col(VF)
    return (~matched) & vf.between(F.col("min_src_ts"), F.col("max_src_ts"))


def _flag_untouched(rows: DataFrame, matched) -> DataFrame:
    """Delete flag for dimension rows whose key is absent from the batch.

    A version that starts inside the batch's [min, max] start range was not
    re-sent, so it is marked deleted (and closed at the batch's max extract
    when open); outside the range the flag is cleared.
    """
    inw = _in_window(matched)
    return rows.withColumns({
        VT: F.when(inw & F.col(VT).isNull(), F.col("max_extract_ts")).otherwise(F.col(VT)),
        "is_current": F.when(inw & F.col("is_current"), F.lit(False)).otherwise(F.col("is_current")),
        "is_deleted": F.when(inw, F.lit(True)).otherwise(F.lit(False)),
    })


# Order of stored rows that share (key, checksum, start), and of batch rows.
_TIE = [EX, "seen_count", VT, "media_blob", "media_duration", "is_current", "is_deleted"]
_BATCH_TIE = [EX, "media_blob", "media_duration"]


def _ordered(cols: Sequence[str]):
    """A struct that compares as ``cols`` ascending, nulls last; value ``i`` is its field ``v<i>``."""
    return F.struct(*[x for i, c in enumerate(cols) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def _apply_union(dim: DataFrame, batch: DataFrame, key: Sequence[str], parts: int | None,
                 bounds: DataFrame | None, bucket_unit: str) -> DataFrame:
    """Exact apply over the union of dimension rows and raw batch rows.

    ``dim`` carries ``_key_in_batch``; ``bounds`` is needed only if that can be
    false.  Rows are hash-partitioned once on (key, day of start) and sorted twice.
    One aggregate per version (key, checksum, start) gathers both sides, its
    first stored row (alone and live before deleted) and its first batch row, and
    tells what becomes of them:

    * a live stored row that the batch re-sends stays, and the version has no other row;
    * otherwise the stored row and the batch row, as far as there are any,
      enter the key's chain, and the one extracted first is the version's row;
    * stored rows of a key that the batch lacks stay, with a new delete flag.

    Chains are stitched across days by a summary of one row per (key, day),
    counted from flags alone, so a key holding a large share of the
    rows is still spread over many tasks.
    """
    key = list(key)
    version = [*key, "_bk", "checksum", VF]
    d = dim.select(*DIM_COLUMNS, "_key_in_batch", F.lit(False).alias("_b"))
    s = add_checksum(batch).select(
        *key, F.col("media_duration").cast("int").alias("media_duration"), "media_blob",
        F.lit(None).cast("bigint").alias("seen_count"), VF,
        F.lit(None).cast("timestamp_ntz").alias(VT), F.lit(False).alias("is_deleted"),
        F.lit(None).cast("boolean").alias("is_current"), EX, "checksum",
        F.lit(True).alias("_key_in_batch"), F.lit(True).alias("_b"))
    u = d.unionByName(s).withColumn("_bk", time_bucket(VF, bucket_unit))
    u = u.repartition(parts, *key, "_bk") if parts else u.repartition(*key, "_bk")

    stored, dead = ~F.col("_b"), F.coalesce(F.col("is_deleted"), F.lit(False))
    comparable = F.col("checksum").isNotNull() & F.col(VF).isNotNull()
    tie = _ordered(_TIE)
    groups = u.groupBy(*version).agg(
        F.min(F.when(stored, tie)).alias("_any"), F.min(F.when(stored, F.struct(dead.alias("dead"), tie.alias("row")))).alias("_own"),
        F.min(F.when(F.col("_b"), _ordered(_BATCH_TIE))).alias("_new"), F.max("_key_in_batch").alias("_in_batch"))
    sent = comparable & F.col("_new").isNotNull()
    stays = F.coalesce(~F.col("_in_batch") | (sent & ~F.col("_own.dead")), F.lit(False))
    own = F.when(F.col("_in_batch") & sent, F.col("_own.row")).otherwise(F.col("_any"))

    def stored_row(keep):
        return F.struct(*[own[f"v{i}"].alias(c) for i, c in enumerate(_TIE)], F.lit(False).alias("_b"), keep.alias("_keep"))

    kinds = dict(u.dtypes)
    from_batch = {c: F.col(f"_new.v{i}") for i, c in enumerate(_BATCH_TIE)}
    constant = {"is_deleted": F.lit(False)}
    batch_row = F.struct(*[from_batch.get(c, constant.get(c, F.lit(None).cast(kinds[c]))).alias(c) for c in _TIE],
                         F.lit(True).alias("_b"), F.lit(True).alias("_keep"))
    # of two rows the one extracted first is kept (the stored one if at once)
    earlier = F.struct(own["n0"], own["v0"]) <= F.struct(F.col("_new.n0"), F.col("_new.v0"))
    both = F.array(stored_row(earlier), batch_row.withField("_keep", ~earlier))
    none_stored = F.col("_any").isNull()
    emitted = (F.when(stays | F.col("_new").isNull(), F.array(stored_row(F.lit(True))))
                .when(none_stored, F.array(batch_row)).otherwise(both))
    rows = groups.select(*version, stays.alias("_retained"), "_in_batch", F.explode(emitted).alias("_row"))
    rows = rows.select(*version, "_retained", "_in_batch", *[F.col(f"_row.{c}").alias(c) for c in [*_TIE, "_b", "_keep"]])
    if bounds is not None:
        rows = _flag_untouched_where(rows.crossJoin(bounds), ~F.col("_in_batch"))

    # the chain rows of a (key, day), from flags alone: no payload, no sort
    flags = u.groupBy(*version).agg(F.max("_b").alias("_new"), F.max(stored).alias("_old"), F.max(stored & ~dead).alias("_live"),
                                    F.max("_key_in_batch").alias("_in_batch"))
    n = F.when(~F.col("_in_batch") | (comparable & F.col("_new") & F.col("_live")), 0).otherwise(F.col("_new").cast("int") + F.col("_old").cast("int"))
    summary = flags.withColumn("_c", n).groupBy(*key, "_bk").agg(F.sum("_c").alias("_n"), F.min(F.when(F.col("_c") > 0, F.col(VF))).alias("_first"))

    chain = ~F.col("_retained")
    rows = chain_links(rows, key, [VF, EX, "checksum", "_b"], VF, "_bk", include=chain, partitioned=True, summary=summary)
    rows = rows.withColumn("_in", chain)  # the chain's own partitions, so its sort serves again
    rows = rows.select("*", F.max(EX).over(W.partitionBy(*key, "_bk", "_in", VF)).alias("_max_extract")).where("_keep")
    return rows.select(
        *key, "media_duration", "media_blob",
        F.when(chain, F.col("_seen")).otherwise(F.col("seen_count")).alias("seen_count"),
        VF,
        F.when(chain, F.col("_next")).otherwise(F.col(VT)).alias(VT),
        F.when(chain, F.lit(False)).otherwise(F.col("is_deleted")).alias("is_deleted"),
        F.when(chain, F.col("_next").isNull()).otherwise(F.col("is_current")).alias("is_current"),
        F.when(chain, F.col("_max_extract")).otherwise(F.col(EX)).alias(EX),
        "checksum")


def _flag_untouched_where(rows: DataFrame, where) -> DataFrame:
    """``_flag_untouched`` applied only to rows satisfying ``where``, none of which the batch re-sends."""
    inw = where & _in_window(F.lit(False))
    return rows.withColumns({
        VT: F.when(inw & F.col(VT).isNull(), F.col("max_extract_ts")).otherwise(F.col(VT)),
        "is_current": F.when(inw & F.col("is_current"), F.lit(False)).otherwise(F.col("is_current")),
        "is_deleted": F.when(where, F.when(inw, F.lit(True)).otherwise(F.lit(False)))
                       .otherwise(F.col("is_deleted")),
    })


def apply_batch(dim: DataFrame, batch: DataFrame, key: Sequence[str] = KEY, *,
                dim_is_versioned: bool = True, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                parts: int | None = None, bucket_unit: str = "day",
                batch_rows: int | None = None) -> DataFrame:
    """Apply a source batch to a type 2 dimension (checksum, soft delete, reactivation).

    ``dim`` has the columns of ``schemas.DIM_SCHEMA``; ``batch`` has
    ``author_id, media_id, media_duration, media_blob, valid_from_ts,
    extract_ts`` (a ``checksum`` column in it is ignored and recomputed).

    Per row of the result:
      * dimension rows whose (key, checksum, start) is in the batch and that
        are not deleted stay as they are; their batch copies are dropped;
      * dimension rows of keys absent from the batch keep their interval but
        are flagged deleted when their start lies in the batch's start range;
      * all other dimension rows of touched keys, and the remaining batch
        rows, form new chains per key: ordinal, next start as end, current
        when open.

    ``dim_is_versioned`` states the invariant every dimension written by this
    library has: at most one row per (key, checksum, start).  Rows of keys the
    batch does not touch are then neither shuffled nor re-de-duplicated:
    they meet the batch's distinct keys in a broadcast anti join (behind a
    row-count check; a shuffle join beyond it).  With ``False`` every row
    goes through the shuffle and duplicates are collapsed as well.
    ``bucket_unit`` is the time slice that spreads one key over tasks.
    ``batch_rows`` (a known row count of the batch) bounds the number of
    keys, so the size check needs no job.
    """
    key = list(key)
    dim = reject_null_keys(conform_dim_like(dim), key)
    batch = reject_null_keys(batch, key)
    if not dim_is_versioned:
        bounds = F.broadcast(batch_bounds(batch, key))
        keys = broadcast_if_small(batch.select(*key).distinct(), broadcast_rows, known_max=batch_rows)
        flagged = (dim.join(keys.withColumn("_key_in_batch", F.lit(True)), on=key, how="left")
                      .withColumn("_key_in_batch", F.coalesce(F.col("_key_in_batch"), F.lit(False))))
        return _apply_union(flagged, batch, key, parts, bounds, bucket_unit)
    kept, chained, _ = apply_parts(dim, batch, key, broadcast_rows=broadcast_rows, parts=parts, bucket_unit=bucket_unit, batch_rows=batch_rows)
    return kept.select(*DIM_COLUMNS).unionByName(chained)


def apply_parts(dim: DataFrame, batch: DataFrame, key: Sequence[str] = KEY, *, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                parts: int | None = None, bucket_unit: str = "day",
                batch_rows: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``apply_batch`` of a versioned dimension (without null keys) in its parts.

    ``(kept, chained, touched)``: the rows of keys the batch lacks with their
    new flags and ``_changed`` (whether a flag or an end differs from what is stored), the
    rows of the batch's keys as they become, and as they are stored.
    """
    key = list(key)
    bounds = F.broadcast(batch_bounds(batch, key))
    keys = broadcast_if_small(batch.select(*key).distinct(), broadcast_rows, known_max=batch_rows)
    touched, untouched = split_by_keys(dim, keys, key)
    chained = _apply_union(touched.withColumn("_key_in_batch", F.lit(True)), batch, key, parts, None, bucket_unit)
    before = F.struct("is_deleted", "is_current", VT)
    kept = _flag_untouched(untouched.withColumn("_before", before).crossJoin(bounds), F.lit(False))
    return kept.select(*DIM_COLUMNS, (~before.eqNullSafe(F.col("_before"))).alias("_changed")), chained, touched


def conform_dim_like(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    out = df
    if "checksum" not in cols:
        out = add_checksum(out)
    if "is_deleted" not in cols:
        out = out.withColumn("is_deleted", F.lit(False))
    return out.select(*[F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in
                        zip(DIM_COLUMNS, [None, None, "int", None, "bigint"] + [None] * 6)])


def rebuild_chain(dim: DataFrame, batch: DataFrame, key: Sequence[str] = KEY, *,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS, bucket_unit: str = "day") -> DataFrame:
    """Recalculate the whole chain of every key present in the batch.

    Stored versions of the touched keys and the batch rows are unioned
    (distinct), then numbered and linked by start time per key; other keys
    are kept unchanged.  Output has the columns of ``LEGACY_DIM_COLUMNS``.
    Ties on the start are broken by extract time, then payload.  Null keys
    are rejected.  One shuffle on (key, day of start) serves the distinct and
    the chain, which is stitched across days (hot keys stay parallel).
    """
    key = list(key)
    cols = ["author_id", "media_id", "media_duration", "media_blob", VF, EX]
    dim = reject_null_keys(dim, key).withColumn("media_duration", F.col("media_duration").cast("int"))
    b = reject_null_keys(batch, key).withColumn("media_duration", F.col("media_duration").cast("int")).select(*cols)
    keys = broadcast_if_small(b.select(*key).distinct(), broadcast_rows)
    touched, kept = split_by_keys(dim, keys, key)
    touched = touched.select(*cols)
    combined = touched.unionByName(b).withColumn("_bk", time_bucket(VF, bucket_unit))
    combined = combined.repartition(*key, "_bk").distinct()
    chain = chain_links(combined, key, [VF, EX, "media_blob", "media_duration"], VF, "_bk",
                        seen="seen_count", nxt=VT, partitioned=True)
    chain = chain.withColumn("is_current", F.col(VT).isNull())
    kept = kept.withColumn("seen_count", F.col("seen_count").cast("bigint"))
    return kept.select(*LEGACY_DIM_COLUMNS).unionByName(chain.select(*LEGACY_DIM_COLUMNS))


def replace_keys(target: DataFrame, rows: DataFrame, key: Sequence[str] = KEY, *,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Delete every target row whose key occurs in ``rows``, then insert ``rows`` by name."""
    key = list(key)
    keys = broadcast_if_small(rows.select(*key).distinct(), broadcast_rows)
    kept = target.join(keys, on=key, how="left_anti")
    return kept.unionByName(rows.select(*target.columns))


def current(dim: DataFrame) -> DataFrame:
    """Rows flagged current."""
    return dim.where(F.col("is_current"))


def as_of(dim: DataFrame, ts, include_deleted: bool = False) -> DataFrame:
    """Versions valid at ``ts``: start <= ts < end (open end = still valid)."""
    t = F.lit(ts).cast("timestamp_ntz") if not hasattr(ts, "_jc") else ts
    cond = (F.col(VF) <= t) & (F.col(VT).isNull() | (t < F.col(VT)))
    if not include_deleted and "is_deleted" in dim.columns:
        cond = cond & ~F.col("is_deleted")
    return dim.where(cond)
