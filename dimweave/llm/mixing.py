"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule over training time 0..1, given as
``(time, weight)`` knots with straight lines between them.  A source's share
of the mix is the schedule's integral.  Its documents are queued in a fixed
pseudo-random order, once per pass; a document whose place in the queue is the
fraction ``u`` of the source's demand gets the training time at which the
integrated schedule reaches ``u``.  Sorting by that time is the curriculum.

Defined results: a null text has size 0; null sources form the last source;
documents of size 0 are taken 0 words and get no position; ties in the queue
are broken by id and content, fully equal rows are interchangeable; an empty
table gives an empty result.  A document is taken at most
``cap`` times, the last time perhaps in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import small_side, stored

#: Schedules dealt to the sources in code point order, repeating.  Integrals 3, 1, 2.
SCHEDULES = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 2.0), (1.0, 2.0)))
TOTAL_SHARE = 1.5
CAP = 2.0
#: Slices of a source's queue; each is summed and ordered on its own.
SLICES = 4096


def integral(knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def time_at(knots, share: Column) -> Column:
    """Training time at which the integrated schedule reaches ``share`` (0..1) of its whole."""
    total, done, out = integral(knots), 0.0, F.lit(float(knots[-1][0]))
    pieces = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        pieces.append((done, done + area, t0, t1, w0, w1))
        done += area
    for lo, hi, t0, t1, w0, w1 in reversed(pieces):
        need = F.greatest(share * total - lo, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
        x = 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))))
        out = F.when(share * total <= hi, F.least(t0 + F.coalesce(x, F.lit(0.0)), F.lit(float(t1)))).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: list[float], total_share: float = TOTAL_SHARE, cap: float = CAP) -> DataFrame:
    """``_source, source_size, source_rank, target`` from one row per source.

    Sources are ranked by code point, null last, and get the weights in turn.
    In order of cap / weight the sources that reach their cap come first, so
    one running sum finds the level at which nobody else does.  The table has
    a row per source, never a row per document.
    """
    ranked = sizes.withColumn("source_rank", F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"_w": weight, "_cap": cap * F.col("source_size")})
    whole = W.partitionBy()
    order = W.orderBy(F.col("_cap") / F.col("_w"), "source_rank")
    up_to = order.rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumns({"_left": total_share * F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0)),
                                 "_wleft": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(up_to), F.lit(0.0))})
    level = F.col("_left") / F.col("_wleft")
    ranked = ranked.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    everyone = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = ranked.withColumn("_level", F.first("_level", ignorenulls=True).over(everyone))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return ranked.select("_source", "source_size", "source_rank", target.alias("target"))


def plan_mix(docs: DataFrame, size: str, source: str, order: list[Column], schedules=SCHEDULES,
             total_share: float = TOTAL_SHARE, cap: float = CAP) -> DataFrame:
    """``docs`` with ``source_size, target, taken, passes, first_time, last_time``.

    ``passes`` is how often the document occurs (the last time perhaps in
    part); ``first_time`` and ``last_time`` are its training positions.
    A source is cut into ``SLICES`` hashed slices: their sums give each slice
    its start in the queue, so no source is ordered in one task.
    """
    weights = [integral(k) for k in schedules]
    key = F.md5(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("")) for c in order]))
    rows = docs.withColumns({"_key": key, "_slice": F.conv(F.substring(key, 1, 3), 16, 10).cast("int") % SLICES})
    slices = stored(rows.groupBy(F.col(source).alias("_source"), F.col("_slice").alias("_s")).agg(F.sum(size).alias("_sum")), "mix-slices")
    targets = source_targets(slices.groupBy("_source").agg(F.sum("_sum").alias("source_size")), weights, total_share, cap)
    before = F.sum("_sum").over(W.partitionBy("_source").orderBy("_s").rowsBetween(W.unboundedPreceding, -1))
    starts = stored(slices.withColumn("_start", F.coalesce(before, F.lit(0))).join(
        targets.withColumnRenamed("_source", "_tsource"), F.col("_source").eqNullSafe(F.col("_tsource"))).drop("_tsource", "_sum"), "mix-starts")
    inside = W.partitionBy(source, "_slice").orderBy("_key", *[c.asc_nulls_last() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = rows.join(small_side(starts), rows[source].eqNullSafe(starts["_source"]) & (rows["_slice"] == starts["_s"]))
    n, total, goal = F.col(size), F.col("source_size"), F.col("target")
    joined = joined.withColumn("_at", F.col("_start") + F.col("_inside"))
    joined = joined.withColumn("_full", F.when(total > 0, F.floor(goal / total)).otherwise(F.lit(0)).cast("long"))
    rest = F.round(goal - F.col("_full") * total).cast("long")
    extra = F.greatest(F.lit(0), F.least(n, rest - F.col("_at"))).cast("long")
    joined = joined.withColumns({"_extra": extra, "passes": F.col("_full") * (n > 0).cast("long") + (extra > 0).cast("long")})
    joined = joined.withColumn("taken", F.col("_full") * n + F.col("_extra"))

    def place(turn: Column) -> Column:
        share = F.least(F.lit(1.0), (turn * total + F.col("_at") + n / 2) / goal)
        times = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            times = F.when(F.col("source_rank") % len(schedules) == i, time_at(knots, share)).otherwise(times)
        return times

    joined = joined.withColumns({"first_time": F.when(F.col("passes") > 0, place(F.lit(0))),
                                 "last_time": F.when(F.col("passes") > 0, place(F.col("passes") - 1))})
    return joined.drop("_key", "_slice", "_s", "_source", "_start", "_inside", "_at", "_full", "source_rank")


def mixed_rows(planned: DataFrame, size: str, text: str, schedules=SCHEDULES) -> DataFrame:
    """One row per occurrence in training order: the planned documents, repeated, sorted by time.

    ``_extra`` words of the text are kept where the last occurrence is partial.
    """
    one_pass = F.greatest(F.lit(1), F.col("passes") - 1)
    step = (F.col("last_time") - F.col("first_time")) / one_pass
    turns = planned.where(F.col("passes") > 0).withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))))
    partial = (F.col("_turn") == F.col("passes")) & (F.col("_extra") > 0) & (F.col("_extra") < F.col(size))
    words = F.slice(F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), F.col("_extra").cast("int"))
    return (turns.withColumns({text: F.when(partial, F.array_join(words, "")).otherwise(F.col(text)),
                               "position": F.col("first_time") + step * (F.col("_turn") - 1)})
            .orderBy("position", "_turn"))


__all__ = ["SCHEDULES", "TOTAL_SHARE", "CAP", "integral", "time_at", "source_targets", "plan_mix", "mixed_rows"]
