"""Range join by a sorted sweep: every probe with the half-open bands that hold it.

The id space is cut at sampled quantiles of the probes.  A probe goes to one
part and is never copied; a band is copied to the parts it spans.  Inside a
part, rows come in the order of their ids (a band by its start), and the sweep
holds the bands that are open.  One pass gives the matches and, for a left
join, the probes without any.  A value that fills several parts is spread over
as many, with its bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .borders import default_parts, part_of, sampled_borders

#: Matches that leave the sweep in one batch, but for those of one last probe.
MATCHES = 200_000


def _matches(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first, last, count)``: for every band the run of sorted ``values`` it holds, and for every value how many bands hold it."""
    first = np.searchsorted(values, lo, side="left")
    last = np.maximum(np.searchsorted(values, hi, side="left"), first)
    change = np.bincount(first, minlength=len(values) + 1) - np.bincount(last, minlength=len(values) + 1)
    return first, last, np.cumsum(change)[:len(values)]


def sweep_join(probe: DataFrame, bands: DataFrame, *, value: str, lo: str, hi: str, how: str = "inner",
               parts: int | None = None) -> DataFrame:
    """Every row of ``probe`` with every row of ``bands`` that has ``lo <= value < hi`` (integers); columns of both.

    Empty bands and bands with a null end hold nothing.  ``how='left'`` keeps
    probes that no band holds, those with a null value among them, with null
    band columns.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    parts = parts or default_parts(probe)
    borders = sampled_borders(probe.select(F.col(value).cast("bigint").alias("_v")), ["_v"], parts, repeats=True)
    at = F.col(value).cast("bigint")
    begin, stop = F.col(lo).cast("bigint"), F.col(hi).cast("bigint")
    upto, under = part_of([at], borders, ["bigint"]), part_of([at], borders, ["bigint"], below=True)
    spread = F.xxhash64(*[c for c, t in probe.dtypes if "map<" not in t])
    place = F.when(upto > under, under + 1 + F.pmod(spread, upto - under).cast("int")).otherwise(upto)
    ps = probe.select(F.when(at.isNull(), F.lit(0)).otherwise(place).alias("_part"), F.coalesce(at, F.lit(-(1 << 63))).alias("_at"),
                      F.when(at.isNull(), F.lit(2)).otherwise(F.lit(1)).alias("_side"), F.lit(0).cast("bigint").alias("_end"), F.struct(*probe.columns).alias("_probe"))
    spans = F.explode(F.sequence(part_of([begin], borders, ["bigint"], below=True), part_of([stop - 1], borders, ["bigint"])))
    bs = bands.where(begin < stop).select(spans.alias("_part"), begin.alias("_at"), F.lit(0).alias("_side"), stop.alias("_end"), F.struct(*bands.columns).alias("_band"))
    rows = ps.unionByName(bs, allowMissingColumns=True).repartition(parts, "_part").sortWithinPartitions("_part", "_at", "_side")
    left = how == "left"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held_lo, held_hi, held = None, np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def out(probes: pa.Array, band: pa.Array, mine: np.ndarray, theirs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([probes.take(pa.array(mine)), band.take(pa.array(theirs, mask=theirs < 0))], ["_probe", "_band"])

        for b in batches:
            of, ats, side, end = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_part", "_at", "_side", "_end"))
            for i, j in zip(cuts := np.flatnonzero(np.diff(of, prepend=of[:1] - 1)), [*cuts[1:], len(of)]):
                if of[i] != part:
                    part, held_lo, held_hi, held = of[i], held_lo[:0], held_hi[:0], b.column("_band").slice(0, 0)
                mine = slice(int(i), int(j))
                is_band = np.flatnonzero(side[mine] == 0) + i
                held_lo, held_hi = np.concatenate([held_lo, ats[is_band]]), np.concatenate([held_hi, end[is_band]])
                held = pa.concat_arrays([held, b.column("_band").take(pa.array(is_band))])
                lost = np.flatnonzero(side[mine] == 2) + i
                if left and len(lost):
                    yield out(b.column("_probe"), held, lost, np.full(len(lost), -1))
                is_probe = np.flatnonzero(side[mine] == 1) + i
                v = ats[is_probe]
                first, last, count = _matches(v, held_lo, held_hi)
                done = np.cumsum(count)
                k = 0
                while k < len(v):  # some probes at a time, with their matches
                    n = max(int(np.searchsorted(done, (done[k - 1] if k else 0) + MATCHES, side="right")), k + 1)
                    a, z = np.clip(first, k, n), np.clip(last, k, n)
                    many = z - a
                    theirs = np.repeat(np.arange(len(a)), many)
                    ours = np.arange(len(theirs)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)
                    if left:
                        alone = np.flatnonzero(count[k:n] == 0) + k
                        ours, theirs = np.concatenate([ours, alone]), np.concatenate([theirs, np.full(len(alone), -1)])
                    if len(ours):
                        yield out(b.column("_probe"), held, is_probe[ours], theirs)
                    k = n
                open_ = held_hi > ats[j - 1]
                held_lo, held_hi, held = held_lo[open_], held_hi[open_], held.filter(pa.array(open_))

    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(run, f"_probe {kinds['_probe']}, _band {kinds['_band']}")
    return found.select(*[F.col(f"_probe.`{c}`") for c in probe.columns], *[F.col(f"_band.`{c}`") for c in bands.columns])


__all__ = ["MATCHES", "sweep_join"]
