"""Order-preserving cuts of a key space by sampled quantiles.

Fixed-width buckets fill unevenly (one far-off id, ids with one prefix); cuts
at quantiles of a bounded sample do not, for numbers and text alike.  Cuts
only decide which task holds a row, so results do not depend on the sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows sampled per part: the fullest of a thousand parts then holds about twice the mean.
PER_PART = 32


def default_parts(df: DataFrame) -> int:
    """As many parts as the session has shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def sampled_borders(df: DataFrame, cols: Sequence[str], parts: int, *, per_part: int = PER_PART, seed: int = 11,
                    repeats: bool = False) -> list[tuple]:
    """At most ``parts - 1`` values of ``cols``, ascending, that cut ``df`` into parts of like size.

    One pass keeps ``parts * per_part`` random rows without nulls (a bounded
    top-n per task); only those reach the driver.  A value that fills several
    parts is one border, or with ``repeats`` as many equal ones as it fills parts.
    """
    known = df.select(*cols).dropna()
    rows = known.select("*", F.rand(seed).alias("_r")).orderBy("_r").limit(parts * per_part).drop("_r").collect()
    rows = sorted(tuple(r) for r in rows)  # text compares by code point, as Spark's does
    picks = [rows[len(rows) * k // parts] for k in range(1, parts)] if rows else []
    return picks if repeats else sorted(set(picks))


def part_of(values: Sequence[Column | str], borders: Sequence[tuple], kinds: Sequence[str], *, below: bool = False) -> Column:
    """How many borders lie at or below the values (only ``below`` them, if asked): a non-decreasing part number from 0 on.

    A binary search over a constant array, inside the JVM.  Null values
    compare as Spark orders them inside a struct, before all others.
    ``kinds`` are the values' SQL types.
    """
    if not borders:
        return F.lit(0)

    def cell(row):
        return F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(row, kinds))])

    cuts = F.array(*[cell(b) for b in borders])
    mine = F.struct(*[(F.col(v) if isinstance(v, str) else v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(values, kinds))])
    steps = []
    step = 1 << (len(borders).bit_length() - 1)
    while step:
        steps.append(step)
        step >>= 1

    def down(at: Column, step: Column) -> Column:
        near = at + step
        cut = F.element_at(cuts, F.least(near, F.lit(len(borders))))
        return F.when((near <= len(borders)) & ((cut < mine) if below else (cut <= mine)), near).otherwise(at)

    return F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), down)


__all__ = ["PER_PART", "default_parts", "sampled_borders", "part_of"]
