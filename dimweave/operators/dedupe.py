"""Keep-first de-duplication (``QUALIFY row_number() over (..) = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def asc(c: str | Column) -> Column:
    """Ascending with nulls last, the order DuckDB and most SQL engines use."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def desc(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def keep_first(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per ``partition_by`` group: the first by ``order_by``.

    ``order_by`` items that are strings mean ascending, nulls last.  Pass a
    total order (add tie-breakers) for a deterministic pick.  Spark plans the
    ``rn = 1`` filter as a ``WindowGroupLimit`` both before and after the
    shuffle, so each map task forwards one row per group, which keeps a hot
    group from flooding one reducer.
    """
    order = [asc(o) if isinstance(o, str) else o for o in order_by]
    w = W.partitionBy(*partition_by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def last_value_default_frame(partition_by: Sequence[str], order_desc: str, value: str) -> Column:
    """``last_value(value) over (partition by .. order by order_desc desc)`` with the default frame.

    The default frame ends at the last peer of the current row, so when the
    value is the ordering column itself the result is the row's own value --
    no shuffle is needed.  Other values use the window.
    """
    if value == order_desc:
        return F.col(value)
    w = W.partitionBy(*partition_by).orderBy(desc(order_desc))
    return F.last(value).over(w)
