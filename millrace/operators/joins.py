"""Joins whose strategy follows the measured size of the small side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.staging import stage

# A broadcast side holds at most this many rows and bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20


def fits_broadcast(staged: DataFrame, limit: int | None = None) -> bool:
    """Measure a written narrow table against the broadcast bounds, ``limit`` for its rows."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))
    row = staged.agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).first()
    rows_bound = BROADCAST_ROWS if limit is None else limit
    return row["rows"] <= rows_bound and (row["bytes"] or 0) <= BROADCAST_BYTES


def sized_join(
    wide: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    rows: int | None = None,
    limit: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join a narrow table to a wide one. ``null_safe``: nulls in ``on`` are equal.

    The narrow table is written and measured; a caller that made it from a list on the
    driver passes its ``rows`` instead. Within the bounds it is broadcast and the wide side
    stays where it is; beyond them both sides are shuffled, whatever Spark estimates of their
    sizes, and adaptive execution splits skewed partitions of the wide side.
    """
    if rows is None:
        small = stage(small, "join-side")
        fits = fits_broadcast(small, limit)
    else:
        fits = rows <= (BROADCAST_ROWS if limit is None else limit)
    if null_safe:
        return null_safe_join(wide, small, on, how, broadcast=fits)
    return wide.join(F.broadcast(small) if fits else small.hint("merge"), list(on), how)


def null_safe_join(
    wide: DataFrame, small: DataFrame, on: Sequence[str], how: str, *, broadcast: bool = False
) -> DataFrame:
    """Join by equal names in which null equals null; columns as in a join by names."""
    right = small.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    joined = wide.join(
        F.broadcast(right) if broadcast else right, reduce(lambda a, b: a & b, same), how
    )
    return joined.drop(*[f"_right_{c}" for c in on])
