"""Joins (J1, J2, J4).

No join here forces a broadcast. Static planning broadcasts only tiny
relations; adaptive execution re-plans a join as broadcast once a shuffle
has measured the small side (a proven size), and splits skewed partitions of
sort-merge joins otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelife.series import null_safe_join


def full_join_suffix(left: DataFrame, right: DataFrame, on, suffix: str = "_2",
                     split_outer: bool = False) -> DataFrame:
    """Full outer equi-join on ``on``; the key columns are coalesced and right
    columns whose names clash with left ones get ``suffix``.

    Duplicate keys multiply and null keys never match (SQL semantics).
    ``split_outer=True`` writes the same result as inner join + two anti
    joins, each of which adaptive execution can split when a key is hot
    (Spark cannot split a skewed full outer join).
    """
    on = [on] if isinstance(on, str) else list(on)
    r = right
    for c in right.columns:
        if c not in on and c in left.columns:
            r = r.withColumnRenamed(c, c + suffix)
    if not split_outer:
        return left.join(r, on=on, how="full")
    cols = on + [c for c in left.columns if c not in on] + [c for c in r.columns if c not in on]
    inner = left.join(r, on=on, how="inner")
    l_only = left.join(r.select(*on), on=on, how="left_anti")
    r_only = r.join(left.select(*on), on=on, how="left_anti")
    # null keys never match: they come through the anti joins unchanged
    return inner.select(*cols).unionByName(l_only, allowMissingColumns=True).unionByName(
        r_only, allowMissingColumns=True).select(*cols)


def anti_join(left: DataFrame, right: DataFrame, on, drop_null_keys: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is not among ``right``'s keys.

    ``drop_null_keys`` also removes rows with a null key, as a "value not in
    list" test on a null does.
    """
    on = [on] if isinstance(on, str) else list(on)
    out = left.join(right.select(*on).distinct(), on=on, how="left_anti")
    if drop_null_keys:
        for c in on:
            out = out.where(F.col(c).isNotNull())
    return out


def attach(left: DataFrame, right: DataFrame, on, null_safe: bool = True) -> DataFrame:
    """Left join of per-group attributes onto rows."""
    on = [on] if isinstance(on, str) else list(on)
    if null_safe:
        return null_safe_join(left, right, on, "left")
    return left.join(right, on=on, how="left")
