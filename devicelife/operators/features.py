"""Feature scaling (M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardise(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """``(x - mean) / population std``; a constant column is scaled by 1.

    Mean and std enter as scalar subqueries over one aggregate (Spark merges
    them into a single job), so the rows are read once more, never moved.
    """
    cols = list(cols)
    stats = df.agg(*[x for c in cols for x in (F.avg(F.col(c).cast("double")).alias(f"_m_{c}"),
                                               F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}"))])
    out = []
    for c in cols:
        m, sd = stats.select(f"_m_{c}").scalar(), stats.select(f"_s_{c}").scalar()
        scale = F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out.append(((F.col(c).cast("double") - m) / scale).alias(c + suffix))
    keep = [c for c in df.columns if c not in cols or suffix]
    return df.select(*keep, *out)
