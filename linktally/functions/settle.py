"""Keep costly columns from being computed again by later filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, *names: str) -> DataFrame:
    """The same rows with the named columns last, as values rather than formulas.

    The optimizer moves a filter below the projections that define its columns
    and copies their expressions into it, once for each use. With staged
    expressions that multiplies the work and makes generated methods too large
    to be compiled. A filter does not move past a generator, so the columns are
    passed through one that gives back one row for each.
    """
    others = [name for name in df.columns if name not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names))))
