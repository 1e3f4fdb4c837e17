"""One meaning for "missing": NaN and sentinel numbers become NULL at the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def normalise_missing(df: DataFrame, sentinels: Iterable[float] = ()) -> DataFrame:
    """Turn NaN and the given sentinel values of floating columns into NULL."""
    sentinels = list(sentinels)
    fixed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (DoubleType, FloatType)):
            c = F.when(~F.isnan(field.name), F.col(field.name))
            if sentinels:
                c = F.when(~F.col(field.name).isin(sentinels), c)
            fixed[field.name] = c
    return df.withColumns(fixed) if fixed else df


def is_true(cond: Column) -> Column:
    """A predicate that counts NULL as false, so that it can be negated safely."""
    return F.coalesce(cond, F.lit(False))


def finite(c: Column) -> Column:
    return is_true(c.isNotNull() & ~F.isnan(c))
