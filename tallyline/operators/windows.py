"""Growth and moving averages over a bounded time axis (months, quarters, years).

The windows order one row per period, so they run over a few hundred rows whatever the
size of the facts behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyline.functions.columns import ratio


def growth(df: DataFrame, value: str, order: str, previous: str, name: str,
           by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """Previous row's value and the change against it in percent."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    return (df.withColumn(previous, before)
            .withColumn(name, ratio(F.col(value) - F.col(previous), previous, scale=100, digits=digits)))


def moving_avg(df: DataFrame, value: str, order: str, n: int, name: str,
               by: Sequence[str] = (), digits: int | None = 2) -> DataFrame:
    """Mean of the row and the n-1 rows before it."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(1 - n, Window.currentRow)
    return df.withColumn(name, ratio(F.sum(value).over(w), F.count(value).over(w), digits=digits))


def pct_change(df: DataFrame, value: str, order: str, n: int, name: str,
               by: Sequence[str] = (), dense: bool = False) -> DataFrame:
    """Percent change against the row n positions before; with `dense` against the same
    month n calendar months before, null where that month is absent."""
    if dense:
        earlier = df.select(*by, F.add_months(order, n).alias(order), F.col(value).alias("_before"))
        df = df.join(earlier, [*by, order], "left")
    else:
        df = df.withColumn("_before", F.lag(value, n).over(Window.partitionBy(*by).orderBy(order)))
    change = (ratio(value, "_before") - 1) * 100
    return df.withColumn(name, change).drop("_before")
