"""Row filters, existence joins and key set operations on orders and items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tallyline.functions.columns import status_filter
from tallyline.functions.derive import CANCELLED, ONLINE, RETURNED, REVENUE_STATUSES

# Markers that mean "no parent applies" in a foreign key.
NA_SENTINELS = ("ONLINE", "N/A", "NONE", "UNKNOWN", "")


def revenue_orders(orders: DataFrame, status_in: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    return orders.where(status_filter("order_status", status_in=status_in))


def where_status(orders: DataFrame, status_in: Sequence[str] | None = None,
                 status_not_in: Sequence[str] | None = None) -> DataFrame:
    return orders.where(status_filter("order_status", status_in, status_not_in))


def pit_split(orders: DataFrame, obs: str, horizon: int) -> DataFrame:
    """Orders up to the observation date ("history") and in the `horizon` days after it
    ("future"); later orders are left out. The date bound reaches the scan."""
    day = F.to_date(F.lit(obs))
    return (orders
            .where(F.col("order_date") <= F.date_add(day, horizon))
            .withColumn("side", F.when(F.col("order_date") <= day, "history").otherwise("future")))


def history(orders: DataFrame, obs: str) -> DataFrame:
    return orders.where(F.col("order_date") <= F.to_date(F.lit(obs)))


def future(orders: DataFrame, obs: str, horizon: int) -> DataFrame:
    day = F.to_date(F.lit(obs))
    return orders.where((F.col("order_date") > day)
                        & (F.col("order_date") <= F.date_add(day, horizon)))


def active_within(df: DataFrame, recency: str = "recency_days", days: int = 365) -> DataFrame:
    return df.where(F.col(recency) <= days)


def payable_orders(orders: DataFrame) -> DataFrame:
    return where_status(orders, status_not_in=[CANCELLED])


def shippable_orders(orders: DataFrame, online: str = ONLINE) -> DataFrame:
    return revenue_orders(orders).where(F.col("channel") == online)


def returnable_items(items: DataFrame, orders: DataFrame, status: str = RETURNED) -> DataFrame:
    return semi(items, where_status(orders, status_in=[status]), "order_id")


def eligibility(orders: DataFrame, items: DataFrame, online: str = ONLINE,
                returned: str = RETURNED) -> DataFrame:
    """Row counts of the payable and shippable orders and of the returnable items."""
    counts = [("payable", payable_orders(orders)), ("shippable", shippable_orders(orders, online)),
              ("returnable", returnable_items(items, orders, returned))]
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("subset", F.lit(name))
             for name, df in counts]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("subset", "n_rows")


def invalid_values(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break at least one rule, with the first broken rule's name as `reason`.

    A rule is the condition of a *bad* row; null counts as not broken.
    """
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def future_dated(df: DataFrame, date_col: str, as_of: str) -> DataFrame:
    return df.where(F.col(date_col) > F.to_date(F.lit(as_of)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def populated(df: DataFrame, fk: str, sentinels: Sequence[str] = NA_SENTINELS) -> DataFrame:
    """Rows whose foreign key is neither null nor a not-applicable marker in any case. A
    number is never a marker text."""
    given = F.col(fk).isNotNull()
    if isinstance(df.schema[fk].dataType, StringType):
        given = given & ~F.upper(fk).isin(*sentinels)
    return df.where(given)


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(other, on, "left_semi")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key has no parent; a null key has none."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def keys_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of `left` that do not occur in `right`."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
