"""Anomaly flags over series, and what-if budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyline.functions.columns import ratio


def anomaly_flags(series: DataFrame, value: str, order: str, n: int = 6, keys: Sequence[str] = (),
                  limit: float = 2.0) -> DataFrame:
    """Add `baseline`, `deviation` and `is_anomaly`: how far a period is from the `n` before it.

    The window excludes the period itself, so that a jump does not hide in its own mean.
    `deviation` is in sample standard deviations of the window, signed. Until `n` earlier
    values exist all three are null, as is a period without a value; null values take no part
    in a window. Where the window does not vary, any other value is an anomaly and has no
    deviation. One row per period and key: the windows order report rows, not facts.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    x = F.col(value).cast("double")
    full = (F.count(value).over(w) == n) & F.col(value).isNotNull()
    flat = F.min(value).over(w) == F.max(value).over(w)
    spread = F.stddev_samp(x).over(w)
    out = series.withColumns({
        "baseline": F.when(full, ratio(F.sum(value).over(w), F.count(value).over(w))),
        "_flat": F.when(full, flat), "_spread": F.when(full, spread)})
    return out.withColumns({
        "deviation": F.when(~F.col("_flat"), F.round((x - F.col("baseline")) / F.col("_spread"), 4)),
        "is_anomaly": F.when(F.col("_flat"), x != F.col("baseline")).otherwise(
            F.abs(x - F.col("baseline")) > limit * F.col("_spread"))}).drop("_flat", "_spread")


def reallocate_budget(channels: DataFrame, share_pct: int = 20, growth_pct: int = 50, channel: str = "channel",
                      spend: str = "spend", revenue: str = "revenue") -> DataFrame:
    """`channel`, `spend`, `taken`, `given`, `new_spend`, `expected_revenue` per channel, if
    `share_pct` of every channel's spend moved to the channels that return more than all do
    together, in proportion to their return per unit spent.

    No channel gets more than `growth_pct` of its spend. What a full channel cannot take goes
    to the others in the same proportion; in closed form, the full channels are those with the
    least room per return. Amounts are whole cents that add up: what rounding down leaves goes
    by largest remainder, ties by name. What nobody may take stays where it came from, spread
    like the taking, so spending never changes in total. Channels without spend or name take
    no part. One row per channel: the windows order a report.
    """
    cents = "CAST(ROUND({} * 100) AS DECIMAL(38,0))"
    rows = channels.where(F.col(channel).isNotNull() & (F.col(spend) > 0)).select(
        F.col(channel).alias("channel"), F.expr(cents.format(f"`{spend}`")).alias("s"),
        F.expr(cents.format(f"COALESCE(`{revenue}`, 0)")).alias("r"))
    every = Window.partitionBy()
    rows = (rows.withColumns({"taken": F.expr(f"CAST(s * {share_pct} div 100 AS DECIMAL(38,0))"),
                              "all_s": F.sum("s").over(every), "all_r": F.sum("r").over(every)})
            .withColumn("pool", F.sum("taken").over(every)))
    # return per unit spent in millionths, for the channels above the common one
    rows = rows.withColumn("w", F.expr("CAST(IF(r * all_s > all_r * s, r * 1000000 div s, 0) AS DECIMAL(38,0))")).withColumn(
        "room", F.expr(f"CAST(IF(w > 0, s * {growth_pct} div 100, 0) AS DECIMAL(38,0))"))
    # channels from the fullest on; a channel is full if the level that the rest would have passes its room
    tight = Window.orderBy(F.expr("IF(w > 0, CAST(room AS DOUBLE) / CAST(w AS DOUBLE), NULL)").asc_nulls_last(), "channel")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"room_before": F.coalesce(F.sum("room").over(before), F.lit(0)).cast("decimal(38,0)"),
                             "w_left": F.sum("w").over(tight.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    full = "(w > 0 AND pool - room_before > 0 AND (pool - room_before) * w >= room * w_left)"
    # fullness holds for a prefix: once a channel keeps its share, so do all behind it
    rows = rows.withColumn("is_full", F.min(F.expr(full).cast("int")).over(tight.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rows = rows.withColumns({
        "left": F.expr("CAST(GREATEST(pool - SUM(IF(is_full, room, 0)) OVER (), 0) AS DECIMAL(38,0))"),
        "w_open": F.expr("CAST(SUM(IF(is_full, 0, w)) OVER () AS DECIMAL(38,0))")})
    rows = rows.withColumns({
        "low": F.expr("CAST(IF(is_full, room, IF(w_open > 0, left * w div w_open, 0)) AS DECIMAL(38,0))"),
        "rest": F.expr("CAST(IF(is_full OR w = 0 OR w_open = 0, -1, left * w % w_open) AS DECIMAL(38,0))")})
    by_rest = Window.orderBy(F.desc("rest"), "channel")
    rows = (rows.withColumn("odd", F.expr("IF(w_open > 0, left - SUM(IF(is_full, 0, low)) OVER (), 0)"))
            .withColumn("given", F.col("low") + F.when((F.col("rest") >= 0) & (F.row_number().over(by_rest) <= F.col("odd")), 1).otherwise(0)))
    # what nobody may take goes back
    rows = rows.withColumn("unused", F.expr("pool - SUM(given) OVER ()"))
    rows = rows.withColumns({"kept": F.expr("CAST(IF(pool > 0, unused * taken div pool, 0) AS DECIMAL(38,0))"),
                             "kept_rest": F.expr("CAST(IF(pool > 0, unused * taken % pool, 0) AS DECIMAL(38,0))")})
    by_kept = Window.orderBy(F.desc("kept_rest"), "channel")
    rows = (rows.withColumn("kept_odd", F.expr("unused - SUM(kept) OVER ()"))
            .withColumn("taken", F.col("taken") - F.col("kept") - F.when(F.row_number().over(by_kept) <= F.col("kept_odd"), 1).otherwise(0)))
    money = "CAST({} / 100 AS DECIMAL(20,2))"
    return rows.selectExpr(
        "channel", f"{money.format('s')} AS spend", f"{money.format('taken')} AS taken", f"{money.format('given')} AS given",
        f"{money.format('(s - taken + given)')} AS new_spend").join(
        rows.select("channel", ratio(F.col("r").cast("double") / 100 * (F.col("s") - F.col("taken") + F.col("given")).cast("double"),
                                     F.col("s").cast("double")).alias("expected_revenue")), "channel")
