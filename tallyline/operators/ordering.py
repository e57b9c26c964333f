"""Global order without a global task: running sums, row numbers, ranks, quantiles.

A window without partition keys sends every row to one task. Here the rows are cut
into range buckets first: a sample chosen by a hash of the row's own key gives the
split points, each bucket runs a local window, and the totals of the earlier buckets
are added. Split points are (order value, id) tuples, so any number of equal order
values still spreads over many buckets.

The input is materialised once (see `cut_lineage`), because its rows are read for the
count, the sample, the bucket totals and the window. There is one path for all sizes: a
small frame has as many buckets as the session has cores, a large one as many as its rows
need.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline.functions.columns import ratio
from tallyline.session import cut_lineage

ROWS_PER_BUCKET = 1_000_000
SAMPLES_PER_BUCKET = 32

_KEY, _AT, _BUCKET = "_key", "_at", "_bucket"
_COUNT, _RUN, _CARRY = "_n", "_run", "_carry"


def _split_points(df: DataFrame, fields: list[str], id: str, n: int, buckets: int) -> Column:
    """Sorted split tuples as a constant array: at most about one per bucket.

    The sample is about SAMPLES_PER_BUCKET rows per bucket, whatever the size of the data,
    picked by a hash of the row, so that it does not depend on the partitioning. Binary
    search needs a lambda, in which Spark allows no subquery, so the tuples are collected:
    one per `rows_per_bucket` rows. Raise that for tables of trillions of rows.
    """
    dice = F.pmod(F.xxhash64(id, *[f for f in fields if f not in (_KEY, id)]), F.lit(1 << 30)) / float(1 << 30)
    sample = df.where(dice < min(1.0, SAMPLES_PER_BUCKET * buckets / max(n, 1)))
    ordered = sample.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("s"))
    step = F.greatest(F.lit(1), F.ceil(F.size("s") / F.lit(buckets)).cast("int"))
    picked = (ordered.select(F.filter("s", lambda s, i: (i + 1) % step == 0).alias("s"))
              .select(F.posexplode("s").alias("at", "e"))
              .select("at", *[F.col(f"e.`{f}`").cast("string").alias(f) for f in fields]))
    kinds = {f: df.schema[f].dataType.simpleString() for f in fields}
    tuples = [f"NAMED_STRUCT({', '.join(f'{_quoted(f)}, CAST({_quoted(r[f])} AS {kinds[f]})' for f in fields)})"
              for r in sorted(picked.collect(), key=lambda r: r["at"])]
    layout = ", ".join(f"`{f}`: {kinds[f]}" for f in fields)
    return F.expr(f"CAST(ARRAY({', '.join(tuples)}) AS ARRAY<STRUCT<{layout}>>)")


def _quoted(text: str | None) -> str:
    if text is None:
        return "NULL"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with_buckets(df: DataFrame, by: list[str], id: str, n: int, buckets: int,
                  edges: bool = False) -> DataFrame:
    """Add `_bucket`. With `edges` also whether the row has the group and order value of
    its bucket's lower or upper split, and those two values."""
    fields = list(dict.fromkeys([*by, _KEY, id]))
    splits = _split_points(df, fields, id, n, buckets)
    # Binary search: the number of split tuples that are <= the row's tuple.
    strides = F.array(*[F.lit(1 << b) for b in reversed(range(buckets.bit_length()))])
    found = F.aggregate(
        strides, F.lit(0),
        lambda at, s: F.when(F.get(splits, at + s - 1) <= F.col(_AT), at + s).otherwise(at))
    df = df.withColumn(_AT, F.struct(*fields)).withColumn(_BUCKET, found)
    if edges:
        sides = {"_low": F.get(splits, F.col(_BUCKET) - 1), "_high": F.get(splits, F.col(_BUCKET))}
        for side, split in sides.items():
            same = split.isNotNull()
            for c in [*by, _KEY]:
                same = same & split[c].eqNullSafe(F.col(c))
            df = df.withColumns({f"{side}_peer": same, f"{side}_value": split[_KEY]})
    return df.drop(_AT)


def _bucket_count(df: DataFrame, n: int, rows_per_bucket: int) -> int:
    return max(2, df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / rows_per_bucket))


def prefix_scan(df: DataFrame, order: str, id: str, sums: Sequence[str] = (),
                by: Sequence[str] = (), frame: str = "rows", descending: bool = False,
                rows_per_bucket: int = ROWS_PER_BUCKET, stored: bool = False,
                size: str | None = None) -> DataFrame:
    """Add `row_number`, `running_<c>` per column of `sums`, and `running_count`.

    Rows are ordered by `order` and then by the unique `id`, within each group `by`.
    `frame="rows"` sums up to the row itself; `frame="range"` also takes every row with
    the same order value, and `running_count` counts the same rows. `order` must be a
    number when `descending`. Sum exact types (integers, decimals) for results that do
    not depend on the bucket layout. `stored` says the frame is materialised already;
    `size` names a column for the number of rows of the group.
    """
    if frame not in ("rows", "range"):
        raise ValueError(f"unknown frame: {frame}")
    staged = df if stored else cut_lineage(df)
    return _scan(staged, staged.count(), order, id, list(sums), list(by), frame, descending,
                 rows_per_bucket, size)


def _scan(staged: DataFrame, n: int, order: str, id: str, sums: list[str], by: list[str],
          frame: str, descending: bool, rows_per_bucket: int, size: str | None = None) -> DataFrame:
    """`size` names a column for the number of rows of the whole group."""
    buckets = _bucket_count(staged, n, rows_per_bucket)
    keyed = staged.withColumn(_KEY, -F.col(order) if descending else F.col(order))
    keyed = keyed.withColumn(_COUNT, F.lit(1).cast("bigint"))
    measures = [_COUNT, *sums]
    names = {_COUNT: "running_count", **{c: f"running_{c}" for c in sums}}

    keyed = _with_buckets(keyed, by, id, n, buckets, edges=frame == "range")
    offsets = _offsets(keyed, by, measures, frame)
    local = [_BUCKET, *by]
    scanned = (keyed
               .withColumn("row_number",
                           F.row_number().over(Window.partitionBy(*local).orderBy(_KEY, id)).cast("bigint"))
               .withColumns({_RUN + c: F.sum(c).over(_frame(Window.partitionBy(*local), id, frame))
                             for c in measures}))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in local]
    # Without groups the offsets are one row per bucket.
    side = offsets if by else F.broadcast(offsets)
    joined = scanned.alias("l").join(side.alias("r"), on, "inner")
    out = [F.col(f"l.{c}") for c in staged.columns]
    out.append((F.col("l.row_number") + F.col(f"r.before_{_COUNT}")).alias("row_number"))
    for c in measures:
        running = F.col(f"l.{_RUN}{c}") + F.col(f"r.before_{c}")
        if frame == "range":
            running = running + F.when(F.col("l._high_peer"), F.col(f"r.{_CARRY}{c}")).otherwise(F.lit(0))
        out.append(running.alias(names[c]))
    if size:
        out.append(F.col("r._whole").alias(size))
    return joined.select(*out)


def _frame(window, id: str, frame: str):
    if frame == "rows":
        return window.orderBy(_KEY, id).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return window.orderBy(_KEY).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def _offsets(keyed: DataFrame, by: list[str], measures: list[str], frame: str) -> DataFrame:
    """Per bucket (and group): totals of the earlier buckets, and for the range frame the
    totals of the rows in later buckets that equal this bucket's upper split value."""
    aggs = [F.sum(c).alias(c) for c in measures]
    if frame == "range":
        aggs += [F.sum(F.when(F.col("_low_peer"), F.col(c))).alias("low" + c) for c in measures]
        aggs += [F.first("_low_value").alias("_lower"), F.first("_high_value").alias("_upper")]
    totals = keyed.groupBy(_BUCKET, *by).agg(*aggs)
    earlier = (Window.partitionBy(*by).orderBy(_BUCKET)
               .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumns(
        {f"before_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in measures})
    if frame == "range":
        tail = (Window.partitionBy(*by, "_lower").orderBy(F.col(_BUCKET).desc())
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        following = Window.partitionBy(*by).orderBy(_BUCKET)
        totals = totals.withColumns({"tail" + c: F.sum("low" + c).over(tail) for c in measures})
        meets = F.lead("_lower").over(following).eqNullSafe(F.col("_upper"))
        totals = totals.withColumns({
            _CARRY + c: F.coalesce(F.when(meets, F.lead("tail" + c).over(following)), F.lit(0))
            for c in measures})
    totals = totals.withColumn("_whole", F.sum(_COUNT).over(Window.partitionBy(*by)))
    keep = [_BUCKET, *by, "_whole", *[f"before_{c}" for c in measures]]
    if frame == "range":
        keep += [_CARRY + c for c in measures]
    return totals.select(*keep)


def rank_within(df: DataFrame, by: Sequence[str], order: str, id: str, name: str = "rank",
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """SQL RANK() by descending `order` within each group, however large a group is.

    A group's size travels with the offsets, keyed by bucket and group, so the rows are
    never gathered by group alone.
    """
    staged = cut_lineage(df)
    scanned = _scan(staged, staged.count(), order, id, [], list(by), "range", False, rows_per_bucket, size="_size")
    return (scanned.withColumn(name, F.col("_size") - F.col("running_count") + 1)
            .drop("_size", "running_count", "row_number"))


def rows_at_ranks(staged: DataFrame, order: str, id: str, ranks: Sequence[int], n: int,
                  descending: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The (row_number, `_key`, id) rows at the given global positions.

    Only the buckets that hold a requested position are shuffled and sorted; the rest
    are merely counted. `staged` is read more than once and must be materialised.
    """
    rows = staged.select((-F.col(order) if descending else F.col(order)).alias(_KEY), F.col(id))
    wanted = F.col("row_number").isin(*[int(r) for r in ranks])
    buckets = _bucket_count(staged, n, rows_per_bucket)
    rows = _with_buckets(rows.withColumn(_COUNT, F.lit(1).cast("bigint")), [], id, n, buckets)
    totals = rows.groupBy(_BUCKET).agg(F.sum(_COUNT).alias("held"))
    before = F.coalesce(
        F.sum("held").over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    hit = F.exists(F.array(*[F.lit(int(r)).cast("bigint") for r in ranks]),
                   lambda r: (r > F.col("before")) & (r <= F.col("before") + F.col("held")))
    targets = totals.withColumn("before", before).where(hit).select(_BUCKET, "before")
    numbered = (rows.join(F.broadcast(targets), _BUCKET)
                .withColumn("row_number", F.col("before") + F.row_number().over(
                    Window.partitionBy(_BUCKET).orderBy(_KEY, id))))
    return numbered.where(wanted).select("row_number", _KEY, id)


def band_by_rank(staged: DataFrame, order: str, id: str, starts: Sequence[int], n: int,
                 descending: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """Band 1.. of a row, where band j+1 begins at global position `starts[j-1]`.

    Found by comparing the row with the boundary rows, so banding moves no data.
    """
    reachable = sorted({int(s) for s in starts if 1 < s <= n})
    below = sum(1 for s in starts if s <= 1)
    band = F.lit(1 + below)
    if not reachable:
        return band
    at = rows_at_ranks(staged, order, id, reachable, n, descending, rows_per_bucket)
    edges = at.agg(F.sort_array(F.collect_list(F.struct("row_number", _KEY, id)))).scalar()
    key = -F.col(order) if descending else F.col(order)
    for position, start in enumerate(reachable):
        edge = F.get(edges, F.lit(position))
        # structs compare with nulls first, as the window orders them
        reached = F.struct(key.alias(_KEY), F.col(id).alias(id)) >= F.struct(edge[_KEY].alias(_KEY), edge[id].alias(id))
        width = sum(1 for s in starts if s == start)
        band = band + F.when(reached, F.lit(width)).otherwise(F.lit(0))
    return band


def quantile_starts(n: int, k: int) -> list[int]:
    """First position of bands 2..k when position r falls in band max(1, ceil(k(r-1)/(n-1)))."""
    if n < 2:
        return [n + 1] * (k - 1)
    return [j * (n - 1) // k + 2 for j in range(1, k)]


def even_starts(n: int, k: int) -> list[int]:
    """First position of bands 2..k when band d holds positions (d-1)*n//k + 1 .. d*n//k."""
    return [j * n // k + 1 for j in range(1, k)]


def quantile_score(df: DataFrame, scores: dict[str, tuple[str, bool]], id: str, k: int = 5,
                   eligible: Column | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add k-quantile scores: `scores` maps output name to (column, reverse).

    Bands follow the position among the eligible rows, ties by `id`; other rows get 0.
    """
    staged = cut_lineage(df)
    rows = staged if eligible is None else staged.where(eligible)
    n = rows.count()
    out = {}
    for name, (column, reverse) in scores.items():
        band = band_by_rank(rows, column, id, quantile_starts(n, k), n,
                            rows_per_bucket=rows_per_bucket)
        band = (F.lit(k + 1) - band) if reverse else band
        out[name] = band if eligible is None else F.when(eligible, band).otherwise(F.lit(0))
    return staged.withColumns(out)


def even_bands(df: DataFrame, order: str, id: str, k: int, name: str, descending: bool = True,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add `name`: k bands of consecutive positions, the leading band first."""
    staged = cut_lineage(df)
    n = staged.count()
    band = band_by_rank(staged, order, id, even_starts(n, k), n, descending, rows_per_bucket)
    return staged.withColumn(name, band)


def cumulative_share(df: DataFrame, value: str, id: str, frame: str = "rows",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Running sum of `value` from the largest down, with `grand_total` and `total_rows`."""
    staged = cut_lineage(df)
    n = staged.count()
    scanned = _scan(staged, n, value, id, [value], [], frame, True, rows_per_bucket)
    return (with_totals(scanned, {"grand_total": F.sum(value)}, source=staged)
            .withColumn("total_rows", F.lit(n).cast("bigint")))


def with_totals(df: DataFrame, aggs: dict[str, Column], source: DataFrame | None = None) -> DataFrame:
    """Attach one-row aggregates of `source` (default: the frame itself) to every row.

    The aggregates are scalar subqueries: no window over everything and no join.
    """
    source = df if source is None else source
    return df.withColumns({name: source.agg(agg.alias(name)).scalar() for name, agg in aggs.items()})


def share_of_total(df: DataFrame, value: str, name: str, digits: int | None = 2,
                   group_rows: bool = True) -> DataFrame:
    """Add `name`: the row's percentage of the sum of `value`.

    `group_rows` says the frame is a finished report with one row per category, where a
    window over those few rows is cheaper than computing the groups again. Otherwise the
    total is a scalar subquery.
    """
    if group_rows:
        whole = F.sum(value).over(Window.partitionBy())
        return df.withColumn(name, ratio(value, whole, scale=100, digits=digits))
    return (with_totals(df, {"_whole": F.sum(value)})
            .withColumn(name, ratio(value, "_whole", scale=100, digits=digits)).drop("_whole"))


def top_k(df: DataFrame, order: str, tie: str, k: int) -> DataFrame:
    """The k rows with the largest `order`, ties by `tie`: a per-task heap, then a merge."""
    return df.orderBy(F.col(order).desc_nulls_last(), F.col(tie)).limit(k)


def top_k_within(df: DataFrame, by: Sequence[str], order: str, tie: str, k: int,
                 name: str = "position") -> DataFrame:
    """The k leading rows per group; each task drops rows beyond k before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc_nulls_last(), F.col(tie))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def top_ranked(df: DataFrame, order: str, k: int, name: str = "rank_overall") -> DataFrame:
    """Rows whose global RANK() by descending `order` is at most k, ties included."""
    w = Window.orderBy(F.col(order).desc_nulls_last())
    return df.withColumn(name, F.rank().over(w)).where(F.col(name) <= k)
