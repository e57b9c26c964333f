"""Market baskets: products that are bought together.

A basket is the set of products of one order. Only products in enough orders can be part of
a frequent set, so the lines of all others leave before baskets are built; that is exact and
takes most of the lines of a long-tailed catalogue.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from tallyline.functions.columns import ratio
from tallyline.session import cut_lineage

MAX_ITEMS = 1_000
PAIRS_PER_TASK = 1_000_000


def basket_lines(lines: DataFrame, order: str = "order_id", product: str = "product_id",
                 min_orders: int = 2) -> DataFrame:
    """`order`, `product`, once each, of the products that are in at least `min_orders`
    orders. Lines without an order or a product belong to no basket."""
    once = lines.where(F.col(order).isNotNull() & F.col(product).isNotNull()).select(
        F.col(order).alias("order"), F.col(product).alias("product")).distinct()
    enough = once.groupBy("product").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_orders)
    return once.join(enough.select("product"), "product", "left_semi").select("order", "product")


def count_baskets(lines: DataFrame, order: str = "order_id") -> DataFrame:
    """One row: `n_baskets`, the orders that have a line."""
    return lines.agg(F.count_distinct(order).alias("n_baskets"))


def frequent_pairs(lines: DataFrame, order: str = "order_id", product: str = "product_id", min_orders: int = 2,
                   max_items: int = MAX_ITEMS) -> DataFrame:
    """`first`, `second` (first < second), `n_orders` with both, `support`, `confidence` of
    first to second, `lift`; pairs in at least `min_orders` orders.

    Baskets of up to `max_items` products become pairs row by row, inside one order's array.
    Larger ones are not gathered: their lines are dealt by product into blocks of bounded
    size, and blocks of one order meet pair by pair, so no task holds a whole basket. Both
    ways are exact, and their counts are added before the threshold is applied. Most pairs
    are rare, so a task that combines its pairs holds nearly all: the pairs to come are
    counted first, and tasks are as many as keep each to about `PAIRS_PER_TASK`.
    """
    held = cut_lineage(basket_lines(lines, order, product, min_orders))
    sizes = cut_lineage(held.groupBy("order").agg(F.count(F.lit(1)).alias("size")))
    large = sizes.where(F.col("size") > max_items)
    n_inside, n_far = _tasks(sizes, max_items)
    small = held.repartition(n_inside, "order").join(large, "order", "left_anti")
    baskets = small.groupBy("order").agg(F.sort_array(F.collect_list("product")).alias("items"))
    inside = F.flatten(F.transform("items", lambda a, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda b: F.struct(a.alias("first"), b.alias("second")))))
    pairs = baskets.select(F.explode(inside).alias("p")).select("p.*")

    # the number of blocks follows the size of the basket
    dealt = held.join(large, "order").withColumns(
        {"blocks": F.ceil(F.col("size") / max_items).cast("int")}).withColumn(
        "block", F.pmod(F.xxhash64("product"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = dealt.select("order", "block", F.explode(every).alias("other"), F.col("product").alias("first"))
    right = dealt.select("order", F.explode(every).alias("block"), F.col("block").alias("other"), F.col("product").alias("second"))
    meet = ["order", "block", "other"]
    far = left.repartition(n_far, *meet).join(right.repartition(n_far, *meet).hint("merge"), meet).where(F.col("first") < F.col("second")).select("first", "second")
    counted = (pairs.unionByName(far).groupBy("first", "second").agg(F.count(F.lit(1)).alias("n_orders"))
               .where(F.col("n_orders") >= min_orders))
    alone = held.groupBy("product").agg(F.count(F.lit(1)).alias("n"))
    return (counted.join(alone.select(F.col("product").alias("first"), F.col("n").alias("_a")), "first")
            .join(alone.select(F.col("product").alias("second"), F.col("n").alias("_b")), "second")
            .withColumn("_all", count_baskets(lines, order).scalar())
            .select("first", "second", "n_orders", ratio("n_orders", "_all").alias("support"),
                    ratio("n_orders", "_a").alias("confidence"),
                    ratio(F.col("n_orders") * F.col("_all"), F.col("_a") * F.col("_b")).alias("lift")))


def _tasks(sizes: DataFrame, max_items: int) -> tuple[int, int]:
    """How many tasks form pairs inside small baskets, and between the blocks of large ones."""
    size = F.col("size").cast("double")
    inside, far = sizes.agg(
        F.coalesce(F.sum(F.when(F.col("size") <= max_items, size * (size - 1) / 2)), F.lit(0.0)),
        F.coalesce(F.sum(F.when(F.col("size") > max_items, size * (size - 1) / 2)), F.lit(0.0))).first()
    return tuple(1 + int(n // PAIRS_PER_TASK) for n in (inside, far))


def frequent_sets(lines: DataFrame, order: str = "order_id", product: str = "product_id", min_orders: int = 2,
                  max_items: int = MAX_ITEMS) -> DataFrame:
    """`items` (sorted), `n_orders` of every product set in at least `min_orders` orders.

    Mined by parallel FP-growth. It needs a basket as one array, so the sizes are counted
    first; a basket of more than `max_items` products that are frequent themselves is an
    error, as sets of any length out of it would be too many in any case. `frequent_pairs`
    has no such limit.
    """
    held = cut_lineage(basket_lines(lines, order, product, min_orders))
    sizes = held.groupBy("order").agg(F.count(F.lit(1)).alias("size"))
    facts = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("largest")).first()
    if (facts["largest"] or 0) > max_items:
        raise ValueError(f"a basket of {facts['largest']} products; frequent_sets takes up to {max_items}, "
                         "raise max_items or min_orders, or use frequent_pairs")
    kind = held.schema["product"].dataType.simpleString()
    if not facts["n"]:
        return held.sparkSession.createDataFrame([], f"items array<{kind}>, n_orders bigint")
    baskets = cut_lineage(held.groupBy("order").agg(F.collect_list("product").alias("items")).select("items"))
    # the miner's threshold is a share; half an order less keeps the rounding on the safe side
    mined = FPGrowth(itemsCol="items", minSupport=(min_orders - 0.5) / facts["n"]).fit(baskets).freqItemsets
    return mined.select(F.sort_array("items").alias("items"), F.col("freq").alias("n_orders"))


def rules(sets: DataFrame, n_baskets: int, min_confidence: float = 0.0) -> DataFrame:
    """`antecedent`, `consequent` (one product), `n_orders`, `support`, `confidence`, `lift`.

    Every subset of a frequent set is frequent, so both sides of a rule are found among the
    sets themselves, by equality of the sorted items.
    """
    held = cut_lineage(sets)
    split = held.where(F.size("items") > 1).select("n_orders", F.explode(F.transform("items", lambda c: F.struct(
        F.array_remove("items", c).alias("antecedent"), c.alias("consequent")))).alias("r"), "items").select("n_orders", "r.*")
    before = held.select(F.col("items").alias("antecedent"), F.col("n_orders").alias("_a"))
    single = held.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("n_orders").alias("_c"))
    rated = split.join(before, "antecedent").join(single, "consequent").withColumn("_all", F.lit(n_baskets).cast("bigint"))
    return (rated.where(F.col("n_orders") >= F.col("_a") * min_confidence)
            .select("antecedent", "consequent", "n_orders", ratio("n_orders", "_all").alias("support"),
                    ratio("n_orders", "_a").alias("confidence"),
                    ratio(F.col("n_orders") * F.col("_all"), F.col("_a") * F.col("_c")).alias("lift")))
