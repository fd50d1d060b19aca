"""Products bought together: the pairs shared by the most customers.

The pairs in a basket (one customer, one day) grow with the square of its
size, so the literal self-join cannot be left to run as written. The answer is
the same; what differs is how many pairs are ever built:

1. Repeated products are folded: ``n`` copies with sum ``a`` meeting ``m``
   copies with sum ``b`` add ``a*m + b*n``, which is what all ``n*m`` row pairs
   would add.
2. Counting the pairs among the best-selling products alone gives a floor: the
   winners are shared by at least that many customers. A product with fewer
   customers cannot be in a winning pair and is left out.
3. The pairs of the few customers with the very largest baskets are not built.
   Those built from all other baskets are looked up in the large ones instead.
   A pair missed that way belongs to the customers set aside alone. They are
   fewer than the floor, so it cannot win. Where the best sellers give no floor,
   the last winner found has to have more customers than were set aside.
4. Other large baskets are cut into chunks that different tasks pair up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.joins import broadcast_if_fits
from starmill.plans.star import Star
from starmill.scratch import stage

BASKET = ["customer_id", "date_id"]
PAIR = ["product1", "product2"]
# Best sellers paired for the floor; at most 64 * 63 / 2 pairs per basket.
SEEDS = 64
# Products from which on a basket counts as large.
LARGE_BASKET = 500
# Customers whose pairs are looked up instead of built.
MAX_LOOKED_UP = 20


def _lines(sales: DataFrame) -> DataFrame:
    """One row per basket and product."""
    return (
        sales.select(*BASKET, "product_id", "total_amount")
        .dropna(subset=[*BASKET, "product_id"])
        .groupBy(*BASKET, "product_id")
        .agg(
            # a NULL amount adds no revenue but still counts as bought
            F.count("total_amount").alias("copies"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).alias("amount"),
        )
    )


def _side(lines: DataFrame, number: int, *extra: str) -> DataFrame:
    return lines.select(
        *BASKET,
        *extra,
        F.col("product_id").alias(f"product{number}"),
        F.col("copies").alias(f"copies{number}"),
        F.col("amount").alias(f"amount{number}"),
    )


def _per_pair(pairs: DataFrame) -> DataFrame:
    copies1, copies2 = F.col("copies1"), F.col("copies2")
    revenue = F.col("amount1") * copies2 + F.col("amount2") * copies1
    return pairs.groupBy(*PAIR).agg(
        F.count_distinct("customer_id").alias("times"),
        F.sum(F.when((copies1 > 0) & (copies2 > 0), revenue)).alias("revenue"),
    )


def _pairs(lines: DataFrame, large: DataFrame | None = None, chunk: int = 0) -> DataFrame:
    """Ordered product pairs of every basket.

    ``large`` lists the baskets (with their ``products``) to be cut up: about
    ``chunk`` left rows at a time meet a copy of the whole basket.
    """
    on = BASKET
    left = right = lines
    if large is not None:
        on = [*BASKET, "chunk"]
        chunks = F.coalesce(F.ceil(F.col("products") / chunk), F.lit(1)).cast("int")
        sized = lines.join(large, BASKET, "left").withColumn("chunks", chunks)
        left = sized.withColumn("chunk", F.pmod(F.xxhash64("product_id"), "chunks").cast("int"))
        right = sized.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return _side(left, 1, *on[2:]).join(_side(right, 2, *on[2:]), on).filter("product1 < product2")


def _last_winner(pairs: DataFrame, limit: int) -> int:
    """Customers of the last of the ``limit`` best pairs; 0 if there are fewer."""
    best = pairs.orderBy(F.desc("times")).limit(limit)
    found = best.agg(F.count("*").alias("pairs"), F.min("times").alias("times")).first()
    return found["times"] if found["pairs"] == limit else 0


def q16_product_affinity(
    star: Star,
    limit: int = 5,
    seeds: int = SEEDS,
    large_basket: int = LARGE_BASKET,
    max_looked_up: int = MAX_LOOKED_UP,
) -> DataFrame:
    lines = stage(_lines(star.sales), "affinity-lines")
    support = stage(
        lines.groupBy("product_id").agg(F.count_distinct("customer_id").alias("customers")), "affinity-support"
    )
    best = support.orderBy(F.desc("customers"), "product_id").limit(seeds).select("product_id")
    seed_lines = lines.join(F.broadcast(best), "product_id", "left_semi")
    floor = _last_winner(_per_pair(_pairs(seed_lines)), limit)
    if floor > 1:
        frequent = support.filter(F.col("customers") >= floor).select("product_id")
        lines = stage(lines.join(broadcast_if_fits(frequent), "product_id", "left_semi"), "affinity-frequent")

    large = stage(
        lines.groupBy(*BASKET).agg(F.count("*").alias("products")).filter(F.col("products") > large_basket),
        "affinity-large",
    )
    if large.isEmpty():
        pairs = _per_pair(_pairs(lines))
    else:
        pairs = _pairs_with_large(lines, large, large_basket, limit, max_looked_up, floor)
    return (
        pairs.select(
            *PAIR,
            F.col("times").alias("times_bought_together"),
            F.col("revenue").alias("combined_revenue"),
        )
        .orderBy(F.desc("times_bought_together"), F.desc("combined_revenue"), *PAIR)
        .limit(limit)
    )


def _pairs_with_large(
    lines: DataFrame, large: DataFrame, chunk: int, limit: int, max_looked_up: int, floor: int
) -> DataFrame:
    """Pairs that include the ``limit`` best, where some baskets are large."""
    # fewer than the floor, and the winners are certain; without a floor the result must show it
    most = min(max_looked_up, floor - 1) if floor > 1 else max_looked_up
    largest = (
        large.groupBy("customer_id")
        .agg(F.max("products").alias("products"))
        .orderBy(F.desc("products"), "customer_id")
        .limit(most)
    )
    aside = [row["customer_id"] for row in largest.collect()]  # at most max_looked_up ids
    if floor > len(aside) > 0:
        return _looked_up(lines, large, chunk, limit, aside)
    if aside:
        pairs = stage(_looked_up(lines, large, chunk, limit, aside), "affinity-pairs")
        if _last_winner(pairs, limit) > len(aside):
            return pairs
    return _per_pair(_pairs(lines, large, chunk))


def _looked_up(
    lines: DataFrame, large: DataFrame, chunk: int, limit: int, aside: list[int]
) -> DataFrame:
    """Pairs built without the customers ``aside``, then completed with theirs."""
    is_aside = F.col("customer_id").isin(aside)
    built = stage(_per_pair(_pairs(lines.filter(~is_aside), large, chunk)), "affinity-built")
    # Those set aside can add one customer each.
    least = _last_winner(built, limit) - len(aside)
    built = built.filter(F.col("times") >= least)
    rest = lines.filter(is_aside)
    found = _per_pair(
        built.select(*PAIR).join(_side(rest, 1), "product1").join(_side(rest, 2), [*BASKET, "product2"])
    )
    more = found.withColumnsRenamed({"times": "more", "revenue": "extra"})
    return built.join(more, PAIR, "left").select(
        *PAIR,
        (F.col("times") + F.coalesce("more", F.lit(0))).alias("times"),
        # NULL only if neither side has a revenue
        F.coalesce(F.col("revenue") + F.col("extra"), "revenue", "extra").alias("revenue"),
    )
