"""Dense order numbers, made once per load, by which distinct counts fold best.

functions.distinct keeps 64 neighbouring numbers in one word. Order ids as they are
delivered lie far apart within a customer; numbered by customer and order, a customer's
orders share words, so that what is folded by customer has few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.operators import tables
from starmill.plans.star import Star
from starmill.scratch import stage

_WITHIN = (1 << 33) - 1  # a row's place within its partition, in Spark's rising ids
SHARE_ROWS = 1 << 20  # sales of a year that one task numbers, sorts and writes: some 150 MB
_SLOTS = 64  # a year's slot is its remainder; the last is for sales without a date


def order_numbers(sales: DataFrame, *carried: Column) -> DataFrame:
    """(order_id, order_no): numbers from 0 without a gap, in the order of the least customer and the order id.

    ``carried`` are aggregates of an order's sales that go with its number. The orders are sorted by
    ranges, which split a customer with many of them, and counted
    per range; only these counts, one per partition, meet in one place.
    """
    orders = sales.filter("order_id is not null").groupBy("order_id").agg(F.min("customer_id").alias("customer_id"), *carried)
    more = orders.columns[2:]
    sorted_orders = orders.repartitionByRange("customer_id", "order_id").sortWithinPartitions("customer_id", "order_id")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))
    # written, so that the places stay what they are
    placed = stage(sorted_orders.select("order_id", *more, F.spark_partition_id().alias("part"), place.alias("place")), "order-places")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("orders"))
    first = counts.select("part", F.coalesce(F.sum("orders").over(before), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(first), "part").select("order_id", (F.col("first") + F.col("place")).alias("order_no"), *more)


def _shares(sales: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """The slots in use; for every slot how many tasks share its sales, and the first of them."""
    rows = {r.slot: r["count"] for r in sales.groupBy("slot").count().collect()}  # at most one row per slot
    shares = [-(-rows.get(slot, 0) // SHARE_ROWS) for slot in range(_SLOTS)]
    return sorted(rows), shares, [sum(shares[:slot]) for slot in range(_SLOTS)]


def numbered_sales(sales: DataFrame) -> DataFrame:
    """Stored sales with ``order_no`` and their year, dealt and sorted as their files are to be.

    Full sales are shuffled once: dealt by year and by a hash of the order, they meet their numbers in
    the task that is to write them, one file for each share of a year. A number goes to every year its order
    has sales in, which a bitmap of slots tells. An order's sales of one year share a task.
    """
    names = sales.columns
    slot = F.coalesce(F.pmod(F.year("date_id"), F.lit(_SLOTS - 1)), F.lit(_SLOTS - 1))
    slotted = sales.withColumn("slot", slot)
    used, shares, first = _shares(slotted)

    def part(key: Column) -> Column:
        of_slot = lambda values: F.get(F.array(*map(F.lit, values)), F.col("slot"))
        return (of_slot(first) + F.pmod(key, F.greatest(of_slot(shares), F.lit(1)))).cast("int").alias("part")

    # sales without an order have no number to meet, so any hash deals them
    own = F.when(F.col("order_id").isNull(), F.xxhash64(*names)).otherwise(F.xxhash64("order_id"))
    in_slot = [F.when(F.shiftright("slots", s).bitwiseAND(1) != 0, F.lit(s)) for s in used or [0]]
    numbers = order_numbers(slotted, F.expr("bit_or(shiftleft(1L, slot))").alias("slots"))
    numbers = numbers.select("order_id", "order_no", F.explode(F.array_compact(F.array(*in_slot))).alias("slot"))
    numbers = numbers.select("order_id", "order_no", part(F.xxhash64("order_id")))
    tasks = max(1, sum(shares))
    met = slotted.select(*names, part(own)).repartitionById(tasks, "part").join(numbers.repartitionById(tasks, "part"), ["part", "order_id"], "left")
    return tables.with_sale_year(met.select(*names, "order_no")).sortWithinPartitions(tables.SALE_YEAR, "date_id")


def numbered_star(star: Star, path: str) -> Star:
    """The star with its sales stored at ``path`` with ``order_no``, split by year and sorted by date as enriched sales are."""
    sales = star.sales.select(*[c for c in star.sales.columns if c not in ("order_no", tables.SALE_YEAR, "load")])
    numbered = numbered_sales(stage(sales, "sales-to-number"))  # read for the slots, the numbers and the files
    numbered.write.partitionBy(tables.SALE_YEAR).parquet(path)
    stored = sales.sparkSession.read.schema(numbered.schema).parquet(path)
    return Star(**{**{name: getattr(star, name) for name in tables.DIMENSIONS}, "sales": stored})
