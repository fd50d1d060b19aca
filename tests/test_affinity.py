"""The pruned search for pairs against all pairs."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal
from itertools import product

import pytest
from test_olap import make_star

from starmill.plans import affinity
from starmill.plans.affinity import q16_product_affinity


def brute_force(sales, limit):
    baskets = defaultdict(list)
    for _, customer, item, day, _, amount in sales:
        if None not in (customer, item, day):
            baskets[customer, day].append((item, Decimal(amount)))
    customers, revenue = defaultdict(set), defaultdict(Decimal)
    for (customer, _), lines in baskets.items():
        for (a, x), (b, y) in product(lines, lines):
            if a < b:
                customers[a, b].add(customer)
                revenue[a, b] += x + y
    ranked = sorted(((-len(customers[p]), -revenue[p], p) for p in customers))[:limit]
    return [(*p, -times, -total) for times, total, p in ranked]


def run(spark, sales, limit=5, **parameters):
    rows = q16_product_affinity(make_star(spark, sales), limit, **parameters).collect()
    return [tuple(r) for r in rows]


def test_repeated_rows_count_in_revenue_only(spark):
    sales = [(1, 1, "a", "2017-01-01", 1, 3), (2, 1, "a", "2017-01-01", 1, 4), (3, 1, "b", "2017-01-01", 1, 10)]
    assert run(spark, sales) == [("a", "b", 1, Decimal(27))]


def test_nothing_bought_together(spark):
    assert run(spark, [(1, 1, "a", "2017-01-01", 1, 3), (2, 1, "b", "2017-01-02", 1, 4)]) == []


def random_sales(seed, customers, items, hot):
    """Random baskets; one customer's single basket holds a third of the rows."""
    rng = random.Random(seed)
    names = [f"p{i:02d}" for i in range(items)]
    weights = [1 / (i + 1) for i in range(items)]
    sales = []
    for _ in range(2 * hot):
        day = str(dt.date(2017, 1, rng.randint(1, 2)))
        sales.append((len(sales), rng.randint(1, customers), rng.choices(names, weights)[0], day, 1, rng.randint(1, 99)))
    for _ in range(hot):
        sales.append((len(sales), 1000, rng.choice(names), "2017-01-01", 1, rng.randint(1, 99)))
    sales.append((len(sales), None, "p00", "2017-01-01", 1, 5))
    sales.append((len(sales), 1, "p00", None, 1, 5))
    return sales


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "parameters",
    [
        {},
        {"seeds": 4},
        {"seeds": 4, "large_basket": 3},
        {"seeds": 8, "large_basket": 5, "max_looked_up": 1},
        {"seeds": 2, "large_basket": 2, "max_looked_up": 0},
    ],
    ids=str,
)
def test_all_ways_agree_with_all_pairs(spark, seed, parameters):
    sales = random_sales(seed, customers=12, items=20, hot=40)
    assert run(spark, sales, **parameters) == brute_force(sales, 5)


@pytest.fixture
def paired(monkeypatch):
    """The customers of each call that builds pairs."""
    calls = []
    pairs = affinity._pairs

    def watch(lines, *rest):
        calls.append({r.customer_id for r in lines.select("customer_id").distinct().collect()})
        return pairs(lines, *rest)

    monkeypatch.setattr(affinity, "_pairs", watch)
    return calls


def test_hot_customer_is_looked_up_not_paired(spark, paired):
    sales = random_sales(3, customers=12, items=20, hot=40)
    assert run(spark, sales, seeds=8, large_basket=10) == brute_force(sales, 5)
    # the first call pairs best sellers only
    assert 1000 in paired[0]
    assert all(1000 not in call for call in paired[1:])


def test_pairs_shared_with_the_hot_customer_alone(spark, paired):
    """No two other customers share a pair, so the best sellers give no floor."""
    sales = [(i, i // 2 + 1, f"p{i:02d}", "2017-01-01", 1, i) for i in range(20)]
    sales += [(100 + i, 1000, f"p{i:02d}", "2017-01-03", 1, i) for i in range(30)]
    assert run(spark, sales, seeds=2, large_basket=10) == brute_force(sales, 5)
    assert all(1000 not in call for call in paired[1:])


def test_pairs_of_the_hot_customer_are_built_if_they_can_win(spark, paired):
    sales = [(1, 1, "p01", "2017-01-01", 1, 5), (2, 1, "p02", "2017-01-01", 1, 5)]
    sales += [(100 + i, 1000, f"p{i:02d}", "2017-01-03", 1, i) for i in range(30)]
    assert run(spark, sales, seeds=2, large_basket=10) == brute_force(sales, 5)
    assert 1000 in paired[-1]


def test_two_hot_customers_share_the_winners(spark):
    sales = [(i, c, f"p{i:02d}", f"2017-01-0{c}", 1, i * c) for c in (1, 2) for i in range(15)]
    sales += [(200 + i, 3, f"p{i:02d}", "2017-01-01", 1, 1) for i in range(3)]
    assert run(spark, sales, seeds=2, large_basket=10) == brute_force(sales, 5)
    assert run(spark, sales, limit=2, seeds=2, large_basket=10) == brute_force(sales, 2)
