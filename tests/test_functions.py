from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import distinct
from starmill.functions.calendar import calendar_attributes
from starmill.functions.coerce import to_date, to_key, to_number
from starmill.functions.median import exact_median
from starmill.functions.text import strip, title_case


def _apply(spark, function, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


TEXTS = [
    "o'brien toys",
    "wal-mart  store",
    " 3m hub\t",
    "ÉLAN x",
    "tech2u",
    None,
    "",
    "ßa straße",
    "ΑΣ ΟΔΟΣ",
    "中a b",
    "ﬁsh ǆ",
]


def test_title_case_starts_every_run_of_letters(spark):
    assert _apply(spark, title_case, TEXTS) == [t if t is None else t.title() for t in TEXTS]


def test_normalised_names(spark):
    normalise = lambda c: strip(title_case(c))
    assert _apply(spark, normalise, TEXTS[:6]) == [
        "O'Brien Toys",
        "Wal-Mart  Store",
        "3M Hub",
        "Élan X",
        "Tech2U",
        None,
    ]


def test_strip_knows_every_blank(spark):
    texts = [" a b ", "\x1cq\x1f", "\n x \r\n", "　", None]
    assert _apply(spark, strip, texts) == [t if t is None else t.strip() for t in texts]


def test_numbers(spark):
    texts = ["3.0", " 7 ", "1e3", "-1", "n/a", "nan", "", None, "2.7"]
    expected = [3, 7, 1000, -1, None, None, None, None, Decimal("2.7")]
    assert _apply(spark, to_number, texts) == expected


def test_keys(spark):
    texts = ["7", "7.0", str(2**60 + 1), "x", None]
    assert _apply(spark, to_key, texts) == [7, 7, 2**60 + 1, None, None]


def test_dates(spark):
    texts = ["2017-01-31", "2017-02-30", "not-a-date", "", None, "2017-03-04 10:11:12"]
    expected = [dt.date(2017, 1, 31), None, None, None, None, dt.date(2017, 3, 4)]
    assert _apply(spark, to_date, texts) == expected


def test_calendar(spark):
    days = [dt.date(2016, 12, 31), dt.date(2017, 1, 1), dt.date(2018, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.withColumns(calendar_attributes(F.col("d"))).orderBy("d").collect()
    assert [r.day_of_week for r in rows] == [6, 7, 1]
    assert [r.is_weekend for r in rows] == [1, 1, 0]
    # ISO week next to the calendar year
    assert [r.week_of_year for r in rows] == [52, 52, 1]
    assert [r.year for r in rows] == [2016, 2017, 2018]
    assert rows[0].month_name == "December"
    assert rows[0].is_holiday == 0


def test_seasons(spark):
    df = spark.range(1, 13).select(F.make_date(F.lit(2017), "id", F.lit(1)).alias("d"))
    rows = df.withColumns(calendar_attributes(F.col("d"))).orderBy("month").collect()
    expected = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert [r.season for r in rows] == expected


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.decimals(-5_000_000, 5_000_000, places=2) | st.sampled_from([Decimal("1.50"), Decimal(9)]),
        min_size=1,
        max_size=60,
    )
)
def test_median_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v decimal(20,6)")
    got = spark.range(1).select(exact_median(df, "v")).first()[0]
    assert got == statistics.median(values)


def test_median_of_a_value_that_holds_a_third(spark):
    values = [Decimal(5)] * 40 + [Decimal(i) / 100 for i in range(100, 180)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,6)")
    assert spark.range(1).select(exact_median(df, "v")).first()[0] == statistics.median(values)


def test_median_of_values_over_many_magnitudes(spark):
    rng = random.Random(11)
    values = [Decimal(rng.randint(1, 10 ** rng.randint(1, 18))).scaleb(-6) for _ in range(4001)] + [Decimal("0.000001")] * 9
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,6)")
    assert spark.range(1).select(exact_median(df, "v", parts=7, few=5)).first()[0] == statistics.median(values)


def test_dates_in_many_forms(spark):
    texts = {
        "2017-01-15": "2017-01-15", "1/15/2017": "2017-01-15", "20170115": "2017-01-15", "15/1/2017": "2017-01-15",
        "15.1.2017": "2017-01-15", "Jan 15, 2017": "2017-01-15", "2017-02-30": None, "2/30/2017": None, "soon": None, " 2017-1-5 ": "2017-01-05",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", to_date(F.col("t")).cast("string").alias("d"))
    assert {r.t: r.d for r in df.collect()} == texts


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v decimal(20,6)")
    assert spark.range(1).select(exact_median(df, "v")).first()[0] is None


@pytest.mark.parametrize("text", ["a" * 50_000 + " b", " " * 1000 + "x"])
def test_long_texts_are_taken_whole(spark, text):
    assert _apply(spark, title_case, [text]) == [text.title()]


def test_distinct_counts_by_bitmaps(spark):
    rows = [("a", k) for k in (0, 0, 1, 63, 64, -1, -64, -65, 2**62, -(2**63), 2**63 - 1, None)] + [("b", None), ("c", 7), (None, 7), (None, 7)]
    df = spark.createDataFrame(rows, "g string, n long").repartition(4)
    # folded, and folded again
    words = df.groupBy("g", distinct.word("n")).agg(distinct.bits("n"))
    again = words.union(words).groupBy("g", distinct.WORD).agg(distinct.united())
    for folded in (words, again):
        made = {r.g: r.n for r in folded.groupBy("g").agg(distinct.counted().alias("n")).collect()}
        assert made == {"a": 10, "b": 0, "c": 1, None: 1}
