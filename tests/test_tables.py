"""Files, stored tables, constraints."""

from __future__ import annotations

import datetime as dt

import pytest
from test_olap import make_star

from starmill import schemas, scratch
from starmill.operators import cleaning, loads, quality, tables
from starmill.plans import olap
from starmill.scratch import scratch_path, stage
from starmill.sources import files, sample

SALES = [
    (1, 1, "a", "2016-06-01", 1, 5),
    (2, 9, "zz", "2017-01-02", 1, 10, 7, 1),
    (3, 1, "a", None, 1, 15, None, None),
    (3, 1, "b", "2017-01-02", 1, 20, 2, 9),
]


def write_lines(spark, path, lines):
    text = "\n".join(lines)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)


def test_transactions_file(spark):
    path = scratch_path(spark, "csv")
    head = "orderID,Customer_ID,Product_ID,quantity,date"
    write_lines(spark, path, [head, "1,7,p1,3.0,2017-01-02", "2,NULL,p1,n/a,bad", "3,8,,2", '4,8,"p,2",,2017-02-30'])
    rows = {r.orderID: r for r in files.read_transactions(spark, path).collect()}
    assert (rows["1"].quantity, rows["1"].date) == ("3.0", "2017-01-02")
    assert (rows["2"].Customer_ID, rows["2"].quantity, rows["2"].date) == (None, None, "bad")
    assert (rows["3"].Product_ID, rows["3"].date) == (None, None)
    kept = {r.order_id: r for r in cleaning.clean_transactions(files.read_transactions(spark, path)).kept.collect()}
    assert (kept[1].quantity, kept[4].product_id, kept[4].quantity, kept[4].date_id) == (3, "p,2", 1, None)
    assert set(kept) == {1, 4}


def test_first_copy_is_the_first_line_across_splits(spark):
    path = scratch_path(spark, "csv")
    lines = [f"{i % 50},{i},p,1,2017-01-02" for i in range(5000)]
    write_lines(spark, path, ["orderID,Customer_ID,Product_ID,quantity,date", *lines])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        raw = files.read_transactions(spark, path)
        assert raw.rdd.getNumPartitions() > 5
        kept = cleaning.clean_transactions(raw).kept.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.order_id, r.customer_id) for r in kept) == [(i, i) for i in range(50)]


def test_master_files(spark):
    path = scratch_path(spark, "csv")
    write_lines(spark, path, [",".join(schemas.PRODUCT_FILE.names), "p1, toys ,2.5,1,2,north-hill shop,acme"])
    (row,) = cleaning.clean_products(files.read_products(spark, path)).collect()
    assert (row.product_category, float(row.unit_price), row.store_id, row.supplier_id) == ("Toys", 2.5, 1, 2)
    assert (row.store_name, row.supplier_name) == ("North-Hill Shop", "Acme")
    path = scratch_path(spark, "csv")
    write_lines(spark, path, [",".join(schemas.CUSTOMER_FILE.names), "1,F,,3, c ,2,1"])
    (row,) = cleaning.clean_customers(files.read_customers(spark, path)).collect()
    assert (row.gender, row.age, row.age_group, row.city_category, row.marital_status) == (
        "Female",
        "Unknown",
        None,
        "C",
        "Married",
    )


def test_loads_append_and_recreate_empties(spark, tiny):
    path = scratch_path(spark, "dim")
    suppliers = sample.suppliers(spark, tiny)
    for copies in (1, 2):
        tables.append(suppliers, path, schemas.DIM_SUPPLIER)
        assert tables.read(spark, path, schemas.DIM_SUPPLIER).count() == copies * suppliers.count()
    tables.recreate(spark, path, schemas.DIM_SUPPLIER)
    empty = tables.read(spark, path, schemas.DIM_SUPPLIER)
    assert (empty.count(), empty.columns) == (0, ["supplier_id", "supplier_name"])


@pytest.fixture(scope="module")
def warehouse(spark, tiny):
    base = scratch_path(spark, "warehouse")
    star = sample.SampleStar(spark, tiny)
    loads.load_dimensions({name: getattr(star, name) for name in tables.DIMENSIONS}, base)
    tables.append_enriched(star.sales, f"{base}/fact_sales_enriched")
    return base


@pytest.mark.parametrize(
    "query",
    [
        lambda s: olap.q09_monthly_growth_category(s, 1998),
        olap.q02_demographics_city,
        olap.q20_store_quarterly_sales,
    ],
)
def test_stored_warehouse_answers_alike(spark, tiny, warehouse, query):
    stored = sorted(map(str, query(tables.stored_star(spark, warehouse)).collect()))
    assert stored == sorted(map(str, query(sample.SampleStar(spark, tiny)).collect()))


def test_sales_without_a_date_are_stored(spark):
    path = scratch_path(spark, "fact")
    tables.append_enriched(make_star(spark, SALES).sales, path)
    stored = tables.read_enriched(spark, path)
    assert sorted((r.order_id, r.sale_year) for r in stored.filter("sale_year is not null").collect()) == [
        (1, 2016),
        (2, 2017),
        (3, 2017),
    ]
    assert stored.count() == 4


def test_load_time_is_stamped(spark):
    before = dt.datetime.now() - dt.timedelta(days=1)
    row = tables.with_load_time(spark.range(1)).first()
    assert before < row.load_time


def test_view_preview_and_description(spark):
    view = tables.create_view(make_star(spark, SALES).dim_store, "stores_under_test")
    assert [r.store_id for r in tables.preview(view, 1).collect()] == [1]
    assert tables.count_rows(view).first().row_count == 2
    rows = tables.describe(spark, "stores_under_test").collect()
    assert [(r.col_name, r.data_type) for r in rows] == [
        ("store_id", "int"),
        ("store_name", "string"),
        ("region", "string"),
    ]


def test_orphans_by_key(spark):
    rows = {r.foreign_key: r.orphan_rows for r in quality.fk_orphans(make_star(spark, SALES)).collect()}
    assert rows == {"customer_id": 1, "product_id": 1, "store_id": 1, "supplier_id": 1, "date_id": 0}


def test_orphans_of_an_empty_fact(spark):
    star = make_star(spark, [])
    assert {r.orphan_rows for r in quality.fk_orphans(star).collect()} == {0}
    assert quality.fk_orphans(star).count() == 5


def test_foreign_key_policy(spark):
    rows = sorted(quality.fk_set_null(make_star(spark, SALES)).collect(), key=lambda r: r.total_amount)
    assert [(r.store_id, r.supplier_id) for r in rows] == [(1, 1), (None, 1), (None, None), (2, None)]
    assert [(r.customer_missing, r.product_missing, r.date_missing) for r in rows] == [
        (0, 0, 0),
        (1, 1, 0),
        (0, 0, 0),
        (0, 0, 0),
    ]


def test_key_and_null_checks(spark):
    star = make_star(spark, SALES)
    tables_ = {"fact_sales": star.sales, "dim_store": star.dim_store}
    keys = {r.table_name: (r.duplicate_keys, r.surplus_rows) for r in quality.pk_violations(tables_).collect()}
    assert keys == {"fact_sales": (1, 1), "dim_store": (0, 0)}
    nulls = {(r.table_name, r.column_name): r.null_rows for r in quality.not_null_violations(tables_).collect()}
    assert nulls["fact_sales", "date_id"] == 1
    assert sum(nulls.values()) == 1


def test_completion_needs_rows(spark):
    star = make_star(spark, [])
    rows = quality.completion_report({"fact": star.sales, "dim": star.dim_store}).collect()
    assert {r.table_name: (r.row_count, r.is_complete) for r in rows} == {"fact": (0, 0), "dim": (2, 1)}


class FakeSession:
    def __init__(self, **conf):
        self.settings = {k.replace("_", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_is_the_clusters():
    shared = FakeSession(spark_checkpoint_dir="s3://bucket/tmp/", spark_master="yarn")
    assert scratch.scratch_path(shared, "x").startswith("s3://bucket/tmp/x-")
    assert scratch.scratch_path(shared, "x") != scratch.scratch_path(shared, "x")
    with pytest.raises(RuntimeError):
        scratch.scratch_root(FakeSession(spark_master="yarn"))
    assert scratch.scratch_root(FakeSession(spark_master="local[2]"))


def test_stage_reads_back_what_it_wrote(spark):
    df = spark.createDataFrame([(1, dt.date(2017, 1, 2))], "a int, b date")
    staged = stage(df, "test")
    assert staged.schema == df.schema
    assert staged.collect() == df.collect()
