"""Delimited files: each query writes whole derived tables as files and scans them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom import schemas
from martloom.catalog import sqltext as S
from martloom.catalog.registry import comparable, register
from martloom.functions import sort_key
from martloom.plans.jobs import run_mart_file_job
from martloom.samples import tables as T
from martloom.samples.sql import with_tables
from martloom.sinks.delimited import as_line, write_delimited, write_delimited_by_key
from martloom.sinks.tables import append_rows, read_table, refresh_table
from martloom.sources.delimited import DelimitedFormat, scan_delimited, scan_with_rejects, schema_from_file
from martloom.sources.tables import table_source
from martloom.workspace import scratch_path

PLAIN = DelimitedFormat()
HEADED = DelimitedFormat(header=True)


def _select(source: str, where: str = "true") -> str:
    return with_tables(S.TABLE[source], f"SELECT * FROM {S.TABLE[source]} WHERE {where}")


def _stored(df: DataFrame, label: str, layout: DelimitedFormat = HEADED) -> str:
    path = scratch_path(df.sparkSession, label)
    write_delimited(df, path, layout)
    return path


@register("scan_delimited", _select("customer", S.FILES["customer"]))
def scan_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer file, which has no header line."""
    path = _stored(T.customer_dim(spark, sf_dir), "customer", PLAIN)
    return scan_delimited(spark, path, schemas.CUSTOMER_DIM, PLAIN)


@register("scan_header", _select("retail", S.FILES["retail"]))
def scan_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(T.retail_dim(spark, sf_dir), "retail")
    return scan_delimited(spark, path, schemas.RETAIL_DIM, HEADED)


def _spoilt(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Transaction lines of which some have text for a number, a column too few, or one too many."""
    rows = T.transactions_fact(spark, sf_dir)
    line = as_line(rows)
    key = F.col("productid")
    broken = (
        F.when(key % 50 == 1, F.concat(F.lit("x"), line))
        .when(key % 50 == 2, F.concat(line, F.lit(",7")))
        .when(key % 50 == 3, F.regexp_replace(line, ",[^,]*$", ""))
        .otherwise(line)
    )
    path = scratch_path(spark, label)
    rows.select(broken.alias("value")).write.text(path)
    return path


_WHOLE = f"{S.FILES['transactions']} AND productid % 50 NOT IN (1, 2, 3)"


@register("scan_reject_continue", _select("transactions", _WHOLE))
def scan_reject_continue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_delimited(spark, _spoilt(spark, sf_dir, "spoilt"), schemas.TRANSACTIONS_FACT, PLAIN)


@register(
    "scan_reject_output",
    with_tables(
        "transactions_fact",
        "SELECT reason, count(*) AS records FROM (SELECT CASE WHEN productid % 50 IN (2, 3) "
        "THEN 'record does not have 9 columns' WHEN productid % 50 = 1 THEN 'column stockid is not int' "
        "WHEN quantity IS NULL THEN 'column quantity is empty' WHEN customer_id IS NULL "
        "THEN 'column customer_id is empty' END AS reason FROM transactions_fact) AS x "
        "WHERE reason IS NOT NULL GROUP BY reason",
    ),
)
def scan_reject_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = scan_with_rejects(
        spark, _spoilt(spark, sf_dir, "spoilt"), schemas.TRANSACTIONS_FACT, PLAIN, reason="reason"
    )
    return rejected.groupBy("reason").agg(F.count("raw_record").alias("records"))


@register(
    "scan_file_pattern",
    with_tables("product_dim", f"SELECT * FROM product_dim WHERE {S.FILES['product']}"),
)
def scan_file_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three folders, two matched by one pattern and the third given by name."""
    root = scratch_path(spark, "products")
    products = T.product_dim(spark, sf_dir)
    for part in range(3):
        write_delimited(products.filter(F.col("productid") % 3 == part), f"{root}/part_{part}", HEADED)
    return scan_delimited(spark, [f"{root}/part_[01]", f"{root}/part_2"], schemas.PRODUCT_DIM, HEADED)


@register(
    "scan_source_name",
    with_tables(
        "product_dim",
        f"SELECT 'part_' || CAST(productid % 3 AS VARCHAR) AS folder, count(*) AS records FROM product_dim "
        f"WHERE {S.FILES['product']} GROUP BY productid % 3",
    ),
)
def scan_source_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "products")
    products = T.product_dim(spark, sf_dir)
    for part in range(3):
        write_delimited(products.filter(F.col("productid") % 3 == part), f"{root}/part_{part}", HEADED)
    rows = scan_delimited(spark, f"{root}/part_*", schemas.PRODUCT_DIM, HEADED, source_name="source_file")
    folder = F.regexp_extract("source_file", "/(part_[0-9]+)/[^/]*$", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("records"))


_RANGE = 2_000


def _sorted_orders(spark: SparkSession, sf_dir: str) -> str:
    """One file for each range of order numbers, in ascending order, so that SQL can say which record is which."""
    orders = T.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.col("o_orderpriority"), F.floor(F.col("o_orderkey") / _RANGE).alias("key_range")
    )
    path = scratch_path(spark, "orders")
    write_delimited_by_key(orders, path, ["key_range"], HEADED, order_by=[sort_key("o_orderkey")])
    return f"{path}/by_key_range=*"


_ORDERS = "o_orderkey BIGINT, o_orderpriority STRING, key_range BIGINT"
_NUMBERED = (
    "SELECT o_orderkey, o_orderpriority, "
    f"row_number() OVER (PARTITION BY o_orderkey // {_RANGE} ORDER BY o_orderkey) AS record FROM orders"
)


@register("scan_record_number", _NUMBERED)
def scan_record_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its number in its file."""
    schema = StructType.fromDDL(_ORDERS)
    return scan_delimited(spark, _sorted_orders(spark, sf_dir), schema, HEADED, record_number="record").drop("key_range")


@register("scan_first_n", f"SELECT o_orderkey, o_orderpriority FROM ({_NUMBERED}) AS x WHERE record <= 100")
def scan_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 records of each file."""
    schema = StructType.fromDDL(_ORDERS)
    return scan_delimited(spark, _sorted_orders(spark, sf_dir), schema, HEADED, first_rows=100).drop("key_range")


_EURO = "€Š"


@register(
    "scan_charset",
    "SELECT CAST(c_custkey AS INTEGER) AS customer_id, "
    f"'{_EURO}' || c_name || 'é' AS customername FROM customer",
)
def scan_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with characters that only code page 1252 has, written and read in it."""
    layout = DelimitedFormat(charset="windows-1252")
    named = T.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"),
        F.concat(F.lit(_EURO), F.col("c_name"), F.lit("é")).alias("customername"),
    )
    path = _stored(named, "charset", layout)
    return scan_delimited(spark, path, StructType.fromDDL("customer_id INT, customername STRING"), layout)


@register("scan_schema_file", _select("product", S.FILES["product"]))
def scan_schema_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "schema")
    text = spark.range(1).select(F.lit(schemas.PRODUCT_DIM.json()).alias("value"))
    text.write.text(f"{root}/schema")
    write_delimited(T.product_dim(spark, sf_dir), f"{root}/data", HEADED)
    return scan_delimited(spark, f"{root}/data", schema_from_file(spark, f"{root}/schema"), HEADED)


_NAMED_MARKETING = {
    "ID": "c_custkey",
    "Year_Birth": "1940 + c_custkey % 60",
    "Education": "c_mktsegment",
    "Marital_Status": "CASE WHEN c_custkey % 2 = 0 THEN 'Married' ELSE 'Single' END",
    "Income": "CASE WHEN c_custkey % 43 <> 0 THEN floor(abs(c_acctbal)) END",
    "Dt_Customer": "DATE '2012-07-30' + CAST(c_custkey % 700 AS INTEGER)",
    "Z_CostContact": "3",
    "Z_Revenue": "11",
}
_MARKETING_SQL = "SELECT {} FROM customer".format(
    ", ".join(
        "CAST({} AS {}) AS {}".format(
            _NAMED_MARKETING.get(f.name, f"(c_custkey * {i + 1}) % 97"),
            "INTEGER" if f.dataType.simpleString() == "int" else "VARCHAR",
            f.name,
        )
        for i, f in enumerate(schemas.MARKETING_CAMPAIGN)
    )
)


@register("marketing_scan", _MARKETING_SQL)
def marketing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(T.marketing_campaign(spark, sf_dir), "marketing")
    return comparable(scan_delimited(spark, path, schemas.MARKETING_CAMPAIGN, HEADED))


# --- sinks ------------------------------------------------------------------------------------------------


@register("sink_overwrite", _select("retail", S.FILES["retail"]))
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = T.retail_dim(spark, sf_dir)
    path = _stored(stores.filter("stockid < 10"), "stores")
    write_delimited(stores, path, HEADED, mode="overwrite")
    return scan_delimited(spark, path, schemas.RETAIL_DIM, HEADED)


@register("sink_append", _select("product", S.FILES["product"]))
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created with one half, appended with the other."""
    products = T.product_dim(spark, sf_dir)
    path = scratch_path(spark, "products")
    write_delimited(products.filter("productid % 2 = 0"), path, HEADED, mode="create")
    write_delimited(products.filter("productid % 2 = 1"), path, HEADED, mode="append")
    return scan_delimited(spark, path, schemas.PRODUCT_DIM, HEADED)


@register("sink_by_key", _select("transactions", S.FILES["transactions"]))
def sink_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by_country")
    write_delimited_by_key(T.transactions_fact(spark, sf_dir), path, ["country"], HEADED)
    return scan_delimited(spark, f"{path}/by_country=*", schemas.TRANSACTIONS_FACT, HEADED)


@register(
    "sort_null_order",
    with_tables(
        "customer_dim",
        "SELECT customertype, customer_id, age, row_number() OVER (PARTITION BY customertype "
        "ORDER BY age DESC NULLS FIRST, customer_id) AS record FROM customer_dim",
    ),
)
def sort_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written per customer type, sorted by age descending with nulls first, and read back with record numbers."""
    path = scratch_path(spark, "by_type")
    write_delimited_by_key(
        T.customer_dim(spark, sf_dir).select("customertype", "customer_id", "age"),
        path,
        ["customertype"],
        HEADED,
        order_by=[sort_key("age", descending=True, nulls="first"), sort_key("customer_id")],
    )
    schema = StructType.fromDDL("customertype STRING, customer_id INT, age INT")
    return scan_delimited(spark, f"{path}/by_customertype=*", schema, HEADED, record_number="record")


_ODD_SQL = (
    "SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN c_name || chr(10) || c_mktsegment WHEN 1 THEN chr(13) || c_name "
    "WHEN 2 THEN '\"' || c_name || '\",' WHEN 3 THEN c_name || chr(1) || chr(26) || 'n' WHEN 4 THEN '' WHEN 5 THEN NULL "
    "WHEN 6 THEN chr(2) || ' ' || c_name || ' ' ELSE c_name || '|' || chr(9) END AS odd FROM customer"
)


@register("sink_round_trip", _ODD_SQL)
def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with line breaks, quotes, separators and control characters, empty text and null, out and in again."""
    name, kind = F.col("c_name"), F.col("c_custkey") % 8
    odd = (
        F.when(kind == 0, F.concat(name, F.lit("\n"), "c_mktsegment"))
        .when(kind == 1, F.concat(F.lit("\r"), name))
        .when(kind == 2, F.concat(F.lit('"'), name, F.lit('",')))
        .when(kind == 3, F.concat(name, F.lit("\u0001\u001an")))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.lit(None))
        .when(kind == 6, F.concat(F.lit("\u0002 "), name, F.lit(" ")))
        .otherwise(F.concat(name, F.lit("|\t")))
    )
    layout = DelimitedFormat(header=True, line_breaks="escape")
    path = _stored(T.read(spark, sf_dir, "customer").select("c_custkey", odd.alias("odd")), "odd", layout)
    return scan_delimited(spark, path, StructType.fromDDL("c_custkey BIGINT, odd STRING"), layout)


# --- tables ---------------------------------------------------------------------------------------------------


@register("table_refresh", _select("retail"))
def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table filled, filled anew, and read by its declared columns."""
    name = f"retail_dim_{uuid.uuid4().hex}"
    stores = T.retail_dim(spark, sf_dir)
    refresh_table(stores.filter("stockid < 10"), name)
    refresh_table(stores.withColumn("undeclared", F.lit(1)), name)
    return table_source(spark, name, schemas.RETAIL_DIM)


@register("table_append", _select("product"))
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in two parts; the second lacks a column, which is null in its rows only."""
    path = scratch_path(spark, "appended")
    products = T.product_dim(spark, sf_dir)
    append_rows(products.filter("quantity IS NOT NULL"), path, schemas.PRODUCT_DIM)
    append_rows(products.filter("quantity IS NULL").drop("quantity"), path, schemas.PRODUCT_DIM)
    return read_table(spark, path, schemas.PRODUCT_DIM)


# --- the file-to-file job -------------------------------------------------------------------------------------


@register(
    "mart_file_job",
    S.mart(S.FILES, wanted="c.customertype IN ('citizen', 'foriegn')"),
)
def mart_file_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files in, the mart file out, and that read back."""
    sources = T.retail_sources(spark, sf_dir)
    paths = {name: _stored(df, name, PLAIN if name == "customer" else HEADED) for name, df in sources.items()}
    target = scratch_path(spark, "mart")
    run_mart_file_job(spark, paths, target)
    return scan_delimited(spark, target, schemas.RETAIL_DATA_MART, HEADED)

