"""The retail mart: transactions joined with customer, store and product, filtered and upper-cased."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.context import RunContext
from martloom.functions import all_of, date_or_null, int_or_null, is_customer_type, names_customer_type
from martloom.operators.statistics import count_rows
from martloom.plans.validation import lenient, source_rules, strict
from martloom.schemas import MART_COLUMNS

# Columns each side brings. The transaction's own quantity is not among them: the mart's is the product's.
CUSTOMER_PART = ("customer_id", "customername", "spending_score", "annual_incomek", "gender", "age", "customertype")
TRANSACTION_PART = ("stockid", "invoiceid", "description", "invoice_date", "price", "country", "productid")

# Join keys that must be present for a row to be loaded at all.
REQUIRED_KEYS = {
    "customer": ("customer_id",),
    "retail": ("stockid",),
    "transactions": ("customer_id", "stockid", "productid"),
    "product": ("productid",),
}


def with_integer_date(transactions: DataFrame) -> DataFrame:
    """The date text as a number, rounded where it has a fraction, as the warehouse casts it."""
    return transactions.withColumn("invoice_date", int_or_null("invoice_date", rounding=True))


def dated_on(transactions: DataFrame, day: date) -> DataFrame:
    """Transactions whose date text is a date, and this one."""
    return transactions.filter(date_or_null("invoice_date") == F.lit(day))


def join_customer(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    return transactions.join(customers, "customer_id").select(*CUSTOMER_PART, *TRANSACTION_PART)


def join_retail(rows: DataFrame, stores: DataFrame) -> DataFrame:
    return rows.join(stores, "stockid")


def join_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Adds the product columns. ``quantity`` afterwards is the product's."""
    carried = rows.drop("quantity") if "quantity" in rows.columns else rows
    return carried.join(products, "productid")


def assemble(sources: Mapping[str, DataFrame], wanted: Column) -> DataFrame:
    """The 23 business columns from staged sources. ``wanted`` selects customers and so is applied before the joins
    by the optimizer."""
    joined = join_customer(with_integer_date(sources["transactions"]), sources["customer"])
    joined = join_product(join_retail(joined, sources["retail"]), sources["product"])
    return joined.filter(wanted).withColumn("customername", F.upper("customername")).select(*MART_COLUMNS)


def stamp(mart: DataFrame, run: RunContext) -> DataFrame:
    return mart.withColumns({"batch_id": run.batch, "load_timestamp": run.now})


def staged_v1(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Sources whose rows have all their join keys."""
    return {
        name: df.filter(all_of(F.col(k).isNotNull() for k in REQUIRED_KEYS[name])) for name, df in sources.items()
    }


def mart_v1(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Only the join keys are checked."""
    return assemble(staged_v1(sources), names_customer_type("customertype"))


def mart_v2(sources: Mapping[str, DataFrame], run: RunContext) -> DataFrame:
    """Rows that break no validation rule."""
    rules = source_rules()
    staged = {name: lenient(df, rules[name]) for name, df in sources.items()}
    return stamp(assemble(staged, names_customer_type("customertype")), run)


def mart_v3(sources: Mapping[str, DataFrame], run: RunContext) -> DataFrame:
    """Rows that satisfy every validation rule: the canonical mart."""
    rules = source_rules()
    staged = {name: strict(df, rules[name]) for name, df in sources.items()}
    return stamp(assemble(staged, names_customer_type("customertype")), run)


def mart_from_files(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The file-to-file mart: no validation beyond the file schemas, customer type matched exactly."""
    return assemble(sources, is_customer_type("customertype"))


def transaction_counts(mart: DataFrame) -> DataFrame:
    """Transactions per customer and store."""
    return count_rows(mart, ("customer_id", "stockid"), "total_orders_num")
