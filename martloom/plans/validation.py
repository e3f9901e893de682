"""Row rules of the four retail sources, kept as data, and the two ways they are applied.

A rule has two conditions, both with SQL's three-valued logic: ``broken`` is true for a row to reject, ``kept``
is true for a row to load. For a null in a range-checked column neither is true, so one must never be
computed as the negation of the other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import all_of, any_of, has_text, int_or_null, is_blank

VALID = "VALID"

# The accepted spellings of a customer type.
CUSTOMER_TYPES = ("citizen", "foriegn", "Citizen", "Foriegn", "CITIZEN", "FORIEGN")


@dataclass(frozen=True)
class Rule:
    message: str
    broken: Column
    kept: Column


def present(column: str, message: str) -> Rule:
    return Rule(message, F.col(column).isNull(), F.col(column).isNotNull())


def filled(column: str, message: str) -> Rule:
    return Rule(message, is_blank(column), has_text(column))


def between(column: str, low: int, high: int, message: str) -> Rule:
    value = F.col(column)
    return Rule(message, (value < low) | (value > high), value.between(low, high))


def at_least(column: str, low: int, message: str) -> Rule:
    return Rule(message, F.col(column) < low, F.col(column) >= low)


def above(column: str, low: int, message: str) -> Rule:
    return Rule(message, F.col(column) <= low, F.col(column) > low)


def one_of(column: str, accepted: Sequence[str], message: str) -> Rule:
    return Rule(message, ~F.col(column).isin(*accepted), F.col(column).isin(*accepted))


def integer_text(column: str, message: str) -> Rule:
    number = int_or_null(column, rounding=True)
    return Rule(message, number.isNull(), number.isNotNull())


@dataclass(frozen=True)
class SourceRules:
    """A source table: its reported name, the column reported as its key, its columns and its ordered rules."""

    table: str
    key: str
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]

    def status(self) -> Column:
        """Message of the first broken rule, or VALID."""
        outcome = F.when(self.rules[0].broken, F.lit(self.rules[0].message))
        for rule in self.rules[1:]:
            outcome = outcome.when(rule.broken, F.lit(rule.message))
        return outcome.otherwise(F.lit(VALID))

    def rejected(self) -> Column:
        return any_of(rule.broken for rule in self.rules)

    def strictly_valid(self) -> Column:
        return all_of(rule.kept for rule in self.rules)


def source_rules() -> dict[str, SourceRules]:
    """Rules by short source name. Built on demand, as columns need a running session."""
    # Table names, rule order, limits and messages.
    return {
        "customer": SourceRules(
            "CUSTOMER_DIM",
            "customer_id",
            ("customer_id", "customername", "spending_score", "annual_incomek", "gender", "age", "customertype"),
            (
                present("customer_id", "REJECT: NULL customer_id"),
                filled("customername", "REJECT: NULL/Empty customername"),
                between("spending_score", 0, 100, "REJECT: Invalid spending_score range"),
                at_least("annual_incomek", 0, "REJECT: Negative annual_incomek"),
                between("age", 0, 120, "REJECT: Invalid age range"),
                one_of("customertype", CUSTOMER_TYPES, "REJECT: Invalid customertype"),
            ),
        ),
        "retail": SourceRules(
            "RETAIL_DIM",
            "stockid",
            ("stockid", "name", "rating", "location", "noofemployees"),
            (
                present("stockid", "REJECT: NULL stockid"),
                filled("name", "REJECT: NULL/Empty name"),
                between("rating", 0, 5, "REJECT: Invalid rating range"),
                at_least("noofemployees", 0, "REJECT: Negative noofemployees"),
            ),
        ),
        "transactions": SourceRules(
            "TRANSACTIONS_FACT",
            "customer_id",
            (
                "stockid",
                "invoiceid",
                "description",
                "quantity",
                "invoice_date",
                "price",
                "customer_id",
                "country",
                "productid",
            ),
            (
                present("customer_id", "REJECT: NULL customer_id"),
                present("stockid", "REJECT: NULL stockid"),
                present("productid", "REJECT: NULL productid"),
                filled("invoiceid", "REJECT: NULL/Empty invoiceid"),
                integer_text("invoice_date", "REJECT: Invalid invoice_date format"),
                above("quantity", 0, "REJECT: Invalid quantity (must be positive)"),
                at_least("price", 0, "REJECT: Negative price"),
            ),
        ),
        "product": SourceRules(
            "PRODUCT_DIM",
            "productid",
            ("productid", "productname", "category", "subcategory", "sales", "quantity"),
            (
                present("productid", "REJECT: NULL productid"),
                filled("productname", "REJECT: NULL/Empty productname"),
                at_least("sales", 0, "REJECT: Negative sales"),
                at_least("quantity", 0, "REJECT: Negative quantity"),
            ),
        ),
    }


def classify(df: DataFrame, rules: SourceRules) -> DataFrame:
    """Rows with ``validation_status`` (first broken rule or VALID) and ``source_table``."""
    return df.select(
        *rules.columns, rules.status().alias("validation_status"), F.lit(rules.table).alias("source_table")
    )


def lenient(df: DataFrame, rules: SourceRules) -> DataFrame:
    """Rows that break no rule; a null in a range-checked column passes."""
    return df.filter(rules.status() == VALID).select(*rules.columns)


def strict(df: DataFrame, rules: SourceRules) -> DataFrame:
    """Rows that satisfy every rule; a null in a range-checked column does not."""
    return df.filter(rules.strictly_valid()).select(*rules.columns)


def unaccounted(df: DataFrame, rules: SourceRules) -> DataFrame:
    """One row: how many rows are loaded, rejected, or neither, under the strict rules."""
    kept = F.coalesce(rules.strictly_valid(), F.lit(False))
    bad = F.coalesce(rules.rejected(), F.lit(False))
    return df.agg(
        F.lit(rules.table).alias("source_table"),
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(kept).alias("valid_rows"),
        F.count_if(bad).alias("rejected_rows"),
        F.count_if(~kept & ~bad).alias("unaccounted_rows"),
    )
