"""Mart versions, joins, expressions, validation and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.catalog import sqltext as S
from martloom.catalog.registry import register
from martloom.functions import (
    as_object,
    batch_id_of,
    collated,
    date_or_null,
    date_text,
    compare_with_nulls,
    has_text,
    int_or_null,
    names_customer_type,
    with_default,
)
from martloom.operators import joins
from martloom.operators.routing import route
from martloom.operators.statistics import count_rows
from martloom.plans import rejects, retail, validation
from martloom.samples import tables as T
from martloom.samples.sql import RETAIL_TABLES, with_tables
from martloom.sinks.tables import clustered, read_table, refresh_path, replace_batch
from martloom.schemas import JOB_REJECTS
from martloom.workspace import scratch_path


# --- mart versions -------------------------------------------------------------------------------


@register("mart_v1", S.mart(S.V1))
def mart_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.mart_v1(T.retail_sources(spark, sf_dir))


@register("mart_v2", S.mart(S.V2, S.STAMP))
def mart_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.mart_v2(T.retail_sources(spark, sf_dir), T.RETAIL_RUN)


@register("mart_v3", S.mart(S.STRICT, S.STAMP))
def mart_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.mart_v3(T.retail_sources(spark, sf_dir), T.RETAIL_RUN)


@register("mart_clustered_write", S.mart(S.STRICT, S.STAMP))
def mart_clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart")
    fact = retail.with_integer_date(T.transactions_fact(spark, sf_dir))
    refresh_path(clustered(mart_v3(spark, sf_dir), ["invoice_date", "customer_id"], like=fact), path)
    return spark.read.parquet(path)


@register(
    "count_transactions",
    with_tables(
        RETAIL_TABLES,
        S.mart_cte(S.V1, wanted="c.customertype IN ('citizen', 'foriegn')")
        + "SELECT customer_id, stockid, count(*) AS total_orders_num FROM mart "
        "GROUP BY customer_id, stockid",
    ),
)
def count_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.transaction_counts(retail.mart_from_files(T.retail_sources(spark, sf_dir)))


# --- joins ---------------------------------------------------------------------------------------


@register(
    "join_customer",
    with_tables(
        "transactions_fact customer_dim",
        "SELECT c.customer_id, customername, spending_score, annual_incomek, gender, age, customertype, stockid, "
        "invoiceid, description, TRY_CAST(invoice_date AS INTEGER) AS invoice_date, price, country, productid "
        "FROM transactions_fact t JOIN customer_dim c ON t.customer_id = c.customer_id",
    ),
)
def join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = retail.with_integer_date(T.transactions_fact(spark, sf_dir))
    return retail.join_customer(dated, T.customer_dim(spark, sf_dir))


@register(
    "join_retail",
    with_tables(
        "transactions_fact retail_dim",
        "SELECT t.*, name, rating, location, noofemployees FROM transactions_fact t "
        "JOIN retail_dim r ON t.stockid = r.stockid",
    ),
)
def join_retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.join_retail(T.transactions_fact(spark, sf_dir), T.retail_dim(spark, sf_dir))


@register(
    "join_product",
    with_tables(
        "transactions_fact product_dim",
        "SELECT t.* EXCLUDE (quantity), productname, category, subcategory, sales, p.quantity "
        "FROM transactions_fact t JOIN product_dim p ON t.productid = p.productid",
    ),
)
def join_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.join_product(T.transactions_fact(spark, sf_dir), T.product_dim(spark, sf_dir))


_VALID_CUSTOMERS = f"(SELECT * FROM customer_dim WHERE {S.STRICT['customer']})"
_VALID_STORES = f"(SELECT * FROM retail_dim WHERE {S.STRICT['retail']})"
_VALID_PRODUCTS = f"(SELECT * FROM product_dim WHERE {S.STRICT['product']})"
_GOOD_TRANSACTIONS = f"(SELECT * FROM transactions_fact WHERE {S.STRICT['transactions']})"


def _strict(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    makers = {
        "customer": T.customer_dim,
        "retail": T.retail_dim,
        "transactions": T.transactions_fact,
        "product": T.product_dim,
    }
    return validation.strict(makers[source](spark, sf_dir), validation.source_rules()[source])


@register(
    "join_left",
    with_tables(
        "transactions_fact customer_dim",
        "SELECT t.customer_id, t.invoiceid, t.price, c.customername, c.customertype "
        f"FROM transactions_fact t LEFT JOIN {_VALID_CUSTOMERS} c ON t.customer_id = c.customer_id",
    ),
)
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = T.transactions_fact(spark, sf_dir).select("customer_id", "invoiceid", "price")
    customers = _strict(spark, sf_dir, "customer").select("customer_id", "customername", "customertype")
    return joins.equi_join(transactions, customers, ["customer_id"], "left")


@register(
    "join_right",
    with_tables(
        "transactions_fact product_dim",
        "SELECT p.productid, t.invoiceid, t.price, p.productname "
        f"FROM {_GOOD_TRANSACTIONS} t RIGHT JOIN product_dim p ON t.productid = p.productid",
    ),
)
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = _strict(spark, sf_dir, "transactions").select("productid", "invoiceid", "price")
    products = T.product_dim(spark, sf_dir).select("productid", "productname")
    return joins.equi_join(transactions, products, ["productid"], "right")


@register(
    "join_full",
    with_tables(
        "transactions_fact customer_dim",
        "SELECT coalesce(t.customer_id, c.customer_id) AS customer_id, t.invoiceid, t.price, c.customername "
        f"FROM {_GOOD_TRANSACTIONS} t FULL JOIN {_VALID_CUSTOMERS} c ON t.customer_id = c.customer_id",
    ),
)
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = _strict(spark, sf_dir, "transactions").select("customer_id", "invoiceid", "price")
    customers = _strict(spark, sf_dir, "customer").select("customer_id", "customername")
    return joins.equi_join(transactions, customers, ["customer_id"], "full", hot="left")


@register(
    "join_multi",
    with_tables(
        "transactions_fact customer_dim",
        """, bought AS (SELECT customer_id, count(*) AS transactions FROM transactions_fact
             GROUP BY customer_id),
           ordered AS (SELECT CAST(o_custkey AS INTEGER) AS customer_id, count(*) AS orders
             FROM orders GROUP BY o_custkey)
        SELECT c.customer_id, c.customername, bought.transactions, ordered.orders
        FROM customer_dim c JOIN bought ON c.customer_id = bought.customer_id
          JOIN ordered ON c.customer_id = ordered.customer_id""",
    ),
)
def join_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = T.customer_dim(spark, sf_dir).select("customer_id", "customername")
    bought = count_rows(T.transactions_fact(spark, sf_dir), ["customer_id"], "transactions")
    orders = T.read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("int").alias("customer_id"))
    return joins.join_all([customers, bought, count_rows(orders, ["customer_id"], "orders")], ["customer_id"])


@register(
    "join_case_insensitive",
    with_tables(
        "retail_dim transactions_fact",
        """, sold AS (SELECT lower(country) AS location, count(*) AS transactions
             FROM transactions_fact GROUP BY lower(country))
        SELECT r.location, r.stockid, sold.transactions FROM retail_dim r JOIN sold
          ON lower(r.location) = lower(sold.location)""",
    ),
)
def join_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = T.retail_dim(spark, sf_dir).select("location", "stockid")
    sold = count_rows(T.transactions_fact(spark, sf_dir), ["country"], "transactions", ignore_case=["country"])
    return joins.equi_join(stores, sold.withColumnRenamed("country", "location"), ["location"], ignore_case=True)


# --- projections and predicates --------------------------------------------------------------------


@register(
    "project_keep",
    with_tables(
        "transactions_fact",
        "SELECT customer_id, stockid, productid, invoiceid, price FROM transactions_fact",
    ),
)
def project_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.transactions_fact(spark, sf_dir).select("customer_id", "stockid", "productid", "invoiceid", "price")


@register(
    "try_cast_int",
    with_tables(
        "transactions_fact",
        "SELECT invoiceid, invoice_date, TRY_CAST(invoice_date AS INTEGER) AS invoice_date_int, "
        "CAST(CASE productid % 3 WHEN 0 THEN round(CAST(quantity AS DOUBLE) + 0.7) WHEN 1 THEN quantity * 1000 END AS INTEGER) "
        "AS quantity_int FROM transactions_fact",
    ),
)
def try_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as texts, and quantities as texts with a fraction, with an exponent, and with a word."""
    suffix = F.element_at(F.array(F.lit(".7"), F.lit("e3"), F.lit(" pieces")), (F.col("productid") % 3 + 1).cast("int"))
    quantity = F.concat(F.col("quantity").cast("string"), suffix)
    return T.transactions_fact(spark, sf_dir).select(
        "invoiceid",
        "invoice_date",
        int_or_null("invoice_date", rounding=True).alias("invoice_date_int"),
        int_or_null(quantity, rounding=True).alias("quantity_int"),
    )


@register(
    "try_cast_date",
    with_tables(
        "transactions_fact",
        "SELECT invoiceid, CAST(CASE WHEN invoice_date LIKE '____-__-__' THEN TRY_CAST(invoice_date AS DATE) END "
        "AS VARCHAR) AS invoice_day FROM transactions_fact",
    ),
)
def try_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.transactions_fact(spark, sf_dir).select(
        "invoiceid", date_or_null("invoice_date").cast("string").alias("invoice_day")
    )


@register(
    "upper_name",
    with_tables("customer_dim", "SELECT customer_id, upper(customername) AS customername FROM customer_dim"),
)
def upper_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.customer_dim(spark, sf_dir).select("customer_id", F.upper("customername").alias("customername"))


@register(
    "filter_customertype",
    with_tables(
        "customer_dim",
        "SELECT * FROM customer_dim WHERE lower(customertype) LIKE '%citizen%' OR lower(customertype) LIKE '%foriegn%'",
    ),
)
def filter_customertype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.customer_dim(spark, sf_dir).filter(names_customer_type("customertype"))


@register(
    "filter_in_list",
    with_tables("customer_dim", f"SELECT * FROM customer_dim WHERE customertype NOT IN {S.TYPES}"),
)
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.customer_dim(spark, sf_dir).filter(~F.col("customertype").isin(*validation.CUSTOMER_TYPES))


@register(
    "filter_range",
    with_tables(
        "customer_dim",
        "SELECT * FROM customer_dim WHERE spending_score BETWEEN 0 AND 100 AND annual_incomek >= 0 "
        "AND age BETWEEN 0 AND 120",
    ),
)
def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.customer_dim(spark, sf_dir).filter(
        F.col("spending_score").between(0, 100) & (F.col("annual_incomek") >= 0) & F.col("age").between(0, 120)
    )


@register(
    "filter_not_blank",
    with_tables("product_dim", "SELECT * FROM product_dim WHERE productname IS NOT NULL AND trim(productname) <> ''"),
)
def filter_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.product_dim(spark, sf_dir).filter(has_text("productname"))


@register(
    "filter_null_order",
    with_tables(
        "customer_dim",
        "SELECT customer_id, spending_score, age FROM customer_dim WHERE (spending_score < 50 OR spending_score IS NULL) "
        "AND (age > 100 OR age IS NULL)",
    ),
)
def filter_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        T.customer_dim(spark, sf_dir)
        .filter(compare_with_nulls("spending_score", "<", 50, "first") & compare_with_nulls("age", ">", 100, "last"))
        .select("customer_id", "spending_score", "age")
    )


@register("batch_id_format", "SELECT event_id, 'BATCH_' || strftime(ts, '%Y%m%d%H%M%S') AS batch_id FROM events")
def batch_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read(spark, sf_dir, "events").select("event_id", batch_id_of("ts").alias("batch_id"))


@register(
    "date_to_text",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS start_date FROM orders",
)
def date_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read(spark, sf_dir, "orders").select("o_orderkey", date_text("o_orderdate").alias("start_date"))


@register(
    "column_defaults",
    with_tables(
        "policy_src",
        "SELECT policy_id, coalesce(policy_holder_name, 'UNKNOWN') AS policy_holder_name, "
        "coalesce(CASE WHEN policy_id % 2 = 0 THEN source_system END, 'POLICY_SYS') AS source_system, "
        "coalesce(CASE WHEN policy_id % 3 = 0 THEN updated_date END, TIMESTAMP '2024-01-31 12:00:00') AS updated_date, "
        "'Y' AS current_flag, CAST(1 AS INTEGER) AS version_no, true AS is_active FROM policy_src",
    ),
)
def column_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("policy_id")
    return T.policy_src(spark, sf_dir).select(
        "policy_id",
        with_default("policy_holder_name", "UNKNOWN").alias("policy_holder_name"),
        with_default(F.when(key % 2 == 0, F.col("source_system")), "POLICY_SYS").alias("source_system"),
        with_default(F.when(key % 3 == 0, F.col("updated_date")), T.POLICY_RUN.now).alias("updated_date"),
        F.lit("Y").alias("current_flag"),
        F.lit(1).alias("version_no"),
        F.lit(True).alias("is_active"),
    )


# --- routing -----------------------------------------------------------------------------------------

_ROUTES_SQL = {
    "low_score": "spending_score < 50",
    "senior": "age >= 65",
    "local": "customertype IN ('citizen', 'Citizen')",
}


def _routes():
    return {
        "low_score": F.col("spending_score") < 50,
        "senior": F.col("age") >= 65,
        "local": F.col("customertype").isin("citizen", "Citizen"),
    }


_ALL_MATCHES = " UNION ALL ".join(
    f"SELECT customer_id, '{label}' AS route FROM customer_dim WHERE {test}" for label, test in _ROUTES_SQL.items()
)
_FIRST_CASE = " ".join(f"WHEN {test} THEN '{label}'" for label, test in _ROUTES_SQL.items())


@register("route_all_matches", with_tables("customer_dim", _ALL_MATCHES))
def route_all_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(T.customer_dim(spark, sf_dir), _routes()).select("customer_id", "route")


@register(
    "route_first_match",
    with_tables(
        "customer_dim",
        f"SELECT * FROM (SELECT customer_id, CASE {_FIRST_CASE} END AS route FROM customer_dim) AS x "
        "WHERE route IS NOT NULL",
    ),
)
def route_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(T.customer_dim(spark, sf_dir), _routes(), first_only=True).select("customer_id", "route")


@register(
    "route_reject",
    with_tables(
        "customer_dim",
        f"{_ALL_MATCHES} UNION ALL SELECT customer_id, 'reject' FROM customer_dim WHERE CASE {_FIRST_CASE} END IS NULL",
    ),
)
def route_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(T.customer_dim(spark, sf_dir), _routes(), rejects=True).select("customer_id", "route")


# --- validation and rejects -----------------------------------------------------------------------------


def _register_validation(source: str) -> None:
    sql = with_tables(
        S.TABLE[source],
        f"SELECT *, {S.status(source)} AS validation_status, '{S.TABLE[source].upper()}' AS source_table "
        f"FROM {S.TABLE[source]}",
    )

    @register(f"validate_{source}", sql)
    def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
        makers = {
            "customer": T.customer_dim,
            "retail": T.retail_dim,
            "transactions": T.transactions_fact,
            "product": T.product_dim,
        }
        return validation.classify(makers[source](spark, sf_dir), validation.source_rules()[source])


for _source in ("customer", "retail", "transactions", "product"):
    _register_validation(_source)


@register(
    "unaccounted_rows",
    with_tables(
        RETAIL_TABLES,
        " UNION ALL ".join(
            f"SELECT '{S.TABLE[s].upper()}' AS source_table, count(*) AS source_rows, "
            f"count(*) FILTER (WHERE {S.STRICT[s]}) AS valid_rows, "
            f"count(*) FILTER (WHERE {S.rejected(s)}) AS rejected_rows, "
            f"count(*) FILTER (WHERE NOT coalesce({S.STRICT[s]}, false) AND NOT coalesce({S.rejected(s)}, false)) "
            f"AS unaccounted_rows FROM {S.TABLE[s]}"
            for s in S.BROKEN
        ),
    ),
)
def unaccounted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = validation.source_rules()
    parts = [validation.unaccounted(df, rules[name]) for name, df in T.retail_sources(spark, sf_dir).items()]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


@register(
    "reject_raw_data",
    with_tables(
        "transactions_fact",
        f"SELECT invoiceid, {S.json_object(S.COLUMNS['transactions'])} AS raw_data FROM transactions_fact",
    ),
)
def reject_raw_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.transactions_fact(spark, sf_dir).select(
        "invoiceid", as_object(validation.source_rules()["transactions"].columns).alias("raw_data")
    )


@register("rejects_v2", with_tables(RETAIL_TABLES, S.ALL_REJECTS))
def rejects_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the classified frames: every row whose status is not VALID."""
    rules = validation.source_rules()
    parts = []
    for name, df in T.retail_sources(spark, sf_dir).items():
        marked = validation.classify(df, rules[name]).filter(F.col("validation_status") != validation.VALID)
        parts.append(rejects.record(marked, rules[name], T.RETAIL_RUN, F.col("validation_status")))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


@register("rejects_all", with_tables(RETAIL_TABLES, S.ALL_REJECTS))
def rejects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects.retail_rejects(T.retail_sources(spark, sf_dir), T.RETAIL_RUN)


@register("rejects_rerun", with_tables(RETAIL_TABLES, S.ALL_REJECTS))
def rejects_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch's rejects written, then written again: the second run replaces the first."""
    path = scratch_path(spark, "rejects")
    sources = T.retail_sources(spark, sf_dir)
    early = rejects.rejects_of(sources["customer"], validation.source_rules()["customer"], T.RETAIL_RUN)
    replace_batch(early, path, JOB_REJECTS)
    replace_batch(rejects.retail_rejects(sources, T.RETAIL_RUN), path, JOB_REJECTS)
    return read_table(spark, path, JOB_REJECTS)



@register(
    "reject_ids",
    with_tables(
        RETAIL_TABLES,
        f", x AS ({S.ALL_REJECTS}) SELECT row_number() OVER (ORDER BY primary_key_value) AS reject_id FROM x",
    ),
)
def reject_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids themselves: as many as reject records, from 1 on. Which record has which is open."""
    numbered = rejects.with_reject_ids(rejects.retail_rejects(T.retail_sources(spark, sf_dir), T.RETAIL_RUN))
    return numbered.select("reject_id")


@register(
    "group_collated",
    with_tables(
        "transactions_fact",
        "SELECT lower(country) AS country, count(*) AS transactions FROM transactions_fact "
        "GROUP BY lower(country)",
    ),
)
def group_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed spellings of a country grouped by a collation that ignores case."""
    rows = T.transactions_fact(spark, sf_dir).select(
        F.when(F.col("productid") % 2 == 0, F.upper("country")).otherwise(F.lower("country")).alias("country")
    )
    grouped = rows.groupBy(collated("country", "UTF8_LCASE").alias("country")).agg(
        F.count(F.lit(1)).alias("transactions")
    )
    return grouped.select(F.lower(F.col("country").cast("string")).alias("country"), "transactions")
