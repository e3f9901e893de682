"""SQL fragments shared by the checks: staging, the mart, validation, rejects, policies."""

from __future__ import annotations

from martloom.samples.sql import BATCH_ID, JOB_NAME, POLICY_RUN_DATE, RETAIL_TABLES, RUN_TS, with_tables

# Fixed values below: accepted spellings, limits, messages, table and column names, which must equal the reference's.
TYPES = "('citizen', 'foriegn', 'Citizen', 'Foriegn', 'CITIZEN', 'FORIEGN')"

# source -> ordered (broken condition, message), and the strict condition
BROKEN = {
    "customer": (
        ("customer_id IS NULL", "REJECT: NULL customer_id"),
        ("customername IS NULL OR trim(customername) = ''", "REJECT: NULL/Empty customername"),
        ("spending_score < 0 OR spending_score > 100", "REJECT: Invalid spending_score range"),
        ("annual_incomek < 0", "REJECT: Negative annual_incomek"),
        ("age < 0 OR age > 120", "REJECT: Invalid age range"),
        (f"customertype NOT IN {TYPES}", "REJECT: Invalid customertype"),
    ),
    "retail": (
        ("stockid IS NULL", "REJECT: NULL stockid"),
        ("name IS NULL OR trim(name) = ''", "REJECT: NULL/Empty name"),
        ("rating < 0 OR rating > 5", "REJECT: Invalid rating range"),
        ("noofemployees < 0", "REJECT: Negative noofemployees"),
    ),
    "transactions": (
        ("customer_id IS NULL", "REJECT: NULL customer_id"),
        ("stockid IS NULL", "REJECT: NULL stockid"),
        ("productid IS NULL", "REJECT: NULL productid"),
        ("invoiceid IS NULL OR trim(invoiceid) = ''", "REJECT: NULL/Empty invoiceid"),
        ("TRY_CAST(invoice_date AS INTEGER) IS NULL", "REJECT: Invalid invoice_date format"),
        ("quantity <= 0", "REJECT: Invalid quantity (must be positive)"),
        ("price < 0", "REJECT: Negative price"),
    ),
    "product": (
        ("productid IS NULL", "REJECT: NULL productid"),
        ("productname IS NULL OR trim(productname) = ''", "REJECT: NULL/Empty productname"),
        ("sales < 0", "REJECT: Negative sales"),
        ("quantity < 0", "REJECT: Negative quantity"),
    ),
}
STRICT = {
    "customer": "customer_id IS NOT NULL AND trim(customername) <> '' AND spending_score BETWEEN 0 AND 100 "
    f"AND annual_incomek >= 0 AND age BETWEEN 0 AND 120 AND customertype IN {TYPES}",
    "retail": "stockid IS NOT NULL AND trim(name) <> '' AND rating BETWEEN 0 AND 5 AND noofemployees >= 0",
    "transactions": "customer_id IS NOT NULL AND stockid IS NOT NULL AND productid IS NOT NULL "
    "AND trim(invoiceid) <> '' AND TRY_CAST(invoice_date AS INTEGER) IS NOT NULL AND quantity > 0 AND price >= 0",
    "product": "productid IS NOT NULL AND trim(productname) <> '' AND sales >= 0 AND quantity >= 0",
}
TABLE = {
    "customer": "customer_dim",
    "retail": "retail_dim",
    "transactions": "transactions_fact",
    "product": "product_dim",
}
COLUMNS = {
    "customer": "customer_id customername spending_score annual_incomek gender age customertype".split(),
    "retail": "stockid name rating location noofemployees".split(),
    "transactions": "stockid invoiceid description quantity invoice_date price customer_id country productid".split(),
    "product": "productid productname category subcategory sales quantity".split(),
}
TEXT = set("customername gender customertype name location invoiceid description invoice_date country "
           "productname category subcategory policy_holder_name policy_type source_system "
           "start_date end_date".split())
KEY = {"customer": "customer_id", "retail": "stockid", "transactions": "customer_id", "product": "productid"}

MART_COLUMNS = (
    "p.productid, p.productname, p.category, p.subcategory, p.sales, p.quantity, c.customer_id, "
    "upper(c.customername) AS customername, c.spending_score, c.annual_incomek, c.gender, c.age, c.customertype, "
    "r.stockid, r.name, r.rating, r.location, r.noofemployees, t.invoiceid, t.description, "
    "TRY_CAST(t.invoice_date AS INTEGER) AS invoice_date, t.price, t.country"
)
STAMP = f", '{BATCH_ID}' AS batch_id, {RUN_TS} AS load_timestamp"
LIKE = "(lower(c.customertype) LIKE '%citizen%' OR lower(c.customertype) LIKE '%foriegn%')"


def status(source: str) -> str:
    cases = " ".join(f"WHEN {test} THEN '{message}'" for test, message in BROKEN[source])
    return f"CASE {cases} ELSE 'VALID' END"


def rejected(source: str) -> str:
    return " OR ".join(f"({test})" for test, _ in BROKEN[source])


def staged(condition: dict[str, str]) -> str:
    """Common table expressions c, r, t, p over the four sources."""
    return ", " + ", ".join(
        f"{short} AS (SELECT * FROM {TABLE[source]} WHERE {condition[source]})"
        for source, short in (("customer", "c"), ("retail", "r"), ("transactions", "t"), ("product", "p"))
    )


V1 = {
    "customer": "customer_id IS NOT NULL",
    "retail": "stockid IS NOT NULL",
    "transactions": "customer_id IS NOT NULL AND stockid IS NOT NULL AND productid IS NOT NULL",
    "product": "productid IS NOT NULL",
}
V2 = {source: f"({status(source)}) = 'VALID'" for source in BROKEN}
# What survives a file whose integer columns may not be empty.
FILES = {
    "customer": "spending_score IS NOT NULL AND age IS NOT NULL",
    "retail": "rating IS NOT NULL",
    "transactions": "customer_id IS NOT NULL AND quantity IS NOT NULL",
    "product": "quantity IS NOT NULL",
}
JOINED = (
    "FROM t JOIN c ON t.customer_id = c.customer_id JOIN r ON t.stockid = r.stockid "
    "JOIN p ON t.productid = p.productid"
)


def mart(condition: dict[str, str], extra: str = "", wanted: str = LIKE) -> str:
    """The mart as a complete statement over the derived tables."""
    return with_tables(RETAIL_TABLES, f"{staged(condition)} SELECT {MART_COLUMNS}{extra} {JOINED} WHERE {wanted}")


def mart_cte(condition: dict[str, str], name: str = "mart", extra: str = "", wanted: str = LIKE) -> str:
    return f"{staged(condition)}, {name} AS (SELECT {MART_COLUMNS}{extra} {JOINED} WHERE {wanted})"


def json_object(columns: list[str], prefix: str = "") -> str:
    """JSON text that leaves nulls out, in column order."""
    members = []
    for column in columns:
        value = f"CAST({prefix}{column} AS VARCHAR)"
        quote = '"' if column in TEXT else ""
        members.append(f"""'"{column}":{quote}' || {value} || '{quote}'""")
    return "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"


def rejects_of(source: str) -> str:
    cases = " ".join(f"WHEN {test} THEN '{message}'" for test, message in BROKEN[source])
    return (
        f"SELECT '{BATCH_ID}' AS batch_id, '{JOB_NAME}' AS job_name, {RUN_TS} AS reject_time, "
        f"'{TABLE[source].upper()}' AS source_table, CAST({KEY[source]} AS VARCHAR) AS primary_key_value, "
        f"CASE {cases} END AS error_description, {json_object(COLUMNS[source])} AS raw_data "
        f"FROM {TABLE[source]} WHERE {rejected(source)}"
    )


ALL_REJECTS = " UNION ALL ".join(rejects_of(source) for source in BROKEN)

# Policies due at the run date, current dimension rows, and their pairing.
ATTRIBUTES = "policy_holder_name policy_type premium_amount start_date end_date".split()
DIFFERENT = " OR ".join(f"s.{a} IS DISTINCT FROM d.{a}" for a in ATTRIBUTES)
POLICY_CTES = (
    f", due AS (SELECT * FROM policy_src WHERE updated_date <= {POLICY_RUN_DATE}), "
    "cur AS (SELECT * FROM dim_policy WHERE current_flag = 'Y'), "
    "paired AS (SELECT s.*, d.policy_id IS NOT NULL AS matched, d.version_no AS lk_version_no, "
    f"({DIFFERENT}) AS attr_changed FROM due s LEFT JOIN cur d ON s.policy_id = d.policy_id)"
)
DIM_TEXT = (
    "policy_key, policy_id, policy_holder_name, policy_type, CAST(premium_amount AS DOUBLE) AS premium_amount, "
    "CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, "
    "CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to, "
    "current_flag, version_no, source_system, updated_date, batch_id"
)
INSERTS_CTE = (
    f", added AS (SELECT policy_id, policy_holder_name, policy_type, premium_amount, start_date, end_date, "
    f"{POLICY_RUN_DATE} AS effective_from, CAST(NULL AS DATE) AS effective_to, 'Y' AS current_flag, "
    "CAST(CASE WHEN matched THEN lk_version_no + 1 ELSE 1 END AS INTEGER) AS version_no, source_system, updated_date, "
    f"'{BATCH_ID}' AS batch_id FROM paired WHERE policy_id IS NOT NULL AND (NOT matched OR attr_changed)), "
    "keyed AS (SELECT (SELECT max(policy_key) FROM dim_policy) + row_number() OVER (ORDER BY policy_id) "
    "AS policy_key, * FROM added), "
    "closed AS (SELECT d.policy_key, d.policy_id, d.policy_holder_name, d.policy_type, d.premium_amount, "
    f"d.start_date, d.end_date, d.effective_from, {POLICY_RUN_DATE} - 1 AS effective_to, 'N' AS current_flag, "
    "d.version_no, d.source_system, d.updated_date, d.batch_id FROM cur d JOIN paired p ON p.policy_id = d.policy_id "
    "WHERE p.matched AND p.attr_changed)"
)
