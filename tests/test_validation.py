"""Rules at their limits, on hand-written rows."""

import pytest

from martloom import schemas
from martloom.context import RETAIL_JOB, RunContext
from martloom.plans import rejects, retail, validation
from tests.rows import frame

GOOD = {"customer_id": 1, "customername": "Ann", "spending_score": 50, "annual_incomek": 10, "gender": "F", "age": 30,
        "customertype": "citizen"}
SALE = {"stockid": 1, "invoiceid": "I1", "description": "d", "quantity": 5, "invoice_date": "20230525", "price": 9,
        "customer_id": 1, "country": "X", "productid": 1}
STORE = {"stockid": 1, "name": "S", "rating": 5, "location": "L", "noofemployees": 0}
ITEM = {"productid": 1, "productname": "P", "category": "c", "subcategory": "s", "sales": 0, "quantity": 7}

# (source, changed column, value, status, kept by the strict rules)
CASES = [
    ("customer", "spending_score", -1, "REJECT: Invalid spending_score range", False),
    ("customer", "spending_score", 0, "VALID", True),
    ("customer", "spending_score", 100, "VALID", True),
    ("customer", "spending_score", 101, "REJECT: Invalid spending_score range", False),
    ("customer", "spending_score", None, "VALID", False),
    ("customer", "age", -1, "REJECT: Invalid age range", False),
    ("customer", "age", 120, "VALID", True),
    ("customer", "age", 121, "REJECT: Invalid age range", False),
    ("customer", "age", None, "VALID", False),
    ("customer", "annual_incomek", -1, "REJECT: Negative annual_incomek", False),
    ("customer", "annual_incomek", None, "VALID", False),
    ("customer", "customername", None, "REJECT: NULL/Empty customername", False),
    ("customer", "customername", "", "REJECT: NULL/Empty customername", False),
    ("customer", "customername", "  ", "REJECT: NULL/Empty customername", False),
    ("customer", "customer_id", None, "REJECT: NULL customer_id", False),
    ("customer", "customertype", "CITIZEN", "VALID", True),
    ("customer", "customertype", "cItIzEn", "REJECT: Invalid customertype", False),
    ("customer", "customertype", None, "VALID", False),
    ("retail", "rating", -1, "REJECT: Invalid rating range", False),
    ("retail", "rating", 0, "VALID", True),
    ("retail", "rating", 6, "REJECT: Invalid rating range", False),
    ("retail", "rating", None, "VALID", False),
    ("retail", "noofemployees", -1, "REJECT: Negative noofemployees", False),
    ("retail", "noofemployees", None, "VALID", False),
    ("transactions", "invoice_date", "2023-05-25", "REJECT: Invalid invoice_date format", False),
    ("transactions", "invoice_date", " 12 ", "VALID", True),
    ("transactions", "invoice_date", "", "REJECT: Invalid invoice_date format", False),
    ("transactions", "invoice_date", "12.7", "VALID", True),
    ("transactions", "invoice_date", "1e3", "VALID", True),
    ("transactions", "invoice_date", "12.7.1", "REJECT: Invalid invoice_date format", False),
    ("transactions", "invoice_date", "99999999999", "REJECT: Invalid invoice_date format", False),
    ("transactions", "invoice_date", None, "REJECT: Invalid invoice_date format", False),
    ("transactions", "quantity", 0, "REJECT: Invalid quantity (must be positive)", False),
    ("transactions", "quantity", 1, "VALID", True),
    ("transactions", "quantity", None, "VALID", False),
    ("transactions", "price", -1, "REJECT: Negative price", False),
    ("transactions", "price", 0, "VALID", True),
    ("transactions", "price", None, "VALID", False),
    ("transactions", "productid", None, "REJECT: NULL productid", False),
    ("product", "sales", -1, "REJECT: Negative sales", False),
    ("product", "sales", None, "VALID", False),
    ("product", "quantity", -1, "REJECT: Negative quantity", False),
    ("product", "quantity", None, "VALID", False),
]
BASE = {"customer": GOOD, "transactions": SALE, "retail": STORE, "product": ITEM}
SCHEMA = {
    "customer": schemas.CUSTOMER_DIM,
    "retail": schemas.RETAIL_DIM,
    "transactions": schemas.TRANSACTIONS_FACT,
    "product": schemas.PRODUCT_DIM,
}


@pytest.mark.parametrize("source", sorted(BASE))
def test_rules_at_their_limits(spark, source):
    rules = validation.source_rules()[source]
    cases = [c for c in CASES if c[0] == source]
    rows = [{**BASE[source], column: value, "case": n} for n, (_, column, value, _, _) in enumerate(cases)]
    df = frame(spark, SCHEMA[source], rows, extra="case INT")
    status = {r["case"]: r["s"] for r in df.select("case", rules.status().alias("s")).collect()}
    kept = {r["case"] for r in df.filter(rules.strictly_valid()).select("case").collect()}
    for n, (_, column, value, expected, strictly) in enumerate(cases):
        assert status[n] == expected, (column, value)
        assert (n in kept) == strictly, (column, value)


def test_first_broken_rule_wins(spark):
    rules = validation.source_rules()["transactions"]
    df = frame(spark, SCHEMA["transactions"], [{**SALE, "productid": None, "price": -1}])
    assert df.select(rules.status().alias("s")).first()["s"] == "REJECT: NULL productid"


def test_every_row_is_valid_rejected_or_unaccounted(spark):
    rules = validation.source_rules()["customer"]
    rows = [{**GOOD, c: v} for s, c, v, _, _ in CASES if s == "customer"]
    counts = validation.unaccounted(frame(spark, SCHEMA["customer"], rows), rules).first()
    assert counts["valid_rows"] + counts["rejected_rows"] + counts["unaccounted_rows"] == counts["source_rows"]
    assert counts["unaccounted_rows"] == 4


def test_reject_key_of_a_transaction_is_its_customer(spark):
    run = RunContext.start(RETAIL_JOB)
    df = frame(spark, SCHEMA["transactions"], [{**SALE, "price": -1, "customer_id": 77, "country": None}])
    row = rejects.rejects_of(df, validation.source_rules()["transactions"], run).first()
    assert (row["primary_key_value"], row["source_table"]) == ("77", "TRANSACTIONS_FACT")
    assert '"price":-1' in row["raw_data"] and "country" not in row["raw_data"]


def _sources(spark, customer=(GOOD,), sale=(SALE,)):
    return {
        "customer": frame(spark, SCHEMA["customer"], customer),
        "retail": frame(spark, SCHEMA["retail"], [STORE]),
        "transactions": frame(spark, SCHEMA["transactions"], sale),
        "product": frame(spark, SCHEMA["product"], [ITEM]),
    }


def test_mart_takes_quantity_from_the_product(spark):
    row = retail.mart_v1(_sources(spark)).first()
    assert row["quantity"] == 7 and row["customername"] == "ANN" and row["invoice_date"] == 20230525


def test_mart_filters_customer_type_as_each_version_does(spark):
    odd = {**GOOD, "customertype": "non-citizen"}
    sources = _sources(spark, customer=[odd])
    run = RunContext.start(RETAIL_JOB)
    assert retail.mart_v1(sources).count() == 1
    assert retail.mart_v2(sources, run).count() == 0
    assert retail.mart_v3(sources, run).count() == 0
    assert retail.mart_from_files(sources).count() == 0
    assert retail.mart_from_files(_sources(spark, customer=[{**GOOD, "customertype": "Citizen"}])).count() == 0
    assert retail.mart_from_files(_sources(spark)).count() == 1


def test_later_marts_are_contained_in_earlier_ones(spark):
    from martloom.samples import tables as T

    sources = T.retail_sources(spark, "/root/testdata/sf0.001")
    run = RunContext.start(RETAIL_JOB)
    business = schemas.MART_COLUMNS
    v1 = retail.mart_v1(sources).select(*business)
    v2 = retail.mart_v2(sources, run).select(*business)
    v3 = retail.mart_v3(sources, run).select(*business)
    assert (v1.count(), v2.count(), v3.count()) == (5956, 2693, 2290)
    assert v3.exceptAll(v2).isEmpty() and v2.exceptAll(v1).isEmpty()
