"""Declared table and file schemas. ``nullable=False`` marks columns whose absence makes a file row bad."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BOOLEAN": T.BooleanType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
}


def _fields(spec: str, required: frozenset[str] = frozenset()) -> T.StructType:
    """A schema from ``name TYPE, ...``. Unlike ``StructType.fromDDL`` this needs no running session."""
    pairs = [column.split(" ") for column in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind], name not in required) for name, kind in pairs])


def _file(spec: str) -> T.StructType:
    """File schemas: every column is declared non-null, so an empty integer field is a bad row."""
    return _fields(spec, frozenset(column.split(" ")[0] for column in spec.split(", ")))


# Column names, order and types of the reference tables and files.
CUSTOMER_DIM = _file(
    "customer_id INT, customername STRING, spending_score INT, annual_incomek INT, gender STRING, age INT, "
    "customertype STRING"
)
RETAIL_DIM = _file("stockid INT, name STRING, rating INT, location STRING, noofemployees INT")
TRANSACTIONS_FACT = _file(
    "stockid INT, invoiceid STRING, description STRING, quantity INT, invoice_date STRING, price INT, "
    "customer_id INT, country STRING, productid INT"
)
PRODUCT_DIM = _file(
    "productid INT, productname STRING, category STRING, subcategory STRING, sales INT, quantity INT"
)
RETAIL_DATA_MART = _fields(
    "productid INT, productname STRING, category STRING, subcategory STRING, sales INT, quantity INT, "
    "customer_id INT, customername STRING, spending_score INT, annual_incomek INT, gender STRING, age INT, "
    "customertype STRING, stockid INT, name STRING, rating INT, location STRING, noofemployees INT, "
    "invoiceid STRING, description STRING, invoice_date INT, price INT, country STRING",
    # Text read from a mart file is never null; numbers may be, as a date text need not be a number.
    frozenset(
        "productname category subcategory customername gender customertype name location invoiceid description "
        "country".split()
    ),
)
# The count is wider than the 32 bits of the reference file: one pair may hold more rows than that at scale.
COUNT_CUSTOMERS_TRANSACTIONS = _file("customer_id INT, stockid INT, total_orders_num BIGINT")
POLICY_SRC = _fields(
    "policy_id BIGINT, policy_holder_name STRING, policy_type STRING, premium_amount DECIMAL(10,2), "
    "start_date DATE, end_date DATE, updated_date TIMESTAMP_NTZ, source_system STRING",
    frozenset({"policy_id"}),
)
DIM_POLICY = _fields(
    "policy_key BIGINT, policy_id BIGINT, policy_holder_name STRING, policy_type STRING, "
    "premium_amount DECIMAL(10,2), start_date DATE, end_date DATE, effective_from DATE, effective_to DATE, "
    "current_flag STRING, version_no INT, source_system STRING, updated_date TIMESTAMP_NTZ, batch_id STRING",
    frozenset({"policy_key", "policy_id", "effective_from"}),
)
POLICY_VERSIONS = T.StructType([*DIM_POLICY, T.StructField("kind", T.StringType())])
POLICY_REJECTS = _file("policy_id STRING, error_desc STRING, raw_data STRING")
# A load's two entries: when its rows were ready, with the largest surrogate key they use, and when they were in place.
POLICY_LOADS = _fields("load STRING, batch_id STRING, loaded_at TIMESTAMP_NTZ, state STRING, last_key BIGINT")
ETL_AUDIT_LOG = _fields(
    "job_name STRING, batch_id STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, source_count BIGINT, "
    "target_inserts BIGINT, target_updates BIGINT, status STRING, error_message STRING"
)
JOB_AUDIT_LOG = _fields(
    "batch_id STRING, job_name STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, status STRING, "
    "source_count BIGINT, target_inserts BIGINT, target_updates BIGINT, reject_count BIGINT, "
    "execution_duration_seconds BIGINT, run_date DATE, source_connection STRING, target_connection STRING, "
    "log_path STRING, error_message STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    frozenset({"batch_id", "job_name", "start_time", "status"}),
)
JOB_REJECTS = _fields(
    "batch_id STRING, job_name STRING, reject_time TIMESTAMP_NTZ, source_table STRING, primary_key_value STRING, "
    "error_description STRING, raw_data STRING"
)
# As stored: with the table's own id and the time a record was made.
STORED_REJECTS = _fields(
    "reject_id BIGINT, batch_id STRING, job_name STRING, reject_time TIMESTAMP_NTZ, source_table STRING, "
    "primary_key_value STRING, error_description STRING, raw_data STRING, created_at TIMESTAMP_NTZ"
)
CUSTOMER_DIM_AUDIT = _fields(
    "batch_id STRING, customer_id INT, customername STRING, spending_score INT, annual_incomek INT, gender STRING, "
    "age INT, customertype STRING, change_type STRING, change_timestamp TIMESTAMP_NTZ, "
    "previous_spending_score INT, previous_annual_incomek INT"
)
DIMENSION_AUDIT = _fields(
    "audit_id BIGINT, dimension_name STRING, record_key STRING, change_type STRING, "
    "change_timestamp TIMESTAMP_NTZ, batch_id STRING, old_values STRING, new_values STRING, changed_by STRING, "
    "created_at TIMESTAMP_NTZ"
)
DATA_QUALITY_METRICS = _fields(
    "metric_id BIGINT, batch_id STRING, job_name STRING, table_name STRING, metric_name STRING, "
    "metric_value DECIMAL(18,2), threshold_value DECIMAL(18,2), status STRING, check_timestamp TIMESTAMP_NTZ, "
    "created_at TIMESTAMP_NTZ"
)
JOB_PARAMETERS = _fields(
    "parameter_id BIGINT, job_name STRING, parameter_name STRING, parameter_value STRING, parameter_type STRING, "
    "description STRING, is_active BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)
MARKETING_CAMPAIGN = _fields(
    "ID INT, Year_Birth INT, Education STRING, Marital_Status STRING, Income INT, Kidhome INT, Teenhome INT, "
    "Dt_Customer DATE, Recency INT, MntWines INT, MntFruits INT, MntMeatProducts INT, MntFishProducts INT, "
    "MntSweetProducts INT, MntGoldProds INT, NumDealsPurchases INT, NumWebPurchases INT, NumCatalogPurchases INT, "
    "NumStorePurchases INT, NumWebVisitsMonth INT, AcceptedCmp3 INT, AcceptedCmp4 INT, AcceptedCmp5 INT, "
    "AcceptedCmp1 INT, AcceptedCmp2 INT, Complain INT, Z_CostContact INT, Z_Revenue INT, Response INT"
)

MART_COLUMNS = RETAIL_DATA_MART.names


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the declared columns, by name and in order, with their declared types.

    Columns the frame does not have become null, so a writer can fill only the ones it knows.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
