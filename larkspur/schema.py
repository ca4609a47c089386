"""Column names, types and the fixed values that results depend on."""

from pyspark.sql import types as T

# Identifier columns, store bookkeeping columns and target names, in lookup order.
ID_COLUMNS = ("customer_id", "id", "ID", "CustomerID", "Customer_ID")
STORE_COLUMNS = ("event_time", "write_time", "api_invocation_time", "is_deleted")
TARGET_NAMES = ("target", "churn", "loan_approved", "label", "y", "class")
SCORING_TARGET_NAMES = ("churn", "target", "label", "y", "class")

RECORD_ID = "customer_id"
EVENT_TIME = "event_time"
TARGET = "churn"
UNKNOWN = "Unknown"

NUMERIC = ("age", "tenure_months", "monthly_charges", "total_charges")
CATEGORICAL = (
    "contract_type",
    "payment_method",
    "internet_service",
    "phone_service",
    "multiple_lines",
    "online_security",
    "tech_support",
    "device_protection",
)

# Texts a CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in (RECORD_ID, *NUMERIC, *CATEGORICAL, TARGET)]
)

CLEAN = T.StructType(
    [T.StructField(RECORD_ID, T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL]
    + [T.StructField(TARGET, T.IntegerType())]
)

# The labelled table that batch scoring reads has fixed types: whole years and months.
LABELLED = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.name in ("age", "tenure_months") else f.dataType)
        for f in CLEAN
    ]
)
