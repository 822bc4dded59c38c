"""Column layout of every layer, and the fixed values the data model relies on."""

from pyspark.sql import types as T

MONEY = T.DecimalType(35, 3)
RATE = T.DecimalType(5, 4)


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _text(*names):
    return [(name, T.StringType()) for name in names]


PROVENANCE = [
    ("file_name", T.StringType()),
    ("file_row_number", T.LongType()),
    ("file_last_modified", T.TimestampNTZType()),
]

# Business columns of the three exports; files are read by position, all as text.
CRM_FIELDS = ["org_ref", "org_name", "industry", "state", "relationship_owner", "date_added"]
FACILITY_FIELDS = [
    "facility_id", "client_name", "fund", "product_type", "status", "facility_limit",
    "stated_balance", "discount_rate", "funding_date", "maturity_date",
]
LEDGER_FIELDS = [
    "transaction_id", "transaction_date", "fund", "share_class", "investment_ref",
    "transaction_type", "amount",
]

CRM_RAW = _struct(*_text(*CRM_FIELDS), *PROVENANCE)
FACILITY_RAW = _struct(*_text(*FACILITY_FIELDS), *PROVENANCE)
LEDGER_RAW = _struct(*_text(*LEDGER_FIELDS), *PROVENANCE)

ORGANIZATION = _struct(
    *_text("organization_sk", "organization_id", "organization_name", "industry", "state",
           "relationship_owner"),
    ("date_added", T.DateType()),
    *_text("source_system", "change_tracking_key"),
)
FACILITY = _struct(
    *_text("facility_sk", "facility_id", "organization_sk", "fund_description", "product_type"),
    ("discount_rate", RATE),
    ("net_funds_employed", MONEY),
    ("facility_funding_limit", MONEY),
    ("funding_date", T.DateType()),
    ("maturity_date", T.DateType()),
    *_text("status", "change_tracking_key"),
)
TRANSACTION = _struct(
    *_text("transaction_sk", "transaction_id"),
    ("transaction_date", T.DateType()),
    *_text("fund_description", "share_class", "facility_id", "transaction_type"),
    ("amount", MONEY),
)
VERSIONING = [
    ("record_version_number", T.IntegerType()),
    ("is_current_ind", T.BooleanType()),
    ("record_valid_from_ts", T.TimestampNTZType()),
    ("record_valid_to_ts", T.TimestampNTZType()),
    ("scd_id", T.StringType()),
]


def versioned(schema):
    """The dimension layout for a staging layout: the same columns plus validity."""
    return T.StructType(schema.fields + _struct(*VERSIONING).fields)


DIM_ORGANIZATION = versioned(ORGANIZATION)
DIM_FACILITY = versioned(FACILITY)
FACT_SOURCE = _struct(
    *_text("transaction_sk", "transaction_id"),
    ("transaction_date", T.DateType()),
    *_text("fund_description", "share_class", "facility_sk", "facility_id", "transaction_type"),
    ("amount", MONEY),
    ("known_facility_ind", T.BooleanType()),
    ("adjustment_ind", T.BooleanType()),
    ("change_tracking_key", T.StringType()),
)
FACT = T.StructType(FACT_SOURCE.fields + _struct(
    ("record_inserted_ts", T.TimestampNTZType()),
    ("record_updated_ts", T.TimestampNTZType()),
).fields)


def as_stored(schema):
    """A layout of transactions whose keys and hash are stored as bytes."""
    return T.StructType([T.StructField(f.name, T.BinaryType()) if f.name in (
        "transaction_sk", "facility_sk", "change_tracking_key") else f for f in schema.fields])


# The null marker, guard members, open statuses, type of a cash receipt,
# end-of-time stamp. They must equal the values the reports and keys are defined with.
NULL_MARK = "~NULL~"
NO_FACILITY = "NULL FACILITY"
NO_ORGANIZATION = "NULL ORGANIZATION"
STATUSES = ["ACTIVE", "WATCH-LIST", "CLOSED", "PAID-OFF"]
OPEN_STATUSES = ["ACTIVE", "WATCH-LIST"]
SHARE_CLASSES = ["Class A", "Class B"]
REMITTANCE = "Remittance"
END_OF_TIME = "9999-12-31 23:59:59"
FROM_CRM = "CRM"
FROM_SERVICING = "SERVICING"
FROM_NOWHERE = "SYNTHETIC"


def empty(spark, schema):
    """An empty table with a given layout."""
    return spark.createDataFrame([], schema)
