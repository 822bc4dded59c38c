"""Loan facilities: format variants unified, disagreeing copies resolved."""

from pyspark.sql import functions as F

from ..functions import any_date, currency, is_blank, rate, row_hash, status_code, surrogate_key
from ..functions.keys import failed_fields
from ..model import FACILITY, FACILITY_RAW
from ..operators.conflicts import apart, collapse_apart
from ..operators.numbering import number_copies
from ..operators.skew import salted_lookup
from .organizations import organization_key

ATTRIBUTES = ["organization_sk", "fund_description", "product_type", "discount_rate",
              "net_funds_employed", "facility_funding_limit", "funding_date", "maturity_date",
              "status"]
HASHED = ["facility_sk", "facility_id", "organization_sk", "fund_description", "product_type",
          "discount_rate", "net_funds_employed", "facility_funding_limit", "funding_date",
          "maturity_date", "status"]


def parse_facilities(facility_raw):
    """Typed columns; the raw texts stay beside them under ``<name>_raw``."""
    raw = facility_raw.withColumnsRenamed({
        c: f"{c}_raw" for c in FACILITY_RAW.fieldNames()[1:10]
    })
    return raw.select(
        "*",
        organization_key(F.col("client_name_raw")).alias("organization_sk"),
        F.col("fund_raw").alias("fund_description"),
        F.col("product_type_raw").alias("product_type"),
        rate(F.col("discount_rate_raw")).alias("discount_rate"),
        currency(F.col("stated_balance_raw")).alias("net_funds_employed"),
        currency(F.col("facility_limit_raw")).alias("facility_funding_limit"),
        any_date(F.col("funding_date_raw")).alias("funding_date"),
        any_date(F.col("maturity_date_raw")).alias("maturity_date"),
        status_code(F.col("status_raw")).alias("status"),
    )


def _unreadable():
    """Raw text present, typed value missing."""
    pairs = {
        "DISCOUNT_RATE": ("discount_rate_raw", "discount_rate"),
        "STATED_BALANCE": ("stated_balance_raw", "net_funds_employed"),
        "FACILITY_LIMIT": ("facility_limit_raw", "facility_funding_limit"),
        "FUNDING_DATE": ("funding_date_raw", "funding_date"),
        "MATURITY_DATE": ("maturity_date_raw", "maturity_date"),
    }
    checks = {"FACILITY_ID": is_blank(F.col("facility_id"))}
    for name, (text, value) in pairs.items():
        checks[name] = ~is_blank(F.col(text)) & F.col(value).isNull()
    return failed_fields(checks)


def facility_conflicts(facility_raw):
    """One row per facility with the agreed values and the fields its copies differ on."""
    identified = parse_facilities(facility_raw).filter(~is_blank(F.col("facility_id")))
    return collapse_apart(apart(identified, "facility_id"), ["facility_id"], ATTRIBUTES)


def agreed_facilities(facility_raw):
    """One row per facility id with the agreed values, before key and hash are worked out."""
    return facility_conflicts(facility_raw).select("facility_id", *ATTRIBUTES)


def keyed_facilities(agreed):
    """Agreed values with key and hash beside them."""
    keyed = agreed.withColumn("facility_sk", surrogate_key(F.col("facility_id")))
    return keyed.withColumn("change_tracking_key", row_hash(HASHED))


def facilities(facility_raw):
    """Staging table: one row per facility id."""
    return keyed_facilities(agreed_facilities(facility_raw)).select(*FACILITY.fieldNames())


def facility_audit(facility_raw):
    """Every copy of a facility reported more than once, and every unreadable record."""
    checked = parse_facilities(facility_raw).withColumn("parse_fail_fields", _unreadable())
    sizes = checked.groupBy("facility_id").agg(F.count("*").alias("rows"))
    repeated = sizes.filter("rows > 1 and facility_id is not null").select(
        "facility_id", F.lit(True).alias("duplicate_ind")
    )
    joined = salted_lookup(
        checked, repeated, ["facility_id"], ["file_name", "file_row_number"], sizes
    ).withColumn("duplicate_ind", F.coalesce("duplicate_ind", F.lit(False)))
    listed = joined.filter(F.col("duplicate_ind") | (F.col("parse_fail_fields") != ""))
    raw_again = [
        F.col(f"{c}_raw").alias(c) for c in FACILITY_RAW.fieldNames()[1:10]
    ]
    # a repeated facility has all its copies listed, so block sizes come from the raw rows
    return number_copies(listed, "facility_id", counted=facility_raw).select(
        "facility_id", *raw_again, "file_name", "file_row_number", "file_last_modified",
        "record_number",
        row_hash(["facility_id", "record_number"]).alias("duplicate_id"),
        "duplicate_ind", "parse_fail_fields",
    )
