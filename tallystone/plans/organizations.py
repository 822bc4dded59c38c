"""Borrowers: CRM records and servicing clients conformed into one list."""

from pyspark.sql import functions as F

from ..functions import is_blank, match_key, row_hash, short_us_date
from ..functions.keys import failed_fields
from ..model import CRM_RAW, FROM_CRM, FROM_SERVICING, NO_ORGANIZATION, ORGANIZATION
from ..operators.conflicts import keep_first
from ..operators.numbering import number_copies
from ..operators.skew import salted_lookup

HASHED = ["organization_id", "organization_name", "industry", "state", "relationship_owner",
          "date_added", "source_system"]


def organization_key(name):
    """Key of the borrower a name stands for; a name without letters means the guard."""
    return F.md5(F.coalesce(match_key(name), F.lit(NO_ORGANIZATION)))


def parse_crm(crm_raw):
    return crm_raw.withColumns({
        "match_key": match_key(F.col("org_name")),
        "clean_name": F.upper(F.trim("org_name")),
        "joined_on": short_us_date(F.col("date_added")),
    })


def _first_id():
    return [F.col("organization_id").isNull(), "organization_id", "file_name", "file_row_number"]


def crm_organizations(crm_raw):
    """One row per match key: the record with the first CRM id is the borrower."""
    named = parse_crm(crm_raw).filter(F.col("match_key").isNotNull()).select(
        F.md5("match_key").alias("organization_sk"),
        F.col("org_ref").alias("organization_id"),
        F.col("clean_name").alias("organization_name"),
        "industry", "state", "relationship_owner",
        F.col("joined_on").alias("date_added"),
        F.lit(FROM_CRM).alias("source_system"),
        "file_name", "file_row_number",
    )
    return keep_first(named, "organization_sk", _first_id()).drop("file_name", "file_row_number")


def servicing_only(facility_raw, known):
    """Borrowers that hold facilities but have no CRM record, with a generated id."""
    clients = (
        facility_raw.select(
            match_key(F.col("client_name")).alias("match_key"),
            F.upper(F.trim("client_name")).alias("name"),
        )
        .groupBy("match_key")
        # a filter on the key itself would be pushed down and work every key out again
        .agg(F.min("name").alias("organization_name"),
             F.bool_or(F.col("match_key").isNotNull()).alias("named"))
        .filter("named")
    )
    nothing = F.lit(None)
    return (
        clients.withColumn("organization_sk", F.md5("match_key"))
        .join(known.select("organization_sk"), "organization_sk", "left_anti")
        .select(
            "organization_sk",
            F.concat(F.lit("SV-"), F.upper("organization_sk")).alias("organization_id"),
            "organization_name",
            nothing.cast("string").alias("industry"),
            nothing.cast("string").alias("state"),
            nothing.cast("string").alias("relationship_owner"),
            nothing.cast("date").alias("date_added"),
            F.lit(FROM_SERVICING).alias("source_system"),
        )
    )


def organizations(crm_raw, facility_raw):
    """Staging table: every borrower of either system exactly once."""
    from_crm = crm_organizations(crm_raw)
    conformed = from_crm.unionByName(servicing_only(facility_raw, from_crm))
    hashed = conformed.withColumn("change_tracking_key", row_hash(HASHED))
    return hashed.select(*ORGANIZATION.fieldNames())


def organization_audit(crm_raw):
    """Every copy of a borrower entered more than once, and every defective record.

    The copy whose id was kept carries ``winner_ind``. Records without a usable name or
    with an unreadable date are listed too, with the fields at fault.
    """
    parsed = parse_crm(crm_raw)
    groups = parsed.groupBy("match_key").agg(
        F.count("*").alias("copies"),
        F.min(F.struct(F.col("org_ref").isNull(), "org_ref", "file_name", "file_row_number"))
        .alias("first"),
    )
    sizes = groups.select("match_key", F.col("copies").alias("rows"))
    unreadable = ~is_blank(F.col("date_added")) & F.col("joined_on").isNull()
    checked = parsed.withColumn("parse_fail_fields", failed_fields({
        "ORG_NAME": F.col("match_key").isNull(),
        "DATE_ADDED": unreadable,
    }))
    repeated = groups.filter("copies > 1 and match_key is not null").select(
        "match_key", F.col("first.file_name").alias("first_file"),
        F.col("first.file_row_number").alias("first_row"),
    )
    joined = salted_lookup(
        checked, repeated, ["match_key"], ["file_name", "file_row_number"], sizes
    )
    listed = joined.withColumn("duplicate_ind", F.col("first_file").isNotNull()).filter(
        F.col("duplicate_ind") | (F.col("parse_fail_fields") != "")
    )
    winner = F.col("duplicate_ind") & (F.col("file_name") == F.col("first_file")) & (
        F.col("file_row_number") == F.col("first_row")
    )
    return number_copies(listed, "match_key").select(
        *CRM_RAW.fieldNames(), "record_number",
        row_hash(["org_ref", "record_number"]).alias("duplicate_id"),
        "duplicate_ind",
        F.coalesce(winner, F.lit(False)).alias("winner_ind"),
        "parse_fail_fields",
    )
