"""Ledger transactions: typed, flagged, resolved to one row per id, or quarantined.

A batch is what was delivered together. Copies that disagree within a delivery NULL the
field they disagree on; a later delivery corrects an earlier one.
"""

from itertools import chain

from pyspark.sql import functions as F

from ..functions import accounting_amount, is_blank, ledger_date, row_hash, surrogate_key
from ..functions.keys import failed_fields
from ..model import LEDGER_RAW, NULL_MARK, TRANSACTION
from ..operators.conflicts import apart, collapse_apart, collapse_copies, newest_only
from ..operators.numbering import number_copies
from ..operators.skew import salted_lookup

FIELDS = ["transaction_date", "fund_description", "share_class", "facility_id",
          "transaction_type", "amount"]


def full_fund_name(fund, aliases):
    """The servicing system's spelling of a fund the ledger abbreviates."""
    if not aliases:
        return fund
    spelled = F.create_map(*[F.lit(text) for text in chain(*aliases.items())])
    return F.coalesce(F.element_at(spelled, fund), fund)


def parse_transactions(ledger_raw, aliases=None):
    """Typed columns beside the raw texts. A blank value is not a parse failure."""
    raw = ledger_raw.withColumnsRenamed(
        {"transaction_date": "transaction_date_raw", "amount": "amount_raw"}
    )
    typed = raw.withColumns({
        "transaction_sk": surrogate_key(F.col("transaction_id")),
        "transaction_date": ledger_date(F.col("transaction_date_raw")),
        "fund_description": full_fund_name(F.col("fund"), aliases),
        "facility_id": F.col("investment_ref"),
        "amount": accounting_amount(F.col("amount_raw")),
    })
    return typed.withColumn("parse_fail_fields", failed_fields({
        "TRANSACTION_ID": is_blank(F.col("transaction_id")),
        "TRANSACTION_DATE":
            ~is_blank(F.col("transaction_date_raw")) & F.col("transaction_date").isNull(),
        "AMOUNT": ~is_blank(F.col("amount_raw")) & F.col("amount").isNull(),
    })).withColumn("parse_fail_ind", F.col("parse_fail_fields") != "")


def with_id_key(parsed):
    """Rows without an id share one key."""
    return parsed.withColumn("id_key", F.coalesce("transaction_id", F.lit(NULL_MARK)))


READABLE = "not parse_fail_ind"


def by_copies(parsed):
    """Parsed rows taken apart: those whose id is the only one of its kind, and the others."""
    return apart(with_id_key(parsed), "id_key")


def agreed_by_id(parsed, delivery, copies=None):
    """Agreed values and conflict flags per transaction id, blank ids together."""
    if delivery is None:
        return collapse_apart(copies or by_copies(parsed), ["id_key"], FIELDS, READABLE)
    keys = ["id_key", delivery]
    per_delivery = collapse_apart(apart(with_id_key(parsed), keys), keys, FIELDS, READABLE)
    # a delivery with no readable copy of an id has nothing to say about it
    speaking = per_delivery.withColumn(
        delivery, F.when(F.col("usable_copies") > 0, F.col(delivery))
    )
    return newest_only(speaking, "id_key", delivery)


def readable_by_id(parsed, delivery=None, copies=None):
    """The ids with at least one readable copy.

    Filtering after the aggregate spares the rows a second parse: a filter on parsed
    columns would be pushed down to the texts and parse them again.
    """
    return agreed_by_id(parsed, delivery, copies).filter("usable_copies > 0")


FLAGS = [f"{f}_conflict_ind" for f in FIELDS]


def _flagged(copies):
    """The rows of repeated ids, each with its copy number, duplicate and conflict flags."""
    rows = copies.repeated
    groups = collapse_copies(rows, ["id_key"], FIELDS, READABLE)
    sizes = groups.select("id_key", F.col("copies").alias("rows"))
    found = groups.filter("copies > 1").select(
        "id_key", F.lit(True).alias("duplicate_ind"), *FLAGS, "conflict_ind"
    )
    joined = salted_lookup(rows, found, ["id_key"], ["file_name", "file_row_number"], sizes)
    flagged = joined.fillna(False, ["duplicate_ind", *FLAGS, "conflict_ind"])
    counted = rows.select("id_key", "file_name", "file_row_number")
    return number_copies(flagged, "id_key", counted=counted)


def _unflagged(rows):
    """Rows of ids that occur once, with the same columns."""
    return rows.withColumns({
        **{c: F.lit(False) for c in ("duplicate_ind", *FLAGS, "conflict_ind")},
        "record_number": F.lit(1).cast("long"),
    })


def flag_transactions(parsed, copies=None):
    """All rows, each with its copy number, duplicate flag and the six conflict flags."""
    copies = copies or by_copies(parsed)
    return _unflagged(copies.single).unionByName(_flagged(copies)).drop("id_key")


def resolve_transactions(parsed, delivery=None, copies=None):
    """Staging table: one row per id; disputed fields NULL; unreadable copies held out.

    ``delivery`` names the column that tells deliveries of one batch apart, if any.
    """
    resolved = readable_by_id(parsed, delivery, copies).withColumnRenamed(
        "id_key", "transaction_id")
    return resolved.withColumn("transaction_sk", surrogate_key(F.col("transaction_id"))).select(
        *TRANSACTION.fieldNames()
    )


def audit_transactions(parsed, run_ts, copies=None):
    """Duplicates, conflicts and unreadable rows, as delivered, with the reasons."""
    copies = copies or by_copies(parsed)
    suspect = F.col("duplicate_ind") | F.col("conflict_ind") | F.col("parse_fail_ind")
    listed = _unflagged(copies.single.filter("parse_fail_ind")).unionByName(
        _flagged(copies).filter(suspect))
    as_delivered = {"transaction_date": "transaction_date_raw", "amount": "amount_raw"}
    return listed.select(
        *[F.col(as_delivered.get(c, c)).alias(c) for c in LEDGER_RAW.fieldNames()],
        "record_number",
        row_hash(["file_name", "file_row_number", "transaction_id"]).alias("audit_record_sk"),
        "duplicate_ind", "conflict_ind", "parse_fail_ind", "parse_fail_fields",
        F.lit(run_ts).cast("timestamp_ntz").alias("batch_ts"),
    )


def absent_only(incoming, existing, key="audit_record_sk"):
    """Rows not recorded before: appending them twice is the same as once."""
    return incoming.join(existing.select(key), key, "left_anti").select(*incoming.columns)
