"""Relations for an application: borrowers, loans, pages of loans, the book at a glance."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions import same_text
from ..model import STATUSES
from ..operators.skew import salted_lookup
from .marts import current_borrowers, current_members
from .portfolio import status_label


#: Rows that a page may skip by number.
MOST_SKIPPED = 10_000

LOAN = [
    "facility_id", "organization_id", "organization_name", "industry", "fund_description",
    "product_type", "status", "net_funds_employed", "facility_funding_limit", "discount_rate",
    "funding_date", "maturity_date",
]


def api_borrower(marts):
    return current_borrowers(marts.organization).select(
        "organization_id", "organization_name", "industry", "state", "relationship_owner"
    )


def with_borrower(facilities, marts):
    """Facilities with their borrower's columns, NULL where there is no real one."""
    borrowers = current_borrowers(marts.organization).select(
        "organization_sk", "organization_id", "organization_name", "industry"
    )
    return salted_lookup(facilities, borrowers, ["organization_sk"], ["facility_id"]).select(
        *LOAN
    )


def api_loan(marts):
    """Every real facility; one without a borrower stays, with NULL borrower columns."""
    return with_borrower(current_members(marts.facility), marts)


def filter_loans(loans, status=None, fund=None):
    """Optional filters, any casing; ``UNKNOWN`` finds loans without a status.

    Any other status outside the domain is refused.
    """
    wanted = []
    if status is not None:
        if status.upper() not in [*STATUSES, "UNKNOWN"]:
            raise ValueError(f"unknown loan status {status!r}")
        wanted.append(same_text(status_label(), F.lit(status)))
    if fund is not None:
        wanted.append(same_text(F.col("fund_description"), F.lit(fund)))
    return loans.filter(reduce(lambda a, b: a & b, wanted, F.lit(True)))


def loan_page(marts, status=None, fund=None, limit=50, offset=0, after=None):
    """One page in facility order, each row with the number of loans that match.

    Facilities are filtered and paged first, and only the page meets the borrowers. A deep
    page is asked for by ``after``, the last facility id of the page before: an ``offset``
    holds all rows up to the page in one place.
    """
    if not 1 <= limit <= 200 or not 0 <= offset <= MOST_SKIPPED:
        raise ValueError(f"limit must be 1 to 200 and offset 0 to {MOST_SKIPPED}")
    matching = filter_loans(current_members(marts.facility), status, fund)
    total = matching.agg(F.count("*").alias("total"))
    rest = matching if after is None else matching.filter(F.col("facility_id") > after)
    page = rest.orderBy("facility_id").offset(offset).limit(limit)
    borrowers = current_borrowers(marts.organization).select(
        "organization_sk", "organization_id", "organization_name", "industry"
    )
    needed = borrowers.join(F.broadcast(page.select("organization_sk")), "organization_sk",
                            "left_semi")
    named = page.join(F.broadcast(needed), "organization_sk", "left").select(*LOAN)
    return named.crossJoin(F.broadcast(total)).orderBy("facility_id")


def borrower_loans(marts, organization_id):
    """A borrower's loans. No row: unknown borrower. NULL facility: borrower without loans."""
    wanted = current_borrowers(marts.organization).filter(
        same_text(F.col("organization_id"), F.lit(organization_id))
    )
    loans = current_members(marts.facility).select(
        "organization_sk", "facility_id", "status", "net_funds_employed"
    )
    return wanted.join(loans, "organization_sk", "left").select(
        "organization_id", "organization_name", "facility_id", "status", "net_funds_employed"
    ).orderBy("facility_id")


def loans_per_borrower(marts):
    """The same answer for every borrower at once: loan count and balance, zero included."""
    sums = current_members(marts.facility).groupBy("organization_sk").agg(
        F.count("*").alias("n"), F.sum("net_funds_employed").alias("amount")
    )
    return current_borrowers(marts.organization).join(sums, "organization_sk", "left").select(
        "organization_id", "organization_name", F.coalesce("n", F.lit(0)).alias("loans"),
        F.coalesce("amount", F.lit(0)).cast("decimal(38,3)").alias("outstanding"),
    )


def portfolio_summary(marts, k=5):
    """Totals, status buckets and the largest borrowers of all statuses, as report lines."""
    known = current_members(marts.facility)
    zero = F.lit(0).cast("decimal(38,3)")
    money = F.coalesce(F.sum("net_funds_employed"), zero).cast("decimal(38,3)")
    buckets = known.groupBy("status").agg(
        F.count("*").alias("loans"),
        F.count_if(F.col("net_funds_employed").isNull()).alias("missing_balance"),
        money.alias("outstanding"),
    )
    totals = buckets.agg(
        F.sum("loans").alias("loans"), F.sum("missing_balance").alias("missing_balance"),
        F.coalesce(F.sum("outstanding"), zero).cast("decimal(38,3)").alias("outstanding"),
    )
    borrowers = current_borrowers(marts.organization).select(
        "organization_sk", "organization_id"
    )
    nothing = F.lit(None).cast("bigint")
    largest = (
        known.groupBy("organization_sk").agg(F.count("*").alias("loans"), money.alias("outstanding"))
        .join(borrowers, "organization_sk", "left")
        .groupBy("organization_id")
        .agg(F.sum("loans").alias("loans"), F.sum("outstanding").cast("decimal(38,3)")
             .alias("outstanding"))
        .orderBy(F.desc("outstanding"), "organization_id").limit(k)
        .select(F.lit("TOP BORROWER").alias("section"), F.col("organization_id").alias("label"),
                "loans", nothing.alias("missing_balance"), "outstanding")
    )
    lines = (
        totals.select(F.lit("TOTAL").alias("section"), F.lit("ALL").alias("label"),
                      "loans", "missing_balance", "outstanding")
        .unionByName(buckets.select(F.lit("STATUS").alias("section"),
                                    F.col("status").alias("label"), "loans", "missing_balance",
                                    "outstanding"))
        .unionByName(largest)
    )
    book = totals.select(F.col("outstanding").cast("double").alias("_book"))
    share = F.when(F.col("_book") != 0, F.col("outstanding").cast("double") / F.col("_book"))
    return lines.crossJoin(F.broadcast(book)).withColumn(
        "share_of_total", F.round(F.coalesce(share, F.lit(0.0)), 6)
    ).drop("_book")
