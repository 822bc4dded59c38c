"""Portfolio reports over the marts.

All take the current state of the marts. Shares are computed in double precision because
a decimal quotient keeps too few digits to round correctly. Borrower-level reports sum
facilities per borrower before they meet the borrower dimension.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import currency
from ..model import (
    FROM_NOWHERE, FROM_SERVICING, NO_ORGANIZATION, OPEN_STATUSES, REMITTANCE,
)
from .marts import current_borrowers, current_members

NO_CRM = "NOT IN CRM"
NO_INDUSTRY = "INDUSTRY NOT SET"
NO_BORROWER = "Unmapped borrower"


def percent(part, whole):
    return F.round(part.cast("double") / whole.cast("double") * 100, 2)


def is_open():
    return F.coalesce(F.col("status").isin(OPEN_STATUSES), F.lit(False))


def status_label():
    return F.coalesce("status", F.lit("UNKNOWN"))


def in_year(year, column="transaction_date"):
    """A range of dates, which can be pushed into a scan."""
    return F.col(column).between(
        F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date")
    )


def remittances(fact):
    return fact.filter(F.col("transaction_type") == REMITTANCE)


def total_outstanding(marts):
    return current_members(marts.facility).agg(
        F.count("*").alias("total_facilities"),
        (F.count("*") - F.count("net_funds_employed")).alias("facilities_missing_balance"),
        F.sum("net_funds_employed").alias("total_outstanding"),
    )


def outstanding_by_status(marts):
    """Statuses are few, so the share is taken by a window over the finished totals."""
    totals = current_members(marts.facility).groupBy(status_label().alias("status")).agg(
        F.count("*").alias("facilities"), F.sum("net_funds_employed").alias("outstanding")
    )
    whole = F.sum("outstanding").over(Window.partitionBy())
    return totals.withColumn("pct_of_total", percent(F.col("outstanding"), whole)).orderBy(
        F.desc("outstanding"), "status"
    )


def blank_balances(facility_raw, marts):
    """Balances the servicing system left blank or unreadable, and what the ledger says."""
    stated = facility_raw.filter(currency(F.col("stated_balance")).isNull())
    return (
        stated.select("facility_id", "stated_balance").distinct()
        .join(
            marts.facility.filter("is_current_ind").select(
                "facility_id", "status", F.col("net_funds_employed").alias("current_balance")
            ),
            "facility_id",
        )
        .orderBy("facility_id")
    )


def orphan_totals(marts):
    """Transactions on facilities the servicing system has never seen."""
    return marts.fact.filter(~F.col("known_facility_ind")).agg(
        F.count("*").alias("orphan_transactions"),
        F.countDistinct("facility_id").alias("orphan_facility_ids"),
        F.sum("amount").alias("orphan_amount"),
    )


def orphan_facilities(marts):
    """The unknown facility ids themselves, one per row."""
    return (
        marts.fact.filter(~F.col("known_facility_ind"))
        .groupBy("facility_id")
        .agg(F.count("*").alias("transactions"), F.sum("amount").alias("amount"))
        .orderBy("facility_id")
    )


def borrower_exposure(facilities):
    """Facilities summed per borrower key, ahead of any join."""
    return facilities.groupBy("organization_sk").agg(
        F.count("*").alias("facilities"), F.sum("net_funds_employed").alias("exposure")
    )


def top_borrowers(marts, k=5):
    """Largest open exposures, as share of the open book and of the portfolio."""
    known = current_members(marts.facility)
    books = known.agg(
        F.sum(F.when(is_open(), F.col("net_funds_employed"))).alias("open_book"),
        F.sum("net_funds_employed").alias("whole_book"),
    )
    names = marts.organization.filter("is_current_ind").select(
        "organization_sk", "organization_id", "organization_name"
    )
    ranked = (
        borrower_exposure(known.filter(is_open() & has_borrower()))
        .join(names, "organization_sk")
        .orderBy(F.desc_nulls_last("exposure"), "organization_id")
        .limit(k)
    )
    return ranked.crossJoin(F.broadcast(books)).select(
        "organization_id", "organization_name",
        F.col("facilities").alias("open_facilities"), "exposure",
        percent(F.col("exposure"), F.col("open_book")).alias("pct_of_open_book"),
        percent(F.col("exposure"), F.col("whole_book")).alias("pct_of_portfolio"),
    ).orderBy(F.desc_nulls_last("exposure"), "organization_id")


def excluded_exposure(marts):
    """What the open-only filter leaves out, by status."""
    return (
        current_members(marts.facility).filter(~is_open())
        .groupBy(status_label().alias("status"))
        .agg(F.count("*").alias("facilities"),
             F.sum("net_funds_employed").alias("excluded_exposure"))
        .orderBy(F.desc("excluded_exposure"), "status")
    )


def excluded_facilities(marts):
    """The facilities left out, one per row, as a list in one value would not scale."""
    return (
        current_members(marts.facility).filter(~is_open())
        .select(status_label().alias("status"), "facility_id", "net_funds_employed")
        .orderBy("status", "facility_id")
    )


def month_spine(spark, year):
    first = F.lit(f"{year}-01-01").cast("date")
    months = F.sequence(first, F.add_months(first, 11), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month_start"))


def monthly_remittances(marts, year):
    """Remittances per month and fund on a complete grid: a quiet month shows zero.

    Money whose fund is unknown or disputed has a line of its own, without a fund.
    """
    received = (
        remittances(marts.fact).filter(in_year(year))
        .groupBy(F.trunc("transaction_date", "month").alias("month_start"), "fund_description")
        .agg(F.count("amount").alias("n"), F.sum("amount").alias("total"))
    )
    funds = current_members(marts.facility).select("fund_description").union(
        received.select("fund_description")).distinct()
    grid = F.broadcast(month_spine(marts.fact.sparkSession, year)).crossJoin(funds)
    same = [grid[c].eqNullSafe(received[c]) for c in ("month_start", "fund_description")]
    return grid.join(received, same, "left").select(
        grid["month_start"], grid["fund_description"],
        F.coalesce("n", F.lit(0)).alias("remittances"),
        F.coalesce("total", F.lit(0)).cast("decimal(38,3)").alias("remittance_total"),
    )


def year_totals(marts, year):
    return (
        remittances(marts.fact).filter(in_year(year)).groupBy("fund_description")
        .agg(F.count("*").alias("remittances"), F.sum("amount").alias("remittance_total"))
        .orderBy(F.desc_nulls_last("remittance_total"), "fund_description")
    )


def orphan_remittances(marts, year):
    return (
        remittances(marts.fact).filter(in_year(year) & ~F.col("known_facility_ind"))
        .select("transaction_id", "transaction_date", "facility_id",
                F.col("fund_description").alias("ledger_fund"), "amount")
        .orderBy("transaction_id")
    )


def outside_year(marts, year, k=10):
    """The latest remittances the year filter leaves out."""
    return (
        remittances(marts.fact).filter(~in_year(year))
        .select("transaction_id", "transaction_date", "facility_id", "amount")
        .orderBy(F.desc_nulls_last("transaction_date"), "transaction_id")
        .limit(k)
    )


def raw_name_loss(crm_raw, facility_raw):
    """How many facilities a join on the names as typed would lose."""
    clients = facility_raw.select(
        "facility_id", F.upper(F.trim("client_name")).alias("name")
    ).distinct()
    names = crm_raw.select(F.upper(F.trim("org_name")).alias("name")).distinct()
    per_name = clients.groupBy("name").agg(F.count("*").alias("facilities"))
    matched = names.filter(F.col("name").isNotNull()).withColumn("found", F.lit(True))
    counts = per_name.join(matched, "name", "left").agg(
        F.sum("facilities").alias("facilities"),
        F.coalesce(F.sum(F.when(F.col("found"), F.col("facilities"))), F.lit(0))
        .alias("matched_on_raw_name"),
    )
    return counts.withColumn("lost_to_the_join",
                             F.col("facilities") - F.col("matched_on_raw_name"))


def has_borrower():
    """The facility names a borrower; one without leads to the guard member or nowhere."""
    return F.col("organization_sk") != F.md5(F.lit(NO_ORGANIZATION))


def industry_label():
    unknown = F.col("source_system").isNull() | (F.col("source_system") == FROM_NOWHERE)
    return (
        F.when(unknown, NO_BORROWER)
        .when(F.col("source_system") == FROM_SERVICING, NO_CRM)
        .when(F.col("industry").isNull(), NO_INDUSTRY)
        .otherwise(F.col("industry"))
    )


def labelled_borrowers(marts):
    """Exposure per borrower with its industry, or the reason there is none."""
    known = current_members(marts.facility)
    per_borrower = known.groupBy("organization_sk").agg(
        F.count("*").alias("facilities"),
        F.sum("net_funds_employed").alias("exposure"),
        F.sum(F.when(is_open(), F.col("net_funds_employed")).otherwise(
            F.lit(0).cast("decimal(35,3)"))).alias("open_exposure"),
    )
    crm = marts.organization.filter("is_current_ind").select(
        "organization_sk", "industry", "source_system"
    )
    return per_borrower.join(crm, "organization_sk", "left").withColumn(
        "industry", industry_label()
    )


def exposure_by_industry(marts):
    totals = labelled_borrowers(marts).groupBy("industry").agg(
        F.count(F.when(F.col("source_system") != FROM_NOWHERE, 1)).alias("borrowers"),
        F.sum("facilities").alias("facilities"),
        F.sum("exposure").alias("exposure"),
        F.sum("open_exposure").alias("open_exposure"),
    )
    whole = F.sum("exposure").over(Window.partitionBy())
    return totals.withColumn("pct_of_portfolio", percent(F.col("exposure"), whole)).orderBy(
        F.desc("exposure"), "industry"
    )


def unmapped_borrowers(marts):
    """The borrowers behind the three labels that are no industry, one line for none at all."""
    members = marts.organization.filter("is_current_ind").select(
        "organization_sk", "organization_name", "source_system", "industry")
    known = (F.col("source_system") != FROM_NOWHERE) & (F.col("source_system") != FROM_SERVICING)
    return (
        borrower_exposure(current_members(marts.facility))
        .join(members, "organization_sk", "left")
        .filter(~F.coalesce(known & F.col("industry").isNotNull(), F.lit(False)))
        .select(
            F.when(F.col("source_system") != FROM_NOWHERE, F.col("organization_name"))
            .alias("organization_name"),
            F.when(F.col("source_system") != FROM_NOWHERE, F.col("source_system"))
            .alias("source_system"), "facilities", "exposure")
        .groupBy("organization_name", "source_system")
        .agg(F.sum("facilities").alias("facilities"), F.sum("exposure").alias("exposure"))
    )


def investor_summary(marts, k=5):
    """Portfolio, fund, open / not open and concentration totals; no names, no ids.

    One pass sums facilities per borrower, fund and position; grouping sets then give the
    first three blocks. Concentration is a single total, not a ranking.
    """
    cells = (
        current_members(marts.facility)
        .groupBy(
            "organization_sk", "fund_description",
            F.when(is_open(), "OPEN").otherwise("NOT OPEN").alias("position_status"),
        )
        .agg(F.count("*").alias("n"), F.sum("net_funds_employed").alias("amount"))
    )
    level = F.grouping_id("fund_description", "position_status")
    blocks = cells.groupingSets(
        [["fund_description"], ["position_status"], []], "fund_description", "position_status"
    ).agg(
        level.alias("level"),
        F.sum("n").alias("facility_count"),
        F.countDistinct(F.when(has_borrower(), F.col("organization_sk"))).alias("borrower_count"),
        F.sum("amount").cast("decimal(38,3)").alias("outstanding_balance"),
    ).select(
        F.when(F.col("level") == 3, 1).when(F.col("level") == 1, 2).otherwise(3)
        .alias("display_order"),
        F.when(F.col("level") == 3, "PORTFOLIO").when(F.col("level") == 1, "FUND")
        .otherwise("POSITION STATUS").alias("metric_group"),
        F.when(F.col("level") == 3, "TOTAL").when(F.col("level") == 1, F.col("fund_description"))
        .otherwise(F.col("position_status")).alias("metric_label"),
        "facility_count", "borrower_count", "outstanding_balance",
    )
    largest = (
        cells.filter((F.col("position_status") == "OPEN") & has_borrower())
        .groupBy("organization_sk")
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        .orderBy(F.desc_nulls_last("amount"), "organization_sk").limit(k)
    )
    concentration = largest.agg(
        F.lit(4).alias("display_order"),
        F.lit("CONCENTRATION").alias("metric_group"),
        F.lit(f"TOP {k} BORROWERS BY OPEN EXPOSURE").alias("metric_label"),
        F.sum("n").alias("facility_count"),
        F.count("*").alias("borrower_count"),
        F.sum("amount").cast("decimal(38,3)").alias("outstanding_balance"),
    )
    # a handful of rows: portfolio, funds, two positions, concentration
    lines = blocks.unionByName(concentration)
    total = F.max(F.when(F.col("metric_group") == "PORTFOLIO", F.col("outstanding_balance"))).over(
        Window.partitionBy()
    )
    return lines.withColumn(
        "pct_of_portfolio", percent(F.col("outstanding_balance"), total)
    ).orderBy("display_order", "metric_label")
