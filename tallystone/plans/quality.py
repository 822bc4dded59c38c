"""Data-quality log with measured counts, and checks that report PASS or FAIL as rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import is_blank, match_key
from ..model import (
    FROM_CRM, FROM_SERVICING, NO_FACILITY, NO_ORGANIZATION, REMITTANCE,
)
from ..operators.conflicts import apart
from ..operators.skew import salted_lookup
from .facilities import facility_conflicts, parse_facilities
from .marts import current_borrowers, current_members
from .organizations import parse_crm
from .portfolio import (
    in_year, investor_summary, is_open, labelled_borrowers, monthly_remittances, percent,
    remittances,
)
from .serving import api_borrower, api_loan
from .transactions import parse_transactions, readable_by_id

# The rule catalogue: layer, table, field, kind of issue, what is wrong, what is done.
RULES = {
    "org_copies": ("STAGING", "INT_ORGANIZATION", None, "DUPLICATES - SIMPLE",
                   "CRM records that repeat a borrower under another id or spelling",
                   "The first id is kept; every copy is audited"),
    "org_key": ("STAGING", "INT_ORGANIZATION", None, "MISSING-SURROGATE-KEY",
                "CRM records without a key shared with the other systems",
                "The normalized name is hashed into the borrower key"),
    "org_date_text": ("STAGING", "INT_ORGANIZATION", "DATE_ADDED", "ENFORCE-TYPE",
                      "Dates held as text", "Parsed to dates"),
    "org_date_bad": ("STAGING", "AUDIT_ORGANIZATION", "DATE_ADDED", "UNPARSEABLE-VALUES",
                     "Dates that cannot be read", "NULL in staging, record audited"),
    "org_unnamed": ("STAGING", "AUDIT_ORGANIZATION", "ORG_NAME", "UNPARSEABLE-VALUES",
                    "Records without a usable name", "Held out of staging, record audited"),
    "org_servicing": ("STAGING", "INT_ORGANIZATION", None, "UNMATCHED-BORROWER",
                      "Borrowers with facilities and no CRM record",
                      "Given a borrower row of their own, tagged with its source"),
    "fac_key": ("STAGING", "INT_FACILITY", None, "MISSING-SURROGATE-KEY",
                "Facility records without a surrogate key", "The facility id is hashed"),
    "fac_status": ("STAGING", "INT_FACILITY", "STATUS", "INCONSISTENT-FORMATTING",
                   "Statuses in another spelling than the canonical one",
                   "Upper-cased, hyphenated, variants unified"),
    "fac_rate": ("STAGING", "INT_FACILITY", "DISCOUNT_RATE", "ENFORCE-TYPE",
                 "Rates written as percentages", "Divided by 100 and typed"),
    "fac_balance": ("STAGING", "INT_FACILITY", "NET_FUNDS_EMPLOYED", "ENFORCE-TYPE",
                    "Balances with currency signs or separators", "Stripped and typed"),
    "fac_limit": ("STAGING", "INT_FACILITY", "FACILITY_FUNDING_LIMIT", "ENFORCE-TYPE",
                  "Limits with currency signs or separators", "Stripped and typed"),
    "fac_funded": ("STAGING", "INT_FACILITY", "FUNDING_DATE", "ENFORCE-TYPE",
                   "Funding dates not in ISO form", "Parsed by their separators"),
    "fac_matures": ("STAGING", "INT_FACILITY", "MATURITY_DATE", "ENFORCE-TYPE",
                    "Maturity dates not in ISO form", "Parsed by their separators"),
    "fac_copies": ("STAGING", "INT_FACILITY", None, "DUPLICATES - SIMPLE",
                   "Facilities whose copies differ in format only", "Collapsed to one row"),
    "fac_status_conflict": ("STAGING", "INT_FACILITY", "STATUS", "DUPLICATES - COMPOUND",
                            "Facilities whose copies disagree on status",
                            "Status is NULL, copies audited"),
    "fac_limit_conflict": ("STAGING", "INT_FACILITY", "FACILITY_FUNDING_LIMIT",
                           "DUPLICATES - COMPOUND",
                           "Facilities whose copies disagree on the limit",
                           "Limit is NULL, copies audited"),
    "fac_balance_conflict": ("STAGING", "INT_FACILITY", "NET_FUNDS_EMPLOYED",
                             "DUPLICATES - COMPOUND",
                             "Facilities whose copies disagree on the stated balance",
                             "Balance is NULL until the ledger supplies it"),
    "fac_orphans": ("STAGING", "INT_FACILITY", "ORGANIZATION_SK", "REFERENTIAL-INTEGRITY",
                    "Facilities whose borrower key finds no borrower",
                    "Kept, shown without a borrower"),
    "txn_key": ("STAGING", "INT_TRANSACTION", None, "MISSING-SURROGATE-KEY",
                "Ledger rows without a surrogate key", "The transaction id is hashed"),
    "txn_facility_key": ("STAGING", "INT_TRANSACTION", None, "MISSING-SURROGATE-FOREIGN-KEY",
                         "Ledger rows that cite their facility by an id of no fixed form",
                         "The cited id is hashed into the facility key"),
    "txn_date": ("STAGING", "INT_TRANSACTION", "TRANSACTION_DATE", "ENFORCE-TYPE",
                 "Dates held as text", "Parsed to dates"),
    "txn_amount": ("STAGING", "INT_TRANSACTION", "AMOUNT", "ENFORCE-TYPE",
                   "Negative amounts written in parentheses", "Typed with their sign"),
    "txn_alias": ("STAGING", "INT_TRANSACTION", "FUND_DESCRIPTION", "INCONSISTENT-FORMATTING",
                  "Fund names abbreviated by the ledger", "Replaced by the full name"),
    "txn_fund_conflict": ("STAGING", "INT_TRANSACTION", "FUND_DESCRIPTION",
                          "DUPLICATES - COMPOUND",
                          "Transactions whose copies disagree on the fund",
                          "Fund is NULL, copies audited"),
    "txn_amount_conflict": ("STAGING", "INT_TRANSACTION", "AMOUNT", "DUPLICATES - COMPOUND",
                            "Transactions whose copies disagree on the amount",
                            "Amount is NULL, copies audited"),
    "txn_bad": ("STAGING", "AUDIT_TRANSACTION", None, "UNPARSEABLE-VALUES",
                "Ledger rows with an unreadable or missing value",
                "Held out of the fact, audited with the fields at fault"),
    "txn_resent": ("STAGING", "AUDIT_TRANSACTION", None, "DUPLICATES - CROSS-BATCH",
                   "Transactions that a later delivery sends again",
                   "The same values change nothing; other values correct the earlier ones"),
    "fact_fund": ("MARTS", "FACT_TRANSACTION", "FUND_DESCRIPTION", "DATA CONFLICT",
                  "Transactions whose fund the ledger names otherwise than the servicing system",
                  "The servicing system's name is used"),
    "dim_balance": ("MARTS", "DIM_FACILITY", "NET_FUNDS_EMPLOYED", "DATA CONFLICT",
                    "Facilities whose stated balance differs from the ledger",
                    "The ledger balance is used"),
    "fact_orphans": ("MARTS", "FACT_TRANSACTION", "FACILITY_ID", "REFERENTIAL-INTEGRITY",
                     "Transactions that cite an unknown facility",
                     "Kept on the guard member, outside every balance"),
    "fact_negative": ("MARTS", "FACT_TRANSACTION", "AMOUNT", "SOFT-OBSERVATION",
                      "Negative remittances", "Kept and marked as adjustments"),
    "fact_closed": ("MARTS", "FACT_TRANSACTION", None, "SOFT-OBSERVATION",
                    "Remittances on facilities that are closed", "Kept; someone should ask"),
}


def _as_rules(counts):
    """A one-row table of counts as (rule, affected_rows) rows."""
    return counts.unpivot([], counts.columns, "rule", "affected_rows")


def measure_rules(crm_raw, facility_raw, ledger_raw, marts, stated, aliases, later_raw):
    """How many rows each rule concerns. ``stated`` is the facility staging table, ``later_raw``
    the delivery after the one that the marts hold."""
    crm = parse_crm(crm_raw).agg(
        (F.count("match_key") - F.countDistinct("match_key")).alias("org_copies"),
        F.count("*").alias("org_key"),
        F.count("date_added").alias("org_date_text"),
        F.count_if(~is_blank(F.col("date_added")) & F.col("joined_on").isNull())
        .alias("org_date_bad"),
        F.count_if(F.col("match_key").isNull()).alias("org_unnamed"),
    )

    def dressed(column):
        return F.count_if(F.rlike(F.col(column), F.lit("[$,]")))

    def not_iso(column):
        return F.count_if(~F.rlike(F.col(column), F.lit(r"^\d{4}-\d\d-\d\d$")))

    records = parse_facilities(facility_raw).agg(
        F.count("*").alias("fac_key"),
        F.count_if(F.col("status_raw") != F.col("status")).alias("fac_status"),
        F.count_if(F.contains("discount_rate_raw", F.lit("%"))).alias("fac_rate"),
        dressed("stated_balance_raw").alias("fac_balance"),
        dressed("facility_limit_raw").alias("fac_limit"),
        not_iso("funding_date_raw").alias("fac_funded"),
        not_iso("maturity_date_raw").alias("fac_matures"),
    )
    copies = facility_conflicts(facility_raw).agg(
        F.count_if((F.col("copies") > 1) & ~F.col("conflict_ind")).alias("fac_copies"),
        F.count_if("status_conflict_ind").alias("fac_status_conflict"),
        F.count_if("facility_funding_limit_conflict_ind").alias("fac_limit_conflict"),
        F.count_if("net_funds_employed_conflict_ind").alias("fac_balance_conflict"),
    )
    parsed = parse_transactions(ledger_raw, aliases)
    rows = parsed.agg(
        F.count("*").alias("txn_key"),
        F.count("investment_ref").alias("txn_facility_key"),
        F.count("transaction_date_raw").alias("txn_date"),
        F.count_if(F.startswith(F.col("amount_raw"), F.lit("("))).alias("txn_amount"),
        F.count_if(F.col("fund") != F.col("fund_description")).alias("txn_alias"),
        F.count_if("parse_fail_ind").alias("txn_bad"),
    )
    agreed = readable_by_id(parsed)
    by_id = agreed.agg(
        F.count_if("fund_description_conflict_ind").alias("txn_fund_conflict"),
        F.count_if("amount_conflict_ind").alias("txn_amount_conflict"),
    )
    # names are few, so cited facilities are counted by name before they meet their facility
    named = agreed.groupBy("facility_id", "fund_description").agg(F.count("*").alias("n"))
    funds = current_members(marts.facility).select(
        "facility_id", F.col("fund_description").alias("servicing_fund"))
    renamed = named.join(funds, "facility_id").agg(F.coalesce(F.sum(F.when(
        F.col("fund_description") != F.col("servicing_fund"), F.col("n"))), F.lit(0))
        .alias("fact_fund"))
    # an id counts once however often it comes, so only distinct ids meet
    later = readable_by_id(parse_transactions(later_raw, aliases)).select(
        F.col("id_key").alias("transaction_id"))
    resent = later.join(marts.fact.select("transaction_id"), "transaction_id", "left_semi").agg(
        F.count("*").alias("txn_resent"))
    borrowers = current_borrowers(marts.organization).agg(
        F.count_if(F.col("source_system") == FROM_SERVICING).alias("org_servicing")
    )
    known = current_members(marts.facility)
    fac_orphans = orphan_facility_keys(marts).agg(
        F.coalesce(F.sum("facilities"), F.lit(0)).alias("fac_orphans")
    )
    balances = known.select("facility_id", "net_funds_employed").join(
        stated.select("facility_id", F.col("net_funds_employed").alias("stated")), "facility_id"
    ).agg(
        F.count_if(~F.col("stated").eqNullSafe(F.col("net_funds_employed"))).alias("dim_balance")
    )
    fact = marts.fact.agg(
        F.count_if(~F.col("known_facility_ind")).alias("fact_orphans"),
        F.count_if("adjustment_ind").alias("fact_negative"),
    )
    received = remittances(marts.fact).groupBy("facility_id").agg(F.count("*").alias("n"))
    closed = received.join(
        known.filter("status = 'CLOSED'").select("facility_id"), "facility_id"
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("fact_closed"))
    parts = [crm, records, copies, rows, by_id, renamed, resent, borrowers, fac_orphans, balances,
             fact, closed]
    measured = _as_rules(parts[0])
    for part in parts[1:]:
        measured = measured.unionByName(_as_rules(part))
    return measured


def quality_log(crm_raw, facility_raw, ledger_raw, marts, stated, aliases=None, later_raw=None):
    """The rule catalogue with the number of rows each rule concerns in this load, and of
    transactions that the next delivery, if any, sends again."""
    later_raw = ledger_raw.limit(0) if later_raw is None else later_raw
    spark = ledger_raw.sparkSession
    catalogue = spark.createDataFrame(
        [(rule, "TABLE", *entry) for rule, entry in RULES.items()],
        "rule string, object_type string, object_schema string, object_name string, "
        "field_name string, issue_type string, issue_description string, "
        "issue_resolution string",
    )
    measured = measure_rules(
        crm_raw, facility_raw, ledger_raw, marts, stated, aliases, later_raw)
    order = Window.orderBy(
        "object_schema", "object_name", F.coalesce("field_name", F.lit("~NULL~")),
        "issue_type", "rule",
    )  # numbers the catalogue, which has a fixed number of entries
    return catalogue.join(measured, "rule").withColumn(
        "log_id", F.row_number().over(order).cast("bigint")
    ).drop("rule")


def verdict(condition):
    return F.when(F.coalesce(condition, F.lit(False)), "PASS").otherwise("FAIL")


def orphan_facility_keys(marts):
    """Borrower keys of current facilities that find no current borrower."""
    keys = current_members(marts.facility).groupBy("organization_sk").agg(
        F.count("*").alias("facilities")
    )
    return keys.join(
        marts.organization.filter("is_current_ind").select("organization_sk"),
        "organization_sk", "left_anti",
    )


def integrity_checks(marts, staged_organizations, staged_facilities):
    """Referential integrity and fan-out in both layers, one row per check."""
    def unmatched(facilities, organizations):
        keys = facilities.groupBy("organization_sk").agg(F.count("*").alias("n"))
        return keys.join(organizations.select("organization_sk"), "organization_sk",
                         "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("found"))

    def repeated(rows, key):
        return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").agg(
            F.count("*").alias("found"))

    def may_repeat(rows, key):
        # of a stored table, only rows whose key may repeat are counted by the key itself
        return apart(rows.select(key), key).repeated

    known = marts.facility.filter("is_current_ind")
    borrowers = marts.organization.filter("is_current_ind")
    checks = {
        "orphan_facilities_marts": unmatched(known, borrowers),
        "orphan_facilities_staging": unmatched(
            staged_facilities,
            staged_organizations.select("organization_sk").unionByName(
                borrowers.filter("source_system = 'SYNTHETIC'").select("organization_sk"))),
        "duplicate_org_sk_marts": repeated(borrowers, "organization_sk"),
        "duplicate_org_sk_staging": repeated(staged_organizations, "organization_sk"),
        "duplicate_facility_sk_marts": repeated(
            may_repeat(known, "facility_sk"), "facility_sk"),
        "duplicate_transaction_id": repeated(
            may_repeat(marts.fact, "transaction_id"), "transaction_id"),
    }
    lines = None
    for name, found in checks.items():
        line = found.select(F.lit(name).alias("check_name"), "found",
                            verdict(F.col("found") == 0).alias("result"))
        lines = line if lines is None else lines.unionByName(line)
    return lines


def join_fan_out(marts):
    """The borrower join must not multiply facilities."""
    per_key = marts.facility.filter("is_current_ind").groupBy("organization_sk").agg(
        F.count("*").alias("n")
    )
    matches = marts.organization.filter("is_current_ind").groupBy("organization_sk").agg(
        F.count("*").alias("m")
    )
    return per_key.join(matches, "organization_sk", "left").agg(
        F.sum("n").alias("facility_rows"),
        F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum(F.when(F.col("m").isNotNull(), F.col("n"))), F.lit(0))
        .alias("matched_rows"),
    ).withColumn("result", verdict(F.col("joined_rows") == F.col("matched_rows")))


def provenance_counts(organizations):
    return organizations.groupBy("source_system").agg(
        F.count("*").alias("organizations")
    ).orderBy("source_system")


def collapsed_names(crm_raw, facility_raw):
    """Match keys that stand for several spellings, each spelling on a row of its own."""
    def names(df, column, system):
        return df.select(F.lit(system).alias("source_system"),
                         F.upper(F.trim(column)).alias("name"))

    spelled = (
        names(crm_raw, "org_name", FROM_CRM)
        .union(names(facility_raw, "client_name", FROM_SERVICING)).distinct()
        .withColumn("match_key", match_key(F.col("name")))
        .filter(F.col("match_key").isNotNull())
    )
    groups = spelled.groupBy("match_key").agg(
        F.countDistinct("name").alias("distinct_source_names"), F.count("*").alias("rows")
    )
    several = groups.filter("distinct_source_names > 1").drop("rows")
    listed = salted_lookup(
        spelled, several, ["match_key"], ["source_system", "name"],
        groups.select("match_key", "rows"), how="inner",
    )
    return listed.orderBy("match_key", "source_system", "name")


def layer_counts(ledger_raw, staged, fact, audit):
    """Rows per layer. Raw rows split exactly into staged copies and quarantined rows."""
    def line(layer, df, *extra):
        return df.agg(F.count("*").alias("n")).select(
            F.lit(layer).alias("layer"), "n", *extra
        )

    return (
        line("raw", ledger_raw)
        .unionByName(line("staged", staged))
        .unionByName(line("fact", fact))
        .unionByName(line("fact_distinct_ids", fact.select("transaction_id").distinct()))
        .unionByName(line("audit", audit))
    )


def row_conservation(parsed):
    """Nothing is lost: every raw row is a copy of a staged transaction or in quarantine."""
    return parsed.agg(
        F.count("*").alias("raw_rows"),
        F.count_if("parse_fail_ind").alias("quarantined"),
    ).crossJoin(
        readable_by_id(parsed)
        .agg(F.coalesce(F.sum("usable_copies"), F.lit(0)).alias("staged_copies"))
    ).withColumn("result", verdict(
        F.col("raw_rows") == F.col("quarantined") + F.col("staged_copies")))


def reconciliations(marts, year):
    """Headline against industry, labels, open book, orphans, month grid: five verdicts."""
    known = current_members(marts.facility)
    money = "decimal(38,3)"

    def check(name, left, right, condition):
        pair = left.crossJoin(F.broadcast(right)) if right is not None else left
        return pair.select(
            F.lit(name).alias("check_name"),
            F.col("left_value").cast(money).alias("left_value"),
            F.col("right_value").cast(money).alias("right_value"),
            verdict(condition).alias("result"),
        )

    equal = F.col("left_value") == F.col("right_value")
    headline = known.agg(F.sum("net_funds_employed").alias("left_value"))
    facility_count = known.agg(F.count("*").alias("left_value"))
    labelled = labelled_borrowers(marts)
    unlabelled = labelled.agg(
        F.coalesce(F.sum(F.when(
            F.col("industry").isNull() | (F.col("industry") == NO_ORGANIZATION),
            F.col("facilities"))), F.lit(0))
        .alias("left_value"),
        F.lit(0).alias("right_value"),
    )
    books = known.agg(
        F.sum(F.when(is_open(), F.col("net_funds_employed"))).alias("left_value"),
        F.sum("net_funds_employed").alias("right_value"),
    )
    orphans = marts.fact.filter(~F.col("known_facility_ind")).agg(
        F.count_if(F.col("facility_sk") != F.md5(F.lit(NO_FACILITY))).alias("left_value"),
        F.lit(0).alias("right_value"),
    )
    gridded = monthly_remittances(marts, year).agg(
        F.coalesce(F.sum("remittance_total"), F.lit(0)).alias("left_value")
    )
    ungridded = remittances(marts.fact).filter(in_year(year)).agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("right_value"))
    return (
        check("headline_vs_industry", headline,
              labelled.agg(F.sum("exposure").alias("right_value")), equal)
        .unionByName(check("facilities_vs_industry", facility_count,
                           labelled.agg(F.sum("facilities").alias("right_value")), equal))
        .unionByName(check("unlabelled_facilities", unlabelled, None, equal))
        .unionByName(check("open_book_within_portfolio", books, None,
                           F.col("left_value") <= F.col("right_value")))
        .unionByName(check("orphans_on_real_facilities", orphans, None, equal))
        .unionByName(check("grid_vs_ungridded", gridded, ungridded, equal))
    )


def privacy_check(marts):
    """The investor summary reconciles, and no cell stands for a single facility."""
    summary = investor_summary(marts)
    cells = F.col("metric_group").isin("FUND", "POSITION STATUS")
    total = F.col("metric_group") == "PORTFOLIO"
    lines = summary.agg(
        F.max(F.when(total, F.col("outstanding_balance"))).alias("summary_total"),
        F.min(F.when(cells, F.col("facility_count"))).alias("smallest_cell_facilities"),
    )
    mart = current_members(marts.facility).agg(
        F.sum("net_funds_employed").alias("mart_total")
    )
    return lines.crossJoin(F.broadcast(mart)).withColumn(
        "result", verdict((F.col("summary_total") == F.col("mart_total"))
                          & (F.col("smallest_cell_facilities") > 1))
    )


def open_share(marts):
    return current_members(marts.facility).agg(
        F.sum(F.when(is_open(), F.col("net_funds_employed"))).alias("open_book"),
        F.sum("net_funds_employed").alias("portfolio"),
    ).withColumn("open_pct_of_portfolio", percent(F.col("open_book"), F.col("portfolio")))


def serving_check(marts):
    def line(name, df):
        return df.agg(F.count("*").alias("row_count"),
                      F.count("organization_id").alias("mapped_to_borrower")).select(
            F.lit(name).alias("view_name"), "row_count", "mapped_to_borrower")

    return line("loan", api_loan(marts)).unionByName(line("borrower", api_borrower(marts)))


def balance_movement(before, after):
    """Facilities whose balance changed between a snapshot and now."""
    then = before.select("facility_sk", F.col("net_funds_employed").alias("nfe_before"))
    now = current_members(after).select(
        "facility_sk", "facility_id", "status", F.col("net_funds_employed").alias("nfe_after")
    )
    moved = then.join(now, "facility_sk").filter(
        ~F.col("nfe_before").eqNullSafe(F.col("nfe_after"))
    )
    return moved.select(
        "facility_id", "status", "nfe_before", "nfe_after",
        (F.col("nfe_after") - F.col("nfe_before")).alias("nfe_change"),
    ).orderBy("facility_id")


def closed_receipts(marts):
    """Remittances that arrived on closed facilities, per facility."""
    received = marts.fact.filter(F.col("transaction_type") == REMITTANCE).groupBy(
        "facility_id"
    ).agg(F.count("*").alias("remittances"), F.sum("amount").alias("remittance_total"))
    closed = current_members(marts.facility).filter("status = 'CLOSED'").select("facility_id")
    return received.join(closed, "facility_id").orderBy("facility_id")
