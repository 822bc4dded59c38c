import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.model import DIM_FACILITY, FACT, empty
from tallystone.operators.scd2 import scd2_merge
from tallystone.operators.upsert import upsert_outcomes
from tallystone.plans import intake, portfolio, quality, serving
from tallystone.plans.facilities import agreed_facilities, facilities
from tallystone.plans.marts import (
    BuiltMarts, Exports, current_members, fact_source, first_corrected, first_facilities,
    first_fact, load_facilities, load_fact, resolve_orphans,
)
from tallystone.plans.organizations import organizations
from tallystone.plans.transactions import parse_transactions, resolve_transactions

from helpers import FIRST, SECOND, THIRD, crm, fac, led, rows_of


def source(spark, dim, *rows, delivered=FIRST):
    raw = led(spark, *rows, delivered=delivered)
    return fact_source(resolve_transactions(parse_transactions(raw)), dim, raw)


def test_scd2_versions(spark):
    one = facilities(fac(spark, {}, dict(facility_id="F2")))
    two = facilities(fac(spark, dict(status="Closed"), dict(facility_id="F3")))
    first = scd2_merge(empty(spark, DIM_FACILITY), one, "facility_sk", FIRST)
    again = scd2_merge(first, one, "facility_sk", SECOND)
    assert rows_of(again) == rows_of(first)
    after = scd2_merge(first, two, "facility_sk", SECOND)
    got = rows_of(after, "facility_id", "record_version_number", "is_current_ind", "status")
    assert got == [("F1", 1, False, "ACTIVE"), ("F1", 2, True, "CLOSED"), ("F2", 1, True, "ACTIVE"),
                   ("F3", 1, True, "ACTIVE")]
    closed = after.filter("not is_current_ind").first()
    assert str(closed.record_valid_to_ts) == "2026-01-31 23:59:59.999000"
    assert after.select("scd_id").distinct().count() == 4


def test_guard_is_added_once(spark):
    dim = load_facilities(None, facilities(fac(spark, {})), FIRST)
    dim = load_facilities(dim, facilities(fac(spark, {})), SECOND)
    assert dim.filter("facility_id = 'NULL FACILITY'").count() == 1
    assert current_members(dim).count() == 1
    assert dim.schema.simpleString() == DIM_FACILITY.simpleString()


def test_upsert_inserts_corrects_and_bounces(spark):
    dim = load_facilities(None, facilities(fac(spark, {})), FIRST)
    fact = first_fact(source(spark, dim, {}, dict(transaction_id="T2"),
                             dict(transaction_id="T3")), FIRST)
    delta = source(spark, dim, {}, dict(transaction_id="T2", amount="(5.00)"),
                   dict(transaction_id="T4", investment_ref="FX"))
    got = rows_of(upsert_outcomes(fact, delta, "transaction_id", SECOND),
                  "transaction_id", "outcome")
    assert got == [("T1", "UNCHANGED"), ("T2", "UPDATE"), ("T3", "UNTOUCHED"), ("T4", "INSERT")]
    after = load_fact(fact, delta, SECOND)
    assert after.schema.simpleString() == FACT.simpleString()
    stamps = {r.transaction_id: (str(r.record_inserted_ts), r.record_updated_ts is not None,
                                 r.adjustment_ind, r.known_facility_ind)
              for r in after.collect()}
    assert stamps["T2"] == (FIRST, True, True, True)
    assert stamps["T4"] == (SECOND, False, False, False)
    assert rows_of(load_fact(after, delta, THIRD)) == rows_of(after)


def test_orphans_resolve_when_their_facility_appears(spark):
    early = load_facilities(None, facilities(fac(spark, {})), FIRST)
    fact = first_fact(source(spark, early, {}, dict(transaction_id="T2", investment_ref="F2"),
                             dict(transaction_id="T3", investment_ref="FX")), FIRST)
    later = load_facilities(early, facilities(fac(spark, {}, dict(facility_id="F2"))), SECOND)
    found = resolve_orphans(fact, later)
    assert rows_of(found, "transaction_id", "known_facility_ind", "fund_description") == [
        ("T2", True, "Long Fund Name")]


def book(spark):
    return BuiltMarts(Exports(
        crm(spark, {}, dict(org_ref="C2", org_name="Birch", industry=None),
            dict(org_ref="C3", org_name="Quiet Co")),
        fac(spark, {}, dict(facility_id="F2", client_name="Birch"),
            dict(facility_id="F3", client_name="Cedar", status="Closed"),
            dict(facility_id="F4", client_name=None, stated_balance=None),
            dict(facility_id="F5", status="Odd"), dict(facility_id="F5", status="Closed")),
        led(spark, dict(amount="(300)", transaction_type="Funding"),
            dict(transaction_id="T2", amount="100"),
            dict(transaction_id="T3", amount="(50)", investment_ref="F3", transaction_type="Fee"),
            dict(transaction_id="T4", amount="70", investment_ref="FX"),
            dict(transaction_id="T5", amount="(20)", investment_ref="F4", transaction_type="Fee"),
            dict(transaction_id="T6", transaction_date="01-Mar-25", investment_ref="F2")),
    ), FIRST, {"Short": "Long Fund Name"})


def test_reports(spark):
    marts = book(spark)
    total = portfolio.total_outstanding(marts).first()
    # F1 200, F2 -100, F3 50, F4 20, F5 states 500 and has no ledger
    assert (total.total_facilities, total.total_outstanding) == (5, Decimal("670.000"))
    assert rows_of(portfolio.exposure_by_industry(marts), "industry", "facilities", "borrowers") == [
        ("INDUSTRY NOT SET", 1, 1), ("NOT IN CRM", 1, 1), ("Timber", 2, 1),
        ("Unmapped borrower", 1, 0)]
    assert rows_of(portfolio.unmapped_borrowers(marts), "organization_name", "facilities") == [
        ("BIRCH", 1), ("CEDAR", 1), (None, 1)]
    months = portfolio.monthly_remittances(marts, 2026).collect()
    assert len(months) == 12 and sum(m.remittance_total for m in months) == Decimal("170.000")
    assert [r.result for r in quality.reconciliations(marts, 2026).collect()] == ["PASS"] * 6
    top = portfolio.top_borrowers(marts).first()
    assert (top.organization_id, top.exposure) == ("C1", Decimal("200.000"))
    assert rows_of(portfolio.blank_balances(marts.exports.fac, marts), "facility_id",
                   "current_balance") == [("F4", Decimal("20.000"))]
    assert portfolio.orphan_totals(marts).first().orphan_amount == Decimal("70.000")
    lines = portfolio.investor_summary(marts).collect()
    assert lines[0].borrower_count == 3 and lines[0].facility_count == 5
    assert [r.metric_group for r in lines] == [
        "PORTFOLIO", "FUND", "POSITION STATUS", "POSITION STATUS", "CONCENTRATION"]


def test_serving(spark):
    marts = book(spark)
    assert serving.loan_page(marts, "UNKNOWN").count() == 1
    page = serving.loan_page(marts, limit=2, offset=1).collect()
    assert [(r.facility_id, r.total) for r in page] == [("F2", 5), ("F3", 5)]
    assert serving.loan_page(marts, "active").count() == serving.loan_page(marts, "ACTIVE").count()
    after = serving.loan_page(marts, limit=2, after="F2").collect()
    assert [(r.facility_id, r.total) for r in after] == [("F3", 5), ("F4", 5)]
    assert page[1].organization_name == "CEDAR" and after[1].organization_name is None
    for wrong in (dict(status="Lost"), dict(limit=0), dict(offset=-1), dict(offset=10 ** 9)):
        with pytest.raises(ValueError):
            serving.loan_page(marts, **wrong)
    assert serving.borrower_loans(marts, "nobody").count() == 0
    assert rows_of(serving.borrower_loans(marts, "c3"), "facility_id") == [(None,)]
    assert serving.api_loan(marts).filter("facility_id = 'F4'").first().organization_id is None
    summary = serving.portfolio_summary(marts).collect()
    buckets = [r for r in summary if r.section == "STATUS"]
    assert sum(r.loans for r in buckets) == 5


def test_intake(spark):
    asked = spark.createDataFrame([
        ("1", "f1", "100.5", "2026-01-01", "class a"), ("2", "F1", "0", "2026-01-01", None),
        ("3", "F1", "-1", "2026-01-01", None), ("4", "F1", "1", "2026-01-16", None),
        ("5", "FX", "1", "2026-01-01", None), ("6", "F1", "abc", "2026-01-01", None),
        ("7", "F1", "1", "2026-01-01", "Class Z"),
    ], "request_id string, facility_id string, amount string, transaction_date string, "
       "share_class string")
    loans = serving.api_loan(book(spark))
    got = rows_of(intake.request_outcomes(asked, loans, "2026-01-15"), "request_id",
                  "rejection_code")
    assert got == [("1", None), ("2", "AMOUNT_NOT_POSITIVE"), ("3", "AMOUNT_NOT_POSITIVE"),
                   ("4", "TRANSACTION_DATE_IN_FUTURE"), ("5", "FACILITY_NOT_FOUND"),
                   ("6", "VALIDATION_ERROR"), ("7", "VALIDATION_ERROR")]
    rows = intake.accepted_rows(asked, loans, "2026-01-15", FIRST)
    parsed = parse_transactions(rows).first()
    assert (parsed.facility_id, parsed.amount, parsed.share_class, parsed.parse_fail_ind) == (
        "F1", Decimal("100.500"), "Class A", False)


class Damaged:
    """Marts with some of their tables replaced."""

    def __init__(self, marts, **tables):
        self.organization = tables.get("organization", marts.organization)
        self.facility = tables.get("facility", marts.facility)
        self.fact = tables.get("fact", marts.fact)


def test_digests_of_facilities_stay_out_of_the_join_with_balances(spark):
    marts = book(spark)
    agreed = agreed_facilities(marts.exports.fac)
    assert rows_of(first_facilities(agreed, FIRST)) == rows_of(marts.stated)
    found = first_corrected(agreed, marts.fact, FIRST)
    assert found.columns == DIM_FACILITY.fieldNames()
    assert rows_of(found) == rows_of(marts.facility)
    joined = found._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    joined = joined.split("NULL FACILITY AS facility_id")[0]  # the guard comes after
    assert "organization_sk" in joined
    assert "change_tracking_key" not in joined and "scd_id" not in joined


def test_heavy_facilities_are_found_without_shuffling_every_id(spark):
    marts = book(spark)
    found = fact_source(marts.staged, marts.stated, marts.exports.led)
    assert "_bucket" in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(found) == rows_of(fact_source(marts.staged, marts.stated))


def test_only_ids_that_may_repeat_are_counted_by_id(spark):
    marts = book(spark)
    staged = organizations(marts.exports.crm, marts.exports.fac), facilities(marts.exports.fac)
    found = quality.integrity_checks(marts, *staged)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    for key in ("transaction_id", "facility_sk"):
        assert re.search(rf"Relation \[{key}#\d+\] parquet", plan)
    assert failing(found) == set()


def failing(df):
    return {r[0] for r in df.collect() if r.result == "FAIL"}


def test_checks_fail_on_damaged_marts(spark):
    marts = book(spark)
    exports = marts.exports
    staged = organizations(exports.crm, exports.fac), facilities(exports.fac)

    def integrity(**tables):
        return failing(quality.integrity_checks(Damaged(marts, **tables), *staged))

    people, loans, fact = marts.organization, marts.facility, marts.fact
    assert integrity() == set()
    assert integrity(organization=people.filter("organization_name <> 'CEDAR'")) == {
        "orphan_facilities_marts"}
    assert integrity(organization=people.union(people.limit(1))) == {"duplicate_org_sk_marts"}
    assert integrity(facility=loans.union(loans.filter("facility_id = 'F1'"))) == {
        "duplicate_facility_sk_marts"}
    assert integrity(fact=fact.union(fact.limit(1))) == {"duplicate_transaction_id"}
    twice = Damaged(marts, organization=people.union(people.filter("organization_name = 'BIRCH'")))
    assert quality.join_fan_out(twice).first().result == "FAIL"
    assert quality.join_fan_out(marts).first().result == "PASS"

    def reconciled(**tables):
        return failing(quality.reconciliations(Damaged(marts, **tables), 2026))

    assert "orphans_on_real_facilities" in reconciled(
        fact=fact.withColumn("known_facility_ind", F.lit(False)))
    assert "headline_vs_industry" in reconciled(
        organization=people.union(people.filter("organization_id = 'C1'")))
    assert "open_book_within_portfolio" in reconciled(facility=loans.withColumn(
        "net_funds_employed", F.when(F.col("status") == "CLOSED", F.lit(-900)).otherwise(
            F.col("net_funds_employed")).cast("decimal(35,3)")))
    assert quality.privacy_check(marts).first().result == "PASS"
    alone = Damaged(marts, facility=loans.withColumn("status", F.when(
        F.col("facility_id") == "F1", "ACTIVE").otherwise("CLOSED")))
    assert quality.privacy_check(alone).first().result == "FAIL"  # a cell of one facility


def test_money_without_a_fund_has_its_line(spark):
    marts = book(spark)
    lost = Damaged(marts, fact=marts.fact.withColumn("fund_description", F.lit(None).cast("string")))
    months = portfolio.monthly_remittances(lost, 2026).filter("fund_description is null")
    assert months.agg(F.sum("remittance_total")).first()[0] == Decimal("170.000")
    assert failing(quality.reconciliations(lost, 2026)) == set()
