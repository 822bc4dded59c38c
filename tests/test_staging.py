from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallystone.plans.facilities import facilities, facility_audit
from tallystone.plans.organizations import organization_audit, organizations
from tallystone.plans.quality import row_conservation
from tallystone.plans.transactions import (
    absent_only, audit_transactions, flag_transactions, parse_transactions, resolve_transactions,
)

from helpers import FIRST, SECOND, crm, fac, led, rows_of


def test_one_borrower_under_two_ids(spark):
    raw = crm(spark, dict(org_ref="C9", org_name="ALDER SUPPLY"), dict(org_ref="C2"),
              dict(org_ref="C5", org_name="Birch Ltd", industry=None))
    clients = fac(spark, {}, dict(facility_id="F2", client_name="Cedar Finance LLC"))
    got = rows_of(organizations(raw, clients), "organization_name", "source_system", "industry")
    assert got == [("ALDER SUPPLY", "CRM", "Timber"), ("BIRCH LTD", "CRM", None),
                   ("CEDAR FINANCE LLC", "SERVICING", None)]
    kept = organizations(raw, clients).filter("organization_name = 'ALDER SUPPLY'").first()
    assert kept.organization_id == "C2"
    audit = rows_of(organization_audit(raw), "org_ref", "record_number", "winner_ind")
    assert audit == [("C2", 2, True), ("C9", 1, False)]


def test_defective_crm_records_are_audited(spark):
    raw = crm(spark, dict(org_name=None), dict(org_ref="C2", date_added="99/99/99"))
    got = rows_of(organization_audit(raw), "org_ref", "parse_fail_fields", "duplicate_ind")
    assert got == [("C1", "ORG_NAME", False), ("C2", "DATE_ADDED", False)]
    assert rows_of(organizations(raw, fac(spark, {})), "organization_id", "date_added") == [
        ("C2", None)]


def test_facility_copies(spark):
    raw = fac(
        spark, {}, dict(client_name=" ALDER SUPPLY, INC. ", facility_limit="1000",
                        discount_rate="0.105", funding_date="02/10/2024"),
        dict(facility_id="F2"), dict(facility_id="F2", status="Closed"),
        dict(facility_id="F3"), dict(facility_id="F3", facility_limit="7"),
        dict(facility_id="F3", facility_limit="8", status=None), dict(facility_id=None),
        dict(facility_id="F4", facility_limit="lots"),
    )
    got = rows_of(facilities(raw), "facility_id", "status", "facility_funding_limit")
    one = Decimal("1000.000")
    assert got == [("F1", "ACTIVE", one), ("F2", None, one), ("F3", None, None),
                   ("F4", "ACTIVE", None)]
    audit = rows_of(facility_audit(raw), "facility_id", "record_number", "parse_fail_fields")
    assert audit == [("F1", 1, ""), ("F1", 2, ""), ("F2", 1, ""), ("F2", 2, ""), ("F3", 1, ""),
                     ("F3", 2, ""), ("F3", 3, ""), ("F4", 1, "FACILITY_LIMIT"),
                     (None, 1, "FACILITY_ID")]


BATCH = [
    {}, dict(transaction_id="T2"), dict(transaction_id="T2", amount="999"),
    dict(transaction_id="T3"), dict(transaction_id="T3", amount="nil"),
    dict(transaction_id="T4", transaction_date="32-Foo-99", amount="x"),
    dict(transaction_id=None), dict(transaction_id="T5", transaction_date=None),
    dict(transaction_id="T6"), dict(transaction_id="T6"),
]


def test_resolution_and_quarantine(spark):
    parsed = parse_transactions(led(spark, *BATCH), {"Short": "Long Fund Name"})
    got = rows_of(resolve_transactions(parsed), "transaction_id", "amount")
    hundred = Decimal("100.000")
    assert got == [("T1", hundred), ("T2", None), ("T3", hundred), ("T5", hundred),
                   ("T6", hundred)]
    assert resolve_transactions(parsed).first().fund_description == "Long Fund Name"
    audit = rows_of(audit_transactions(parsed, FIRST), "transaction_id", "duplicate_ind",
                    "conflict_ind", "parse_fail_fields")
    assert audit == [
        ("T2", True, True, ""), ("T2", True, True, ""), ("T3", True, False, ""),
        ("T3", True, False, "AMOUNT"), ("T4", False, False, "TRANSACTION_DATE, AMOUNT"),
        ("T6", True, False, ""), ("T6", True, False, ""),
        (None, False, False, "TRANSACTION_ID")]
    numbers = rows_of(flag_transactions(parsed), "transaction_id", "record_number")
    assert numbers.count(("T2", 2)) == 1 and len(numbers) == len(BATCH)
    assert row_conservation(parsed).first().result == "PASS"


def test_newest_delivery_wins(spark):
    early, late = datetime.fromisoformat(FIRST), datetime.fromisoformat(SECOND)
    raw = led(spark, dict(at=early), dict(at=late, amount="7"),
              dict(transaction_id="T2", at=early), dict(transaction_id="T2", at=late, amount="nil"),
              dict(transaction_id="T3", at=late), dict(transaction_id="T3", at=late, amount="8"))
    got = resolve_transactions(parse_transactions(raw), "file_last_modified")
    assert rows_of(got, "transaction_id", "amount") == [
        ("T1", Decimal("7.000")), ("T2", Decimal("100.000")), ("T3", None)]


def test_audit_is_appended_once(spark):
    audit = audit_transactions(parse_transactions(led(spark, *BATCH)), FIRST)
    assert absent_only(audit, audit).count() == 0
    assert absent_only(audit, audit.filter(F.lit(False))).count() == audit.count()
