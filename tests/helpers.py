"""Small raw tables for the tests."""

from tallystone.model import CRM_RAW, FACILITY_RAW, LEDGER_RAW

FIRST = "2026-01-01 00:00:00"
SECOND = "2026-02-01 00:00:00"
THIRD = "2026-03-01 00:00:00"


def _table(spark, schema, rows, defaults, file_name, delivered):
    from datetime import datetime

    names = [f for f in schema.fieldNames()
             if f not in ("file_name", "file_row_number", "file_last_modified")]
    at = datetime.fromisoformat(delivered)
    return spark.createDataFrame(
        [tuple({**defaults, **row}[n] for n in names)
         + (row.get("file_name", file_name), number, row.get("at", at))
         for number, row in enumerate(rows, 1)],
        schema,
    )


def crm(spark, *rows, delivered=FIRST):
    defaults = dict(org_ref="C1", org_name="Alder Supply", industry="Timber", state="OR",
                    relationship_owner="Kim", date_added="03/04/24")
    return _table(spark, CRM_RAW, rows, defaults, "crm.csv", delivered)


def fac(spark, *rows, delivered=FIRST):
    defaults = dict(facility_id="F1", client_name="Alder Supply", fund="Long Fund Name",
                    product_type="Line", status="Active", facility_limit="$1,000.00",
                    stated_balance="500.00", discount_rate="10.5%", funding_date="2024-02-10",
                    maturity_date="Feb 10, 2027")
    return _table(spark, FACILITY_RAW, rows, defaults, "fac.csv", delivered)


def led(spark, *rows, delivered=FIRST, file_name="led.csv"):
    defaults = dict(transaction_id="T1", transaction_date="10-Feb-26", fund="Short",
                    share_class="Class A", investment_ref="F1", transaction_type="Remittance",
                    amount="100.00")
    return _table(spark, LEDGER_RAW, rows, defaults, file_name, delivered)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
