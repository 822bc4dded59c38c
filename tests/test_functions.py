from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.functions import (
    accounting_amount, any_date, currency, ledger_date, match_key, rate, short_us_date,
    status_code,
)
from tallystone.functions.keys import packed, unpacked


def results(spark, function, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


CASES = [
    (match_key, {
        "Alder Supply, Inc.": "ALDER SUPPLY", " alder  supply LLC ": "ALDER SUPPLY",
        "Alder Co": "ALDER", "Inc": "INC", "CO": "CO", "Alder Inc Co": "ALDER INC",
        "!!": None, "": None, None: None, "Alder Company": "ALDER", "Costco": "COSTCO",
    }),
    (status_code, {
        "Watch List": "WATCH-LIST", "Watchlist": "WATCH-LIST", "WATCH-LIST": "WATCH-LIST",
        "Paid Off": "PAID-OFF", "active": "ACTIVE", None: None,
    }),
    (rate, {
        "10.5%": Decimal("0.1050"), "0.105": Decimal("0.1050"), "x": None, None: None,
        "10.55%": Decimal("0.1055"), "99999%": None,
    }),
    (currency, {
        "$1,017,125.00": Decimal("1017125.000"), "1,017,125": Decimal("1017125.000"),
        "-5.5": Decimal("-5.500"), "n/a": None, None: None,
    }),
    (accounting_amount, {
        "69,312.65": Decimal("69312.650"), "(1,234.50)": Decimal("-1234.500"),
        "not-a-number": None, None: None, "0": Decimal("0.000"),
    }),
    (any_date, {
        "2024-02-10": date(2024, 2, 10), "02/10/2024": date(2024, 2, 10),
        "Feb 10, 2024": date(2024, 2, 10), "May 9, 2026": date(2026, 5, 9),
        "2024-13-45": None, "soon": None, None: None,
    }),
    (ledger_date, {
        "10-Feb-26": date(2026, 2, 10), "9-Oct-23": date(2023, 10, 9),
        "10-FEB-26": date(2026, 2, 10), "2026-02-10": date(2026, 2, 10), "32-Foo-99": None,
        None: None,
    }),
    (short_us_date, {"12/06/24": date(2024, 12, 6), "13/45/20": None, None: None}),
]


@pytest.mark.parametrize("function,expected", CASES, ids=[f.__name__ for f, _ in CASES])
def test_column_function(spark, function, expected):
    assert results(spark, function, list(expected)) == list(expected.values())


def test_digests_travel_as_sixteen_bytes_and_any_text_comes_back(spark):
    digest = "0123456789abcdef0123456789abcdef"
    texts = [digest, digest.upper(), digest[1:], "", "x" * 16, "z" * 32, "\u00e4" * 16, None, "\0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", packed(F.col("t")).alias("p"))
    got = df.select("t", unpacked(F.col("p")), F.length("p")).collect()
    assert [r[1] for r in got] == [r[0] for r in got]
    assert [r[0] for r in got if r[2] == 16] == [digest]
    assert df.select("p").distinct().count() == len(texts)
