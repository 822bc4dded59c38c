"""Dates written by people. An unreadable text gives NULL, never an error."""

from pyspark.sql import functions as F


def any_date(text):
    """ISO, ``Feb 10, 2024`` or ``02/10/2024``, told apart by their separators."""
    return (
        F.when(F.contains(text, F.lit("-")), F.try_to_date(text, "yyyy-MM-dd"))
        .when(F.rlike(text, F.lit("[A-Za-z]")), F.try_to_date(text, "MMM d, yyyy"))
        .when(F.contains(text, F.lit("/")), F.try_to_date(text, "M/d/yyyy"))
    )


def ledger_date(text):
    """``10-Feb-26`` as the ledger writes it, or ISO as requests write it."""
    return F.when(
        F.substring(text, 5, 1) == "-", F.try_to_date(text, "yyyy-MM-dd")
    ).otherwise(F.try_to_date(text, "d-MMM-yy"))


def short_us_date(text):
    """``12/06/24`` as the CRM writes it."""
    return F.try_to_date(text, "M/d/yy")
