"""Numbers written by people. An unreadable text gives NULL, never an error."""

from pyspark.sql import functions as F


def currency(text):
    """``$1,017,125.00`` and ``1017125`` as decimal(35,3)."""
    return F.translate(text, "$,", "").try_cast("decimal(35,3)")


def accounting_amount(text):
    """As written in a ledger: thousands separators, parentheses for negative."""
    size = F.translate(text, ",()", "").try_cast("decimal(35,3)")
    negative = F.startswith(text, F.lit("(")) & F.endswith(text, F.lit(")"))
    return F.when(negative, -size).otherwise(size).cast("decimal(35,3)")


def rate(text):
    """``10.5%`` and ``0.105`` are both 0.1050, as decimal(5,4)."""
    percent = F.replace(text, F.lit("%"), F.lit("")).try_cast("decimal(9,4)")
    share = F.when(F.contains(text, F.lit("%")), percent * F.lit("0.01").cast("decimal(3,2)"))
    return share.otherwise(text.try_cast("decimal(9,4)")).try_cast("decimal(5,4)")
