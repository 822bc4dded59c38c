"""Column functions. Each takes and returns Columns, so all work stays in the JVM."""

from .dates import any_date, ledger_date, short_us_date
from .keys import row_hash, surrogate_key
from .money import accounting_amount, currency, rate
from .text import is_blank, match_key, same_text, status_code

__all__ = [
    "accounting_amount", "any_date", "currency", "is_blank", "ledger_date", "match_key",
    "rate", "row_hash", "same_text", "short_us_date", "status_code", "surrogate_key",
]
