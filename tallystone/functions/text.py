"""Names and status texts."""

from pyspark.sql import functions as F

# The legal suffixes that do not distinguish borrowers.
LEGAL_SUFFIXES = ["LLC", "INC", "CO", "LP", "LTD", "CORP", "COMPANY"]


def match_key(name):
    """The form of a borrower name that all systems agree on; NULL when nothing is left.

    Blanks are squeezed before the suffix is looked for, so ``"Foo LLC "`` equals ``"foo"``.
    """
    letters = F.regexp_replace(F.upper(name), "[^A-Z0-9 ]", "")
    squeezed = F.trim(F.regexp_replace(letters, " +", " "))
    bare = F.regexp_replace(squeezed, f" ({'|'.join(LEGAL_SUFFIXES)})$", "")
    # nullif would work the key out twice
    return F.get(F.filter(F.array(F.trim(bare)), lambda key: key != ""), 0)


def status_code(status):
    """``Watch List``, ``Watchlist`` and ``WATCH-LIST`` are one status; likewise the others."""
    code = F.replace(F.upper(F.trim(status)), F.lit(" "), F.lit("-"))
    return F.when(code == "WATCHLIST", "WATCH-LIST").otherwise(code)


def is_blank(text):
    return F.coalesce(F.trim(text), F.lit("")) == ""


def same_text(left, right):
    """Equality that ignores letter case."""
    return F.upper(left) == F.upper(right)
