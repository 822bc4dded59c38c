"""Surrogate keys and change-tracking hashes."""

from pyspark.sql import functions as F

from ..model import NULL_MARK


def surrogate_key(column):
    return F.md5(F.coalesce(column.cast("string"), F.lit(NULL_MARK)))


#: Before a text that is no digest; a digest alone is sixteen bytes.
_NO_DIGEST = bytes(17)
#: For a digest that the row's other columns give.
LEFT_OUT = b""


def packed(column, own=None):
    """A text as bytes, one to one, and a lower-case md5 as its sixteen bytes: digests do not
    compress, so that halves what they cost in a shuffle. ``own``, if given, is the digest that
    the row's other columns give; a text equal to it is left out, as no bytes at all."""
    digest = F.unhex(column)
    is_digest = (F.length(column) == 32) & (F.lower(F.hex(digest)) == column)
    coded = F.when(is_digest, digest).when(
        column.isNotNull(), F.concat(F.lit(_NO_DIGEST), column.cast("binary")))
    return coded if own is None else F.when(column == own, F.lit(LEFT_OUT)).otherwise(coded)


def unpacked(column, own=None):
    """The text that ``packed`` made the bytes of."""
    text = F.when(F.length(column) == 16, F.lower(F.hex(column))).otherwise(
        F.substring(column, len(_NO_DIGEST) + 1, 2**31 - 1).cast("string"))
    return text if own is None else F.when(F.length(column) == 0, own).otherwise(text)


def row_hash(columns):
    """One md5 over named columns, in order; NULL is a value like any other."""
    shown = ", ".join(f"coalesce(cast({c} as string), '{NULL_MARK}')" for c in columns)
    return F.expr(f"md5(concat_ws('||', {shown}))")


def failed_fields(checks):
    """Names of the checks that hold, as ``A, B``; empty text when none does."""
    return F.concat_ws(", ", *[F.when(failed, name) for name, failed in checks.items()])
