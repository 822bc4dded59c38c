"""Copies of one entity: collapse them, and NULL every field they disagree on.

Most entities have one copy. ``apart`` first counts hashes of the keys, which combine before a
shuffle of sixteen bytes a key, and then takes only rows whose key may be repeated on; all
others stay where they are. What is exact happens on the rows taken on, so a hash that two keys
share costs a little time and changes nothing. Nor does a bit that two hashes share: hashes too many
to broadcast are marked in a bitmap of fixed size, so rows are never shuffled to be told apart.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

#: Hashes of repeated keys that are broadcast; eight bytes each.
HELD = 1_000_000
#: Words of the bitmap of more hashes than that, and bits of a word.
WORDS, WORD = 2_097_152, 64


class Apart(NamedTuple):
    """Rows whose key no other row has, and a written table of all rows whose key may repeat."""

    single: DataFrame
    repeated: DataFrame


def _bit(hashed, words):
    """Where a hash is marked in a bitmap: the word, and the bit in it."""
    place = F.pmod(hashed, F.lit(words * WORD))
    return F.floor(place / WORD), F.pmod(place, F.lit(WORD)).cast("int")


def written(df, label):
    """A table as read back from a folder of its own."""
    place = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def divider(hashes, held=HELD, words=WORDS):
    """A function that divides rows by whether a hash of theirs is among ``hashes``, a written
    table of one column ``_hash``: rows for which it is not, and rows for which it is or shares a
    bit with one. The hashes are broadcast, as they are or as bits, so rows are not shuffled."""
    if hashes.count() <= held:
        met = F.broadcast(hashes)
        return lambda rows, hashed: tuple(
            rows.join(met, hashed == F.col("_hash"), how) for how in ("left_anti", "left_semi"))
    word, bit = _bit(F.col("_hash"), words)
    bits = written(hashes.groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits")),
        "repeated-bits")

    def divided(rows, hashed):
        word, bit = _bit(hashed, words)
        marked = rows.join(F.broadcast(bits), word == F.col("_word"), "left")
        found = F.coalesce(F.bit_get("_bits", bit) == 1, F.lit(False))
        return tuple(marked.filter(side).select(*rows.columns) for side in (~found, found))

    return divided


def apart(rows, key, held=HELD, words=WORDS):
    """``key`` is a column or several; NULL is a value."""
    hashed = F.xxhash64(*([key] if isinstance(key, str) else key))
    met = written(rows.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("_hash"), "repeated-keys")
    single, repeated = divider(met, held, words)(rows, hashed)
    return Apart(single, written(repeated, "repeated-rows"))


def collapse_copies(rows, keys, fields, usable=None):
    """One row per key with each field's agreed value and a ``<field>_conflict_ind``.

    NULL counts as a value: a copy without it disagrees with one that has it. Copies for
    which the SQL condition ``usable`` is false are counted in ``copies`` but have no say in the fields, and
    a key with no usable copy comes out with ``usable_copies`` = 0. This is a plain
    aggregate, so copies meet in partial results before the shuffle however many there are.
    """
    def measures(field):
        value = field if usable is None else f"case when {usable} then {field} end"
        return [f"min({value}) as _low_{field}", f"max({value}) as _high_{field}",
                f"count({value}) as _set_{field}"]

    def differs(field):
        return (f"(_set_{field} between 1 and usable_copies - 1"
                f" or coalesce(_low_{field} <> _high_{field}, false))")

    voters = "count(*)" if usable is None else f"count_if({usable})"
    wanted = ["count(*) as copies", f"{voters} as usable_copies"]
    wanted += [m for field in fields for m in measures(field)]
    gathered = rows.groupBy(*keys).agg(*[F.expr(m) for m in wanted])
    return gathered.selectExpr(
        *keys, "copies", "usable_copies",
        *[f"case when not {differs(f)} then _high_{f} end as {f}" for f in fields],
        *[f"{differs(f)} as {f}_conflict_ind" for f in fields],
        f"{' or '.join(differs(f) for f in fields)} as conflict_ind",
    )


def collapse_apart(split, keys, fields, usable=None):
    """``collapse_copies`` of rows taken apart: a single row agrees with itself."""
    voice = "true" if usable is None else usable
    alone = split.single.selectExpr(
        *keys, "1L as copies", f"case when {voice} then 1L else 0L end as usable_copies",
        *[f"case when {voice} then {f} end as {f}" for f in fields],
        *[f"false as {f}_conflict_ind" for f in fields], "false as conflict_ind",
    )
    return alone.unionByName(collapse_copies(split.repeated, keys, fields, usable))


def newest_only(collapsed, key, delivery):
    """Across deliveries the newest one wins; conflicts exist only within one delivery.

    Input has one row per key and delivery, so a key holds a handful of rows at most.
    """
    others = [c for c in collapsed.columns if c not in (key, delivery, "copies")]
    return collapsed.groupBy(key).agg(
        F.sum("copies").alias("copies"),
        F.max_by(F.struct(delivery, *others), F.struct(F.col(delivery).isNotNull(), delivery))
        .alias("_newest"),
    ).select(key, "copies", "_newest.*")


def keep_first(rows, key, order):
    """The first row per key by ``order``, as an aggregate over structs.

    Only one candidate per key and task is shuffled, so a key with very many copies costs
    no more than one with two.
    """
    others = [c for c in rows.columns if c != key]
    return (
        rows.groupBy(key)
        .agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
        .select(key, "_first.*")
    )
