"""Joins that survive a key holding a large part of all rows."""

from pyspark.sql import functions as F

#: A key with more rows than one task should take, and the rows of one piece of it.
HEAVY, PIECE = 1_000_000, 250_000
#: Into how many buckets of keys rows are counted first.
BUCKETS = 16_384


def heavy_keys(sizes, keys, rows="rows", heavy=HEAVY, piece=PIECE):
    """Keys with more than ``heavy`` rows, and into how many pieces each is cut.

    ``sizes`` has one row per key with its row count. There is at most one such key per
    ``heavy`` rows of the data, so the result is some millionth of it and may be broadcast.
    """
    cut = F.ceil(F.col(rows) / piece).cast("int").alias("_pieces")
    return sizes.filter(F.col(rows) > heavy).select(*keys, cut)


def sizes_of_heavy(rows, keys, heavy=HEAVY, buckets=BUCKETS):
    """Keys and their row counts in ``rows``, as ``salted_lookup`` takes them, less most keys that
    are not heavy.

    Rows are counted by bucket of their key's hash, which combines before the shuffle to a few
    lines a task. A key of more than ``heavy`` rows lies in a bucket of more; only rows of such
    buckets are counted by key.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    full = rows.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_rows")).filter(
        F.col("_rows") > heavy).select("_bucket")
    return rows.join(F.broadcast(full), bucket == F.col("_bucket"), "left_semi").groupBy(
        *keys).agg(F.count("*").alias("rows"))


def salted_lookup(facts, dimension, keys, row_id, sizes=None, how="left", heavy=HEAVY,
                  piece=PIECE):
    """Join facts to a dimension on ``keys``, spreading heavy keys over many tasks.

    Rows of a heavy key are dealt into pieces by the hash of ``row_id``, as many as the key's
    own size asks for, and the matching dimension rows are repeated once per piece; every
    other key joins as usual. NULL keys match nothing but are dealt out all the same.
    ``sizes`` (one row per key, count in ``rows``) may be passed when the caller has it already.
    """
    if sizes is None:
        sizes = facts.groupBy(*keys).agg(F.count("*").alias("rows"))
    cut = heavy_keys(sizes, keys, "rows", heavy, piece).select(
        *[F.col(k).alias(f"_heavy_{k}") for k in keys], "_pieces"
    )

    def marked(df):
        match = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]
        found = df.join(F.broadcast(cut), match, "left")
        return found.drop(*[f"_heavy_{k}" for k in keys])

    own = F.pmod(F.xxhash64(*row_id), F.col("_pieces")).cast("int")
    dealt = marked(facts).withColumn("_piece", F.coalesce(own, F.lit(0))).drop("_pieces")
    copies = F.sequence(F.lit(0), F.col("_pieces") - 1)
    repeated = marked(dimension).withColumn(
        "_piece", F.explode(F.coalesce(copies, F.array(F.lit(0))))
    ).drop("_pieces")
    return dealt.join(repeated, [*keys, "_piece"], how).drop("_piece")
