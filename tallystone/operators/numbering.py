"""Row numbers within a group, or a file, of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

BLOCK = 1_000_000


def number_copies(rows, key, name="record_number", block=BLOCK, counted=None):
    """Number the copies of each key by file name and position in the file, from 1.

    Numbers are given within blocks of ``block`` file rows, which bounds what one task
    sorts, and shifted by the size of the key's earlier blocks. NULL is a key too.

    Where ``rows`` is costly, ``counted`` names a cheaper table to take the block sizes
    from: it must hold the same copies of every key that has several in ``rows``.
    """
    place = [key, "file_name", "_block"]
    position = Window.partitionBy(*place).orderBy("file_row_number")
    earlier = (
        Window.partitionBy(key)
        .orderBy("file_name", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def placed(df):
        return df.withColumn("_block", F.expr(f"file_row_number div {block}"))

    sizes = placed(rows if counted is None else counted).groupBy(*place).agg(
        F.count("*").alias("_size")
    )
    # only a key's second and later blocks need a shift, so few rows are left to join
    shifts = sizes.withColumn("_before", F.sum("_size").over(earlier)).filter(
        "_before is not null"
    ).select(*[F.col(c).alias(f"{c}_at") for c in place], "_before")
    numbered = placed(rows).withColumn("_position", F.row_number().over(position))
    same_place = [F.col(c).eqNullSafe(F.col(f"{c}_at")) for c in place]
    return (
        numbered.join(shifts, same_place, "left")
        .withColumn(name, F.expr("cast(_position as bigint) + coalesce(_before, 0)"))
        .drop("_block", "_position", "_before", *[f"{c}_at" for c in place])
    )
