"""Helpers that the operators share."""

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import shared_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Symbols that ``bytes.split()`` and the contracts call white space.
SPACE = b" \t\n\x0b\x0c\r"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(df, label):
    """Write a step to the shared folder and read it back: short lineage, computed once."""
    place = shared_dir(df.sparkSession, label)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def identified(docs, name):
    """``docs`` with a column naming each row by file and place, the same in every scan.

    So rows can be decided on without their texts, and picked by a later scan. A table that
    is not a plain scan of files is written first.
    """
    def by_place(df):
        place = df.metadataColumn("_metadata")
        return df.withColumn(name, F.struct(place["file_path"], place["row_index"]))

    try:
        named = by_place(docs)
        plain = named.groupBy(name).count().filter("count > 1").isEmpty()
    except AnalysisException:
        plain = False
    return named if plain else by_place(materialize(docs, "rows"))


def quoted(name):
    return F.col(f"`{name.replace('`', '``')}`")


def unused(df, name):
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def as_bytes(column):
    """Texts of an Arrow column as UTF-8 bytes; None stays."""
    return column.cast(pa.binary()).to_pylist()


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[T.StructField], start):
    """Columns ``keep`` of every row, and ``fields`` computed from its text in Arrow batches.

    ``start()`` runs once in each task and gives a function from a list of texts (bytes or
    None) to one list per field. Columns are passed by position, so their names may clash.
    """
    names = [f"c{i}" for i in range(len(keep))]
    at = keep.index(text) if text in keep else len(keep)
    given = [quoted(c).alias(n) for c, n in zip(keep, names)]
    if at == len(keep):
        given.append(quoted(text).cast("string").alias("text"))
    narrow = df.select(*given)
    schema = T.StructType([*narrow.schema.fields[:len(keep)], *fields])

    def run(batches):
        compute = start()
        types = None
        for batch in batches:
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                types = to_arrow_schema(T.StructType(fields))
            made = compute(as_bytes(batch.column(at)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)],
                 *[pa.array(x, f.type) for x, f in zip(made, types)]],
                names=[*names, *[f.name for f in fields]],
            )

    made = narrow.mapInArrow(run, schema)
    return made, names


def few(df, rows=100_000):
    """``df`` marked for broadcast if it has at most ``rows`` rows; a written, narrow table."""
    return F.broadcast(df) if df.count() <= rows else df


def spread_sample(df, keys, size, seed):
    """At most ``size`` rows of ``df``, the same in every run, by a hash of ``keys``.

    Counted first, so that only about as many rows as are wanted are sorted or sent on.
    """
    rows = df.count()
    place = F.xxhash64(*[k.cast("string") for k in keys], F.lit(seed))
    if rows > size:
        share = min(1.0, (1.2 * size + 100) / rows)
        df = df.filter(F.pmod(place, F.lit(1 << 40)) < int(share * (1 << 40)))
    return df.orderBy(place, *keys).limit(size)


def crc_bucket(column, buckets):
    """crc32 of the value as text, modulo ``buckets``."""
    return F.crc32(column.cast("string")) % buckets
