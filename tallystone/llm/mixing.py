"""Mix sources to target weights by weighted fair queueing, on DataFrame operations alone.

Each source's documents are shuffled by a digest of their id and text and queue up one behind
the other, then the whole queue again, up to ``repeats`` times. A copy's virtual finish time
is its source's words so far over the source's target. Sorted by that time over all sources,
copies are taken until the next one would exceed the total budget.

Both running sums follow a global range sort and are taken in two levels, over the ranges and
within each range, so no window holds a whole source or the whole queue. The place of a row
in its table is the last sort key: rows with equal ids, texts or times, however many, are
split over ranges like any others.

Defined cases: a null text has size 0; a null source is a source of its own, last in the
order of weights; rows repeated whole are separate documents; an empty table gives an empty
result; a null id counts as an empty text in the digest. Other columns are never looked at,
and come back with ``mixed_documents``; of rows equal in id, text and source, earlier ones
are taken first.
"""

from pyspark.sql import Window, functions as F

from .common import WORD, identified, materialize, quoted, unused

CYCLE = (1, 2, 3)
#: Rows of a range of the sort at most, about; smaller where that keeps more tasks busy.
RANGE, SMALL = 1_000_000, 10_000


def targets(sizes, repeats=3, weights=CYCLE):
    """Target words per source, from a table (source, source_size).

    Weights repeat over the sources by code point, null last. They share all words; a
    target above ``repeats`` times its source stops there and the excess is shared anew by
    weight, until none is above. One row per source is sorted in one task: these are
    totals, not documents.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn(
        "weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights))
    ).withColumn("limit", F.col("source_size") * repeats)
    fill = F.col("limit") / F.col("weight")
    rising = Window.orderBy(fill, F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything)
             - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(onward)
    filled = ranked.withColumn("fill", fill).withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level")))
        .over(everything)["level"])
    return filled.select(
        "source", "source_size",
        F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def running_sum(df, rows, group, order, amount, name):
    """``amount`` summed along ``order`` within ``group``, after a global sort into ranges."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(-(-rows // RANGE), min(tasks, -(-rows // SMALL)), 1)
    df = materialize(df.repartitionByRange(ranges, *group, *order).withColumn(
        "band", F.spark_partition_id()), "mix-ranges")
    bands = df.groupBy(*group, "band").agg(F.sum(amount).alias("in_band"))
    along = Window.partitionBy(*group).orderBy("band")
    bands = bands.withColumn("before", F.coalesce(
        F.sum("in_band").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    right = bands.select(*[F.col(c).alias(f"r_{c}") for c in (*group, "band")], "before")
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in (*group, "band")]
    joined = df.join(right, same).drop(*[f"r_{c}" for c in (*group, "band")])
    within = Window.partitionBy(*group, "band").orderBy(*order)
    return joined.withColumn(
        name, F.col("before") + F.sum(amount).over(
            within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("before", "band")


def queued(docs, carried=(), id_col="doc_id", text="text", source="source", repeats=3,
           weights=CYCLE):
    """Every document with size, source_size, target and ``copies`` taken of it."""
    digest = F.md5(F.concat_ws("\x1f", F.coalesce(quoted(id_col).cast("string"), F.lit("")),
                               F.coalesce(quoted(text).cast("string"), F.lit(""))))
    sized = materialize(docs.select(
        F.struct(*[quoted(c) for c in carried]).alias("doc") if carried else
        quoted(id_col).alias("doc_id"),
        quoted(source).alias("source"), digest.alias("digest"),
        F.coalesce(F.regexp_count(quoted(text), F.lit(WORD)), F.lit(0)).cast("long")
        .alias("size"), F.monotonically_increasing_id().alias("place")), "mix-sizes")
    rows = sized.count()
    goals = materialize(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), repeats,
                weights), "mix-targets")
    queue = running_sum(sized, rows, ["source"], ["digest", "place"], "size", "ahead")
    queue = materialize(queue.join(
        goals.withColumnRenamed("source", "r_source"),
        F.col("source").eqNullSafe(F.col("r_source"))).drop("r_source"), "mix-queue")

    def finish(turn):
        words = F.col("ahead") + turn * F.col("source_size")
        return F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))

    turns = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    line = queue.select("digest", "place", "size", "ahead", "target", "source_size",
                        turns.alias("turn")).select(
        "digest", "place", "size", "turn", finish(F.col("turn")).alias("finish"))
    budget = goals.agg(F.sum("source_size")).first()[0] or 0
    order = ["finish", "digest", "place", "turn"]
    line = running_sum(line, rows * repeats, [], order, "size", "total")
    last = line.filter(F.col("total") <= budget).agg(
        F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        taken = F.lit(0)
    else:
        kinds = ("double", "string", "long", "int")
        end = F.struct(*[F.lit(v).cast(kind) for v, kind in zip(last, kinds)])
        taken = sum((F.when(
            F.struct(finish(F.lit(t)).alias("finish"), "digest", "place",
                     F.lit(t).alias("turn")) <= end, 1).otherwise(0)
            for t in range(repeats)), F.lit(0))
    return queue.withColumn("copies", taken)


def mixed_sizes(docs, id_col="doc_id", text="text", source="source", **options):
    """doc_id, size, source_size, target and taken (words) of every document."""
    return queued(docs, (), id_col, text, source, **options).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs, id_col="doc_id", text="text", source="source", **options):
    """The rows of ``docs``, each as often as the mix takes it."""
    row, copies, copy = (unused(docs, n) for n in ("row", "copies", "copy"))
    named = identified(docs, row)
    taken = queued(named, (row,), id_col, text, source, **options).filter("copies > 0").select(
        F.col("doc")[row].alias(row), F.col("copies").alias(copies))
    again = F.explode(F.array_repeat(F.lit(1), F.col(copies)))
    return named.join(taken, row).withColumn(copy, again).drop(row, copies, copy)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         md5(coalesce(cast(doc_id AS varchar), '') || chr(31) || coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
ranked AS (
  SELECT source, sum(size)::bigint AS source_size,
         1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (3 * source_size) / weight AS fill,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
            ORDER BY (3 * source_size) / weight, source IS NULL, source
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY (3 * source_size) / weight, source IS NULL, source
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
goals AS (
  SELECT source, source_size, least((3 * source_size)::double,
           weight * (SELECT level FROM levels WHERE level <= fill ORDER BY fill, level LIMIT 1)
         ) AS target
  FROM levels),
queue AS (
  SELECT s.*, g.source_size, g.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY digest, size ROWS UNBOUNDED PRECEDING)
           AS ahead
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (
  SELECT *, CASE WHEN target > 0 THEN (ahead + turn * source_size) / target ELSE 0 END AS finish
  FROM queue, (SELECT unnest([0, 1, 2]) AS turn)),
line AS (
  SELECT *, sum(size) OVER (ORDER BY finish, digest, size, turn ROWS UNBOUNDED PRECEDING) AS total
  FROM copies)
SELECT doc_id, size::bigint AS size, source_size, target,
       sum(CASE WHEN total <= (SELECT sum(size) FROM sized) THEN size ELSE 0 END)::bigint AS taken
FROM line GROUP BY doc_id, digest, size, source_size, target
"""
