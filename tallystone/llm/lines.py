"""Drop lines that many documents share.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z). Every task marks
its keys in two Bloom filters: in the first when it meets a key, in the second when it meets
one that the first already has. Tasks' filters meet segment by segment: what two tasks have
both marked once goes into the second as well. Only keys in the final second filter may occur
twice, and only those leave their task, as digests, to be counted exactly. The filters have a
fixed limit in size; if they fill up, more keys are counted, and the result is the same.

A key counted in ``min_docs`` documents or more loses its lines: all of them, or with
``keep_first`` all but the first in the document of smallest id (of equal ids the row that
stands first in the files). Rows are named by file and place, so texts stay where they are:
while the common lines are few, every task of the last scan holds their digests. More than
``HELD`` of them meet the documents that lose lines in a join instead, with the same result.

Defined cases: a null or empty text is one empty line, and stays empty; rows repeated whole
count as documents of their own; a null id counts like any other (and sorts last for
``keep_first``); an empty table gives an empty result.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F, types as T

from .common import SPACE, as_bytes, identified, materialize, quoted, unused

PROBES = 4
SEGMENT = 1 << 17
#: Bits per document, and the limits of a filter: 128 KB and 32 MB.
BITS_PER_DOC, LEAST_BITS, MOST_BITS = 128, 1 << 20, 1 << 28
#: Common lines that a task holds; about 200 bytes each with their place.
HELD = 100_000


def line_key(line):
    return line.strip(SPACE).lower()


def probes(hashes, bits):
    """Positions of each 64-bit hash in a filter, one row per hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) % np.uint64(bits)).astype(np.int64)


def hashes_of(keys):
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def keys_of(text, min_chars):
    """Distinct keys of a text with at least ``min_chars`` code points."""
    keys = {line_key(x) for x in (text or b"").split(b"\n")}
    return [k for k in keys if len(k) >= min_chars
            and (min_chars <= 1 or len(k.decode("utf-8", "replace")) >= min_chars)]


def filter_bits(rows):
    return min(MOST_BITS, max(LEAST_BITS, 1 << max(0, rows * BITS_PER_DOC - 1).bit_length()))


def put(bits, at):
    """Set the bits at positions ``at``; eight to a byte."""
    np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def held(bits, at):
    """Whether all bits of a row of positions are set."""
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def packed(bits):
    return zlib.compress(bits.tobytes(), 1)


def unpacked(data):
    return np.frombuffer(zlib.decompress(data), np.uint8)


def twice_seen(docs, text, bits, min_chars):
    """The second filter over all documents: one byte per eight bits."""
    wide = min(SEGMENT, bits) // 8

    def mark(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            keys = [k for t in as_bytes(batch.column(0)) for k in keys_of(t, min_chars)]
            found, n = np.unique(hashes_of(keys), return_counts=True)
            at = probes(found, bits)
            put(twice, at[(n > 1) | held(once, at)].ravel())
            put(once, at.ravel())
        used = np.flatnonzero(once.reshape(-1, wide).any(axis=1))
        for i in used:
            part = slice(i * wide, (i + 1) * wide)
            yield pa.RecordBatch.from_arrays([
                pa.array([i], pa.int32()), pa.array([packed(once[part])], pa.binary()),
                pa.array([packed(twice[part])], pa.binary())], names=["segment", "once", "twice"])

    def meet(key: tuple[pa.Scalar, ...],
             batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = None
        for batch in batches:
            for i in range(batch.num_rows):
                a = unpacked(batch.column("once")[i].as_py())
                b = unpacked(batch.column("twice")[i].as_py())
                if once is None:
                    once, twice = a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0].as_py()], pa.int32()),
            pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], names=["segment", "twice"])

    marks = docs.select(quoted(text)).mapInArrow(mark, "segment int, once binary, twice binary")
    merged = marks.groupBy("segment").applyInArrow(meet, "segment int, twice binary")
    whole = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        whole[row["segment"] * wide:(row["segment"] + 1) * wide] = unpacked(row["twice"])
    return whole


def suspects(docs, place, id_col, text, min_chars):
    """One row per document and suspected key: the document's id and place, the key's digest."""
    spark = docs.sparkSession
    bits = filter_bits(docs.count())
    seen = spark.sparkContext.broadcast(twice_seen(docs, text, bits, min_chars))

    def pick(batches):
        for batch in batches:
            row, keys = [], []
            for i, t in enumerate(as_bytes(batch.column(2))):
                mine = keys_of(t, min_chars)
                keys += mine
                row += [i] * len(mine)
            hit = np.flatnonzero(held(seen.value, probes(hashes_of(keys), bits)))
            row = pa.array(np.array(row, np.int64)[hit])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(row), batch.column(1).take(row),
                pa.array([hashlib.md5(keys[j]).digest() for j in hit.tolist()], pa.binary()),
            ], names=["id", "place", "key"])

    given = docs.select(quoted(id_col).alias("id"), quoted(place).alias("place"),
                        quoted(text).cast("string").alias("text"))
    schema = T.StructType([*given.schema.fields[:2], T.StructField("key", T.BinaryType())])
    return materialize(given.mapInArrow(pick, schema), "line-suspects")


def rank():
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "place")


def common_lines(found, min_docs):
    """key and first: the first document, by id and place, that has it."""
    return materialize(found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(rank()).alias("first")
    ).filter(F.col("n") >= min_docs).select("key", "first"), "common-lines")


def losses(found, common):
    """Per document with any: digests of the keys it loses, and whether it is their first."""
    lost = found.join(common, "key").select(
        F.col("place").alias("lost_place"),
        F.struct("key", (rank() == F.col("first")).alias("first")).alias("loss"))
    return lost.groupBy("lost_place").agg(F.collect_set("loss").alias("losses"))


def kept_lines(text, lost, first, min_chars):
    """Number of lines, and the lines that stay: those whose key's digest is not in ``lost``,
    and of a key in ``first`` the first one."""
    lines, stay, met = text.split(b"\n"), [], set()
    for line in lines:
        key = line_key(line)
        digest = hashlib.md5(key).digest() if len(key) >= min(1, min_chars) else None
        if digest not in lost or (digest in first and digest not in met):
            stay.append(line)
        met.add(digest)
    return len(lines), stay


def rewritten(docs, keep, id_col, text, min_chars, min_docs, keep_first):
    """``keep`` by position, n_lines, n_dropped and the text that stays (as ``kept``)."""
    place = unused(docs, "place")
    docs = identified(docs, place)
    found = suspects(docs, place, id_col, text, min_chars)
    common = common_lines(found, min_docs)
    names = [f"c{i}" for i in range(len(keep))]
    given = docs.select(
        *[quoted(c).alias(n) for c, n in zip(keep, names)], quoted(place).alias("place"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    few = common.count() <= HELD
    if few:
        digests = docs.sparkSession.sparkContext.broadcast(
            {bytes(r["key"]): tuple(r["first"]["place"]) for r in common.collect()})
        joined = given.withColumn("losses", F.lit(None).cast("string"))
    else:
        lost = losses(found, common)
        joined = given.join(lost, F.col("place") == F.col("lost_place"), "left").drop("lost_place")
    schema = T.StructType([*joined.schema.fields[:len(keep)],
                           T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()),
                           T.StructField("kept", T.StringType())])

    def choices(batch):
        """For every row the digests that lose lines, and those whose first line may stay."""
        if few:
            for at in batch.column("place").to_pylist():
                yield digests.value, mine.get(tuple(at.values()), ()) if keep_first else ()
            return
        for own in batch.column("losses").to_pylist():
            yield ({x["key"] for x in own or ()},
                   {x["key"] for x in own or () if x["first"]} if keep_first else ())

    mine = {}

    def write(batches):
        if few and keep_first:
            for digest, at in digests.value.items():
                mine.setdefault(at, []).append(digest)
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for t, (lost, first) in zip(as_bytes(batch.column("text")), choices(batch)):
                if lost:
                    n, stay = kept_lines(t, lost, first, min_chars)
                    n_lines.append(n)
                    n_dropped.append(n - len(stay))
                    kept.append(b"\n".join(stay))
                else:
                    n_lines.append(t.count(b"\n") + 1)
                    n_dropped.append(0)
                    kept.append(t)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:len(keep)], pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*names, "n_lines", "n_dropped", "kept"])

    return joined.mapInArrow(write, schema), names


def line_report(docs, id_col="doc_id", text="text", min_chars=1, min_docs=10, keep_first=False):
    """doc_id, n_lines, n_dropped and the digest of the text that stays, for every document."""
    made, _ = rewritten(docs, [id_col], id_col, text, min_chars, min_docs, keep_first)
    return made.select(F.col("c0").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def without_common_lines(docs, id_col="doc_id", text="text", min_chars=1, min_docs=10,
                         keep_first=False):
    """The rows of ``docs`` with their texts less the dropped lines. A null text stays null."""
    empty = unused(docs, "empty")
    marked = docs.withColumn(empty, quoted(text).isNull())
    keep = [c for c in marked.columns if c != text]
    made, names = rewritten(marked, keep, id_col, text, min_chars, min_docs, keep_first)
    place = dict(zip(keep, names))
    stays = F.when(~F.col(place[empty]), F.col("kept"))
    return made.select(*[(stays if c == text else F.col(place[c])).alias(c)
                         for c in docs.columns])


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (c.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), ''))
         AS kept_sha256
FROM keyed k LEFT JOIN common c USING (key) GROUP BY doc_id
"""
