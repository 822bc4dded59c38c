"""Pack documents into training sequences by vector best fit.

A document's token ids, closed by an end id, form one piece, or if they exceed a sequence
several: a first piece of what is left over, then full ones. A sequence has three
capacities: tokens, documents, and attention cost (the sum of squared piece lengths). Pieces
are dealt at random into shards of about ``shard`` pieces. In each, from the longest piece
down, a piece goes into the open sequence that has room for it under every capacity and
scores best: with rule "norm" the smallest weighted norm of what would stay free, with rule
"dot" the largest weighted dot product of the piece and what is free, all as shares of the
capacities. If none has room it opens a new sequence.

Defined cases: a null or empty text is the end id alone; a null id comes back as null; rows
repeated whole are packed separately; an empty table gives an empty result.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from .common import materialize, quoted
from .tokens import Encoder

CAPACITY, END = 1024, 2
_encoders = {}


def default_tokenizer():
    """The ranks of the tokenizer file byte_bpe_50k.json, in the form that is fastest to apply."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(length, capacity):
    """Start and length of each piece: the first may be shorter, the others are full."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return starts, [b - a for a, b in zip(starts, [*starts[1:], length])]


def pieces(docs, id_col="doc_id", text="text", tokenizer=None, capacity=CAPACITY, end=END,
           with_ids=False):
    """doc_id, piece, start, length, ids_crc32 (and ids, as little-endian bytes)."""
    path = tokenizer or default_tokenizer()
    given = docs.select(quoted(id_col).alias("doc_id"), quoted(text).cast("string").alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("pieces", T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("ids_crc32", T.LongType()),
                      T.StructField("ids", T.BinaryType())])))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                               ("ids_crc32", pa.int64()), ("ids", pa.binary())]))

    def run(batches):
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        for batch in batches:
            made = []
            for ids in _encoders[path].encode_all(batch.column(1).to_pylist()):
                data = np.append(ids, end).astype("<u4")
                parts = []
                for start, length in zip(*cut(len(data), capacity)):
                    raw = data[start:start + length].tobytes()
                    parts.append((start, length, zlib.crc32(raw), raw if with_ids else None))
                made.append(parts)
            names = ("start", "length", "ids_crc32", "ids")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[dict(zip(names, p)) for p in parts]
                                            for parts in made], kind)],
                names=["doc_id", "pieces"])

    cut_up = given.mapInArrow(run, schema).select(
        "doc_id", F.posexplode("pieces").alias("piece", "part"))
    return cut_up.select("doc_id", "piece", "part.start", "part.length", "part.ids_crc32",
                         *(["part.ids"] if with_ids else []))


def best_fit(lengths, capacity, most_docs, most_cost, weights, rule):
    """Bin of every piece, in an order of bins by opening; pieces from the longest down."""
    size = np.array([capacity, most_docs, most_cost], np.float64)
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    free = np.empty((max(1, len(lengths)), 3))
    # open bins with room for the shortest piece at least, by number
    live = np.empty(0, np.int64)
    count, shortest = 0, lengths.min() if len(lengths) else 0
    for i in order:
        n = float(lengths[i])
        need = np.array([n, 1.0, n * n])
        room = free[live]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if len(fits):
            share = room[fits] / size
            part = need / size
            score = ((share - part) ** 2 @ weights if rule == "norm" else -(share @ (part * weights)))
            chosen = live[fits[np.argmin(score)]]
        else:
            chosen, count = count, count + 1
            free[chosen] = size
            live = np.append(live, chosen)
        free[chosen] -= need
        bins[i] = chosen
        left = free[chosen]
        if left[0] < shortest or left[1] < 1 or left[2] < shortest * shortest:
            live = live[live != chosen]
    return bins


def packed(made, capacity=CAPACITY, most_docs=None, most_cost=None, weights=(1.0, 0.02, 0.02),
           rule="norm", shard=4000):
    """The table of pieces with sequence_id and offset. ``made`` should be a written table."""
    most_docs = most_docs or capacity
    most_cost = most_cost or capacity * capacity
    if most_cost < capacity * capacity:
        raise ValueError("a full piece must fit: most_cost is below the capacity's square")
    shards = max(1, -(-made.count() // shard))
    weigh = np.array(weights)

    def pack(group):
        full = group["length"].to_numpy() == capacity
        lengths = group["length"].to_numpy()[~full]
        bins = best_fit(lengths, capacity, most_docs, most_cost, weigh, rule)
        opened = int(bins.max()) + 1 if len(bins) else 0
        sequence = np.empty(len(group), np.int64)
        sequence[~full] = bins
        sequence[full] = opened + np.arange(int(full.sum()))
        group["sequence_id"] = (group["shard"].to_numpy() << 32) + sequence
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group.drop(columns="shard")

    dealt = made.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("long"))
    schema = T.StructType([*made.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return dealt.groupBy("shard").applyInPandas(pack, schema)


def packed_pieces(docs, id_col="doc_id", text="text", tokenizer=None, capacity=CAPACITY, end=END,
                  **options):
    """Every piece of ``docs`` and its place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    made = pieces(docs, id_col, text, tokenizer, capacity, end)
    made = materialize(made.withColumn("row", F.monotonically_increasing_id()), "pieces")
    # ids stay on the Spark side of the packing, so nulls and types come back as they are
    places = packed(made.select("row", "length"), capacity, **options)
    return made.join(places.drop("length"), "row").drop("row")


def packed_sequences(docs, id_col="doc_id", text="text", tokenizer=None, capacity=CAPACITY,
                     end=END, **options):
    """sequence_id, ids (array of int) and doc_ids of every sequence."""
    made = pieces(docs, id_col, text, tokenizer, capacity, end, with_ids=True)
    made = materialize(made.withColumn("row", F.monotonically_increasing_id()), "pieces")
    places = packed(made.select("row", "length"), capacity, **options)
    placed = made.join(places.drop("length"), "row").select(
        "sequence_id", F.struct("offset", "ids", "doc_id").alias("part"))
    # a sequence holds at most ``capacity`` pieces
    whole = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))

    @F.pandas_udf("array<int>")
    def joined(parts: pd.Series) -> pd.Series:
        return parts.map(lambda x: np.frombuffer(b"".join(x), "<u4").astype(np.int32))

    return whole.select("sequence_id", joined(F.col("parts.ids")).alias("ids"),
                        F.col("parts.doc_id").alias("doc_ids"))
