"""Near-duplicate texts by SimHash, joined over binary tries.

A fingerprint has a bit set if more than half of the hashes of the text's shingles have it.
Equal fingerprints are one class from the start. Two different ones within ``budget`` bits
agree on at least one of a few chosen sets of bits, so each fingerprint goes into one table
per set, where those with the same bits there form the top node of a binary trie over the
other bits. The trie is joined with itself: pairs of nodes descend together, count the bits
on which they part, and are dropped once the count exceeds the budget.

The bits per table follow the number of fingerprints, so tries stay small. One that is still
larger than ``block`` rows is cut into blocks by hash, and every pair of blocks becomes a task
of its own. A task returns links to one member per group it found, not all pairs.

Defined cases: a null or wordless text has fingerprint zero and links like any other; a null
id takes part, and a group of null ids only has a null component; rows repeated whole are
copies of each other; an empty table gives an empty result.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F, types as T

from .common import identified, map_texts, materialize, unused
from .components import connected

SEED = 42
CHUNK = 1 << 16


def fingerprint(text, width=3):
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at:min(at + CHUNK, n)].tolist(), last[at:at + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs, keep, text="text", width=3):
    """``keep`` by position (c0, c1, ...) and ``fp``, the fingerprint as a signed long."""
    def start():
        def compute(texts):
            made = np.array([fingerprint(t, width) for t in texts], np.uint64)
            return [made.view(np.int64)]
        return compute

    return map_texts(docs, text, keep, [T.StructField("fp", T.LongType(), False)], start)[0]


def bit_tables(count, budget=3):
    """Masks of the bits that each table fixes; any pair within the budget shares one.

    64 bits are cut into budget + k parts, and every choice of k parts is a table: of
    ``budget`` differing bits at least k parts stay clear. k grows with the fingerprints.
    """
    k = 1
    while k < 4 and count > 64 << (64 * k // (budget + k)):
        k += 1
    cuts = [64 * i // (budget + k) for i in range(budget + k + 1)]
    parts = [sum(1 << bit for bit in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, k)]


def trie_pairs(values, a_low, a_high, b_low, b_high, mask, budget):
    """Index pairs within the budget, from pairs of trie nodes given as ranges of ``values``.

    ``values`` are sorted within each range by the bits outside ``mask``, on which all
    members of a node pair agree. A range paired with itself yields each pair once.
    """
    error = np.zeros(len(a_low), np.int8)
    found = []
    for bit in [b for b in range(63, -1, -1) if not mask >> b & 1]:
        single = (a_high - a_low == 1) & (b_high - b_low == 1)
        if single.any():
            a, b = a_low[single], b_low[single]
            near = np.bitwise_count(values[a] ^ values[b]) <= budget
            found.append((a[near], b[near]))
            a_low, a_high, b_low, b_high, error = (
                x[~single] for x in (a_low, a_high, b_low, b_high, error))
        if not len(a_low):
            break
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1),
                                              dtype=np.int64)])
        a_mid = a_high - (ones[a_high] - ones[a_low])
        b_mid = b_high - (ones[b_high] - ones[b_low])
        itself = a_low == b_low
        children = [
            (a_low, a_mid, b_low, b_mid, error), (a_mid, a_high, b_mid, b_high, error),
            (a_low, a_mid, b_mid, b_high, error + 1),
            *[tuple(x[~itself] for x in (a_mid, a_high, b_low, b_mid, error + 1))],
        ]
        a_low, a_high, b_low, b_high, error = map(np.concatenate, zip(*children))
        live = ((a_high > a_low) & (b_high > b_low) & (error <= budget)
                & ((a_low != b_low) | (a_high - a_low > 1)))
        a_low, a_high, b_low, b_high, error = (
            x[live] for x in (a_low, a_high, b_low, b_high, error))
    # what is left shares every bit
    for al, ah, bl, bh in zip(a_low, a_high, b_low, b_high):
        a, b = np.meshgrid(np.arange(al, ah), np.arange(bl, bh), indexing="ij")
        apart = a != b
        found.append((a[apart], b[apart]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(map(np.concatenate, zip(*found)))


def lowest_member(size, a, b):
    """For every index the smallest index it is linked with, directly or not."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def join_tries(batches, masks, budget, room=600_000):
    """Links found in rows sorted by trie; whole tries are taken together up to ``room`` pairs."""
    def solve(rows):
        which, mine, fp = rows["t"], rows["mine"], rows["fp"].view(np.uint64)
        for table in np.unique(which):
            own = which == table
            group, side, values = rows["g"][own], mine[own], fp[own]
            mask = masks[table]
            free = values & np.uint64(~mask & (1 << 64) - 1)
            order = np.lexsort((free, side, group))
            group, side, values = group[order], side[order], values[order]
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            ends = np.r_[starts[1:], len(group)]
            second = np.add.reduceat(side, starts)  # rows of the second block come last
            middle = ends - second
            # a trie with both blocks joins the first with the second, others join themselves
            both = (second > 0) & (middle > starts)
            a, b = trie_pairs(values, starts, np.where(both, middle, ends),
                              np.where(both, middle, starts), ends, mask, budget)
            near = np.bitwise_count(values[a] ^ values[b]) <= budget
            label = lowest_member(len(values), a[near], b[near])
            linked = np.flatnonzero(label != np.arange(len(values)))
            yield values[linked].view(np.int64), values[label[linked]].view(np.int64)

    def ready(rows, everything):
        """Solve as many whole tries as there are; the last may go on in the next batch."""
        if not len(rows["g"]):
            return rows
        edge = np.flatnonzero(rows["g"][1:] != rows["g"][:-1]) + 1
        bounds = np.r_[0, edge, len(rows["g"])] if everything else np.r_[0, edge]
        size = np.diff(bounds)
        at = 0
        while at < len(size):
            pairs = np.cumsum(size[at:].astype(np.float64) ** 2)
            upto = at + max(1, int(np.searchsorted(pairs, room)))
            part = {k: v[bounds[at]:bounds[upto]] for k, v in rows.items()}
            if size[at:upto].max() > 1:
                yield from solve(part)
            at = upto
        return {k: v[bounds[-1]:] for k, v in rows.items()}

    left = None
    for batch in batches:
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("t", "g", "mine", "fp")}
        if left is not None:
            rows = {n: np.concatenate([left[n], rows[n]]) for n in rows}
        left = yield from ready(rows, False)
    if left is not None:
        yield from ready(left, True)


def links(classes, budget=3, block=1000):
    """Links (a, b) that connect all fingerprints ``fp`` within the budget of each other."""
    masks = bit_tables(classes.count(), budget)
    tables = F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(
            F.lit(m - (1 << 64) if m >> 63 else m)).alias("key"))
        for i, m in enumerate(masks)])).alias("place")
    rows = classes.select("fp", tables).select("fp", "place.t", "place.key")
    large = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = materialize(large.select(
        "t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large-tries")
    placed = rows.join(large, ["t", "key"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "own", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "t", "fp", F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other"))
        .alias("g"), (F.col("own") > F.col("other")).cast("int").alias("mine"))
    spread = met.repartition(F.col("g")).sortWithinPartitions("g", "t")

    def run(batches):
        for a, b in join_tries(batches, masks, budget):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return spread.mapInArrow(run, "a long, b long")


def grouped(rows, key, budget=3, block=1000):
    """``rows`` (with fp) and ``component``: the smallest ``key`` over linked rows."""
    classes = materialize(rows.groupBy("fp").agg(F.min(key).alias("first")), "simhash-classes")
    found = connected(links(classes, budget, block)).withColumnRenamed("node", "fp")
    of_class = classes.join(found, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = of_class.groupBy("component").agg(F.min("first").alias("smallest"))
    named = materialize(of_class.join(least, "component").select(
        "fp", F.col("smallest").alias("component")), "simhash-components")
    return rows.join(named, "fp")


def near_duplicates(docs, id_col="doc_id", text="text", budget=3):
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    rows = materialize(fingerprints(docs, [id_col], text).withColumnRenamed("c0", "doc_id"),
                       "simhash")
    return grouped(rows, "doc_id", budget).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def one_of_each(docs, id_col="doc_id", text="text", budget=3):
    """The rows of ``docs`` less near copies: of each group the one with the smallest id.

    Of rows with the same id in a group the first read stays.
    """
    row = unused(docs, "row")
    named = identified(docs, row)
    marked = materialize(fingerprints(named, [id_col, row], text), "simhash-rows")
    key = F.struct(F.col("c0").isNull().alias("no_id"), F.col("c0").alias("id"),
                   F.col("c1").alias("row"))
    stays = grouped(marked.select("fp", key.alias("key")), "key", budget).filter(
        "key.row = component.row").select(F.col("key.row").alias(row))
    return named.join(stays, row).drop(row)
