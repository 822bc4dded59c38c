"""Prefix trie of conversations, built from its deepest nodes upwards.

A conversation is the sequence of its turns; every distinct sequence of first d turns is a
node of depth d. Peeling starts at the greatest depth. At each depth the conversations that
end there meet the nodes that survive from the depth below with their last turn stripped, and
both are grouped by what is left: the groups are the nodes of this depth, and as they are
found they add up members, children, leaves and saved tokens of what lies below. Sums are
formed before the shuffle, so a prefix that a third of all conversations share is no hot group.

Turns are carried as digests, and a prefix by a chained digest, never as texts. Below depth
``FLOOR`` few prefixes are shared. There, a prefix with at most ``CELLS`` turns below it is
peeled within a task, turn by turn in the same way; one with more is peeled like the rest.

Defined cases: turns ascend by number, null first, equal numbers by the digest of role and
text; null role or text is empty; rows without a conversation are left out; rows repeated
whole are turns of their own; an empty table gives an empty result. One conversation's turns
(some 30 bytes each, whatever their texts) are one row. Extra columns are never looked at.
"""

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from .common import few, materialize, quoted
from .merkle import CRC32

#: Depth down to which every depth is a step of its own, and turns peeled within one task.
FLOOR, CELLS = 8, 200_000
#: Ids strung together at once.
IDS = 20_000
#: The node without turns.
ROOT = b""
PATH = "array<struct<key:binary,chars:bigint>>"
NODES = ("key binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint")


def sequences(conversations, id_col="conv_id", turn="turn", role="role", text="text"):
    """conv_id and turns, an array of (digest, chars) in order, of every conversation."""
    role = F.coalesce(quoted(role).cast("string"), F.lit(""))
    text = F.coalesce(quoted(text).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.filter(quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("conv_id"), F.struct(
            quoted(turn).isNotNull().alias("has_number"), quoted(turn).alias("number"),
            digest.alias("digest"), F.char_length(text).cast("long").alias("chars")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list("turn")),
        lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def spliced(given, group=100, most=6):
    """Every conversation c begins with the first h turns of conversation c - c % ``group``, and
    goes on with its own after its first h; h is the crc32 of its number modulo ``most``."""
    given = materialize(given, "trie-sequences")
    heads = given.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    # at most ``group`` conversations have the same base
    return given.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(
        few(heads), "base", "left").select("conv_id", F.concat(
            F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h),
            F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def chained(given):
    """conv_id and path: for every turn the digest of the prefix that it ends, and its length."""
    def run(batches):
        for batch in batches:
            made = []
            for turns in batch.column("turns").to_pylist():
                key, path = ROOT, []
                for t in turns:
                    key = hashlib.blake2b(key + t["digest"], digest_size=16).digest()
                    path.append({"key": key, "chars": t["chars"]})
                made.append(path)
            kind = pa.list_(pa.struct([("key", pa.binary()), ("chars", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(made, kind)], names=["conv_id", "path"])

    return given.select("conv_id", "turns").mapInArrow(run, f"conv_id bigint, path {PATH}")


def nodes_of(met):
    """Rows that meet at one depth, grouped by path: the nodes of that depth."""
    grouped = met.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    chars = F.coalesce(F.try_element_at("path", F.lit(-1))["chars"], F.lit(0))
    return grouped.withColumn(
        "n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))
    ).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * chars)


def ended(classes, depth):
    none = F.lit(0).cast("long")
    return classes.filter(F.col("depth") == depth).select(
        "path", "conv_id", "n_convs", none.alias("n_children"), none.alias("n_leaves"),
        none.alias("saved_tokens"))


def stripped(nodes):
    """Nodes as what their parents gather."""
    return nodes.select(
        F.slice("path", F.lit(1), F.size("path") - 1).alias("path"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")


def peeled_group(paths, counts, ids, floor):
    """Nodes deeper than ``floor`` of conversations that share their first ``floor`` turns.

    A node is [conv_id, n_convs, n_children, n_leaves, saved_tokens, a conversation below it].
    """
    ends = defaultdict(list)
    for i, path in enumerate(paths):
        ends[len(path)].append(i)
    above = {}
    for depth in range(max(ends, default=0), floor, -1):
        found = {}
        for node in [*([ids[i], counts[i], 0, 0, 0, i] for i in ends[depth]),
                     *([c, n, 1, leaves, saved, i] for c, n, _, leaves, saved, i in above.values())]:
            key = paths[node[5]][depth - 1]["key"]
            met = found.get(key)
            if met is None:
                found[key] = node
            else:
                met[0] = min(met[0], node[0])
                for k in range(1, 5):
                    met[k] += node[k]
        for key, node in found.items():
            path = paths[node[5]]
            node[3] = node[3] if node[2] else 1
            node[4] += (node[1] - 1) * path[depth - 1]["chars"]
            yield (key, path[depth - 2]["key"], depth, *node[:5],
                   path[:depth] if depth == floor + 1 else None)
        above = found


def peeled_in_tasks(deep, floor):
    """Nodes deeper than ``floor``, one prefix of that depth at a time; the uppermost with path."""
    names = [x.split()[0] for x in NODES.split(", ")] + ["path"]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 6,
             pa.list_(pa.struct([("key", pa.binary()), ("chars", pa.int64())]))]

    def run(key: tuple[pa.Scalar, ...],
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = pa.Table.from_batches(list(batches))
        rows = []
        for row in peeled_group(*(given.column(c).to_pylist() for c in (
                "path", "n_convs", "conv_id")), floor):
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 9, kinds)], names=names)

    return deep.groupBy("top").applyInArrow(run, f"{NODES}, path {PATH}")


def prefix(place):
    """Digest of the prefix that ends so many turns before the end of a path, null before none."""
    return F.when(F.size("path") > place, F.element_at("path", -1 - place)["key"]).when(
        F.size("path") == place, F.lit(ROOT))


def peeled(classes, floor=FLOOR, cells=CELLS):
    """All nodes, as ``NODES``, of the classes (path, depth, conv_id, n_convs)."""
    deep = classes.filter(F.col("depth") > floor).withColumn(
        "top", F.element_at("path", floor)["key"])
    sizes = deep.groupBy(F.col("top").alias("s_top")).agg(
        F.sum(F.col("depth") - floor).alias("cells"))
    large = materialize(sizes.filter(F.col("cells") > cells).select("s_top"), "trie-large")
    in_tasks = materialize(peeled_in_tasks(
        deep.join(few(large), F.col("top") == F.col("s_top"), "left_anti"), floor), "trie-deep")
    stepwise = classes
    if not large.isEmpty():
        kept = deep.join(few(large), F.col("top") == F.col("s_top"), "left_semi").drop("top")
        stepwise = materialize(classes.filter(F.col("depth") <= floor).unionByName(kept),
                               "trie-stepwise")
    else:
        stepwise = classes.filter(F.col("depth") <= floor)
    deepest = stepwise.agg(F.max("depth")).first()[0]
    if in_tasks.isEmpty() and deepest is None:
        return in_tasks.drop("path")
    uppermost = in_tasks.filter(F.col("depth") == floor + 1)
    found, above = [in_tasks.drop("path")], None
    for depth in range(max(deepest or 0, floor), -1, -1):
        met = ended(stepwise, depth)
        for lower in (above, uppermost if depth == floor else None):
            if lower is not None:
                met = met.unionByName(stripped(lower))
        above = materialize(nodes_of(met), "trie-depth")
        found.append(above.select(
            prefix(0).alias("key"), prefix(1).alias("parent"),
            F.lit(depth).cast("long").alias("depth"), "conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens"))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def end_digests(ends):
    """SHA-256 of each prefix's conversations, ascending, comma-joined, from (key, conv_id).

    The digest of a long list is taken in one go from first to last; the list comes as strings
    of many ids that other tasks have sorted and joined.
    """
    def strung(batches):
        key = first = None
        ids = []

        def row():
            return [key], [first], [",".join(map(str, ids)).encode()]

        def batch_of(rows):
            keys, firsts, texts = (sum(x, []) for x in zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()),
                 pa.array(texts, pa.binary())], names=["key", "first", "ids"])

        for batch in batches:
            rows = []
            for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if k != key or len(ids) >= IDS:
                    if ids:
                        rows.append(row())
                    key, first, ids = k, i, []
                ids.append(i)
            if rows:
                yield batch_of(rows)
        if ids:
            yield batch_of([row()])

    def hashed(batches):
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key or state is None:
                    if state is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = k, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(digests, pa.string())],
                names=["e_key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())],
                names=["e_key", "ends_sha256"])

    strings = ends.repartitionByRange("key", "conv_id").sortWithinPartitions(
        "key", "conv_id").mapInArrow(strung, "key binary, first bigint, ids binary")
    return strings.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        hashed, "e_key binary, ends_sha256 string")


def prefix_trie(given, floor=FLOOR, cells=CELLS):
    """All nodes of the trie over conv_id and turns: ``NODES``, the parent's conv_id and the
    digest of the conversations that end in the node."""
    paths = materialize(chained(given), "trie-paths")
    classes = paths.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    ).withColumn("depth", F.size("path"))
    nodes = materialize(peeled(materialize(classes, "trie-classes"), floor, cells), "trie-nodes")
    ends = end_digests(paths.select(prefix(0).alias("key"), "conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    known = nodes.join(ends, F.col("key") == F.col("e_key"), "left").drop("e_key").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
    root = nodes.filter(F.col("depth") == 0).select(F.col("conv_id").alias("root_id"))
    upper = nodes.filter(F.col("depth") > 0).select(
        F.col("key").alias("p_key"), F.col("conv_id").alias("parent_conv_id"))
    # the root has the most children, and is one row
    high = known.filter(F.col("depth") <= 1).crossJoin(F.broadcast(root)).withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.col("root_id"))).drop("root_id")
    low = known.filter(F.col("depth") > 1).join(
        few(upper), F.col("parent") == F.col("p_key")).drop("p_key")
    return high.unionByName(low)


def spliced_trie(conversations, **options):
    """The trie of all conversations after splicing: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    made = prefix_trie(spliced(sequences(conversations)), **options)
    return made.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                       "saved_tokens", "ends_sha256")


ORACLE = f"""
WITH given AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
      ORDER BY turn NULLS FIRST,
        md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT *, {CRC32.format('conv_id::varchar')} % 6 AS h FROM given),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN given b ON b.conv_id = c.conv_id - c.conv_id % 100),
nodes AS (
  SELECT turns[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (len(turns) = d) AS ends
  FROM rebuilt, unnest(range(len(turns) + 1)) u(d) GROUP BY 1, 2),
children AS (
  SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.depth].text) END AS saved
  FROM nodes n LEFT JOIN children c ON n.depth = c.depth AND n.path = c.path),
below AS (
  SELECT path[1:d] AS path, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(saved)::bigint AS saved_tokens
  FROM counted, unnest(range(depth + 1)) u(d) GROUP BY 1, 2)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
  b.saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN below b ON c.depth = b.depth AND c.path = b.path
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
"""
