"""Merkle manifest of a dataset: one root over all rows, and a proof for every row.

Every row is a leaf, the digest of its fields. The leaves of a source ascend by id and form a
tree: every ``fan`` consecutive nodes (the last run may have fewer, even one) become their
digest until one node remains. The sources' roots, ordered by source, form the last tree.

Trees grow by appending. An ``Appender`` takes a stream of nodes and keeps the open run of each
level; a node that is completed attaches the siblings before it to the witnesses of all leaves
below it, and every sibling completed later extends them. Leaves are streamed in aligned
blocks of a power of ``fan``, many blocks side by side, so a block's root is a node of the whole
tree: block roots are appended in turn, in blocks again, until each source has one root left.
A witness is that of the leaf in its block, extended by its block's in the next, and so on.
Full blocks never change, so ``append`` streams only the open block of each level again.

A witness is the siblings' digests one after the other, level by level, left to right; which
run they stand in follows from the leaf's position and the tree's size.

Defined cases: a null field is ``-``; rows without an id come first in their source; rows of
equal id ascend by leaf, and rows repeated whole are leaves of their own; a null source is a
source, the first; a lone leaf is its source's root; an empty table gives an empty result.
Extra columns are never looked at.
"""

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import few, materialize, quoted

FAN = 3
#: Levels of a block: 729 leaves for runs of three.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = ("tree", "pos", "size", "digest")


def leaf(fields):
    """Digest of the given columns: ``-`` for null, else byte count, colon, value."""
    def shown(column):
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(shown, fields)), 256))


def joined_digest(digests):
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


class Appender:
    """A tree growing by appended nodes, and the witness of every leaf so far."""

    def __init__(self, fan=FAN):
        self.fan, self.open, self.witnesses = fan, [], []

    def append(self, digest):
        self.witnesses.append(bytearray())
        self.complete(0, digest, len(self.witnesses) - 1, len(self.witnesses))

    def complete(self, level, digest, first, last):
        """A node of ``level`` over leaves ``first`` to ``last`` meets its open run."""
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        before = b"".join(d for d, _, _ in run)
        for witness in self.witnesses[first:last]:
            witness += before
        for _, a, b in run:
            for witness in self.witnesses[a:b]:
                witness += digest
        run.append((digest, first, last))
        if len(run) == self.fan:
            self.close(level)

    def close(self, level):
        run, self.open[level] = self.open[level], []
        self.complete(level + 1, joined_digest(d for d, _, _ in run), run[0][1], run[-1][2])

    def finish(self, levels=None):
        """Close open runs, up to ``levels`` or until one node remains, and return that node."""
        level = 0
        while True:
            top = self.open[level]
            if len(top) == 1 and (level == levels if levels is not None
                                  else not any(self.open[level + 1:])):
                return top[0][0]
            if top:
                self.close(level)
            level += 1


def fold(digest, witness, pos, size, fan=FAN):
    """The root that follows from a leaf and its witness, and the bytes of the witness used."""
    used = 0
    while size > 1:
        start = pos - pos % fan
        count = min(fan, size - start) - 1
        run = [witness[used + 32 * i:used + 32 * i + 32] for i in range(count)]
        run.insert(pos - start, digest)
        digest = joined_digest(run)
        used += 32 * count
        pos //= fan
        size = -(-size // fan)
    return digest, used


def numbered(rows, order):
    """``rows`` with pos, their place in their ``tree`` by ``order``, and the tree's size.

    Rows are dealt by ranges of the order, so a large tree has many ranges; places are counted
    within each range and shifted by the tree's rows in earlier ones.
    """
    placed = materialize(rows.repartitionByRange("tree", *order).sortWithinPartitions(
        "tree", *order).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("at", 33)
    runs = placed.groupBy(F.col("tree").alias("r_tree"), part.alias("r_part")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("r_tree")
    runs = materialize(runs.select(
        "r_tree", "r_part", "first", F.sum("n").over(tree).alias("size"),
        F.coalesce(F.sum("n").over(tree.orderBy("r_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before")), "merkle-runs")
    same = F.col("tree").eqNullSafe(F.col("r_tree")) & (part == F.col("r_part"))
    return placed.join(few(runs), same).withColumn(
        "pos", F.col("at") - F.col("first") + F.col("before")
    ).drop("r_tree", "r_part", "first", "before", "at")


def streamed(nodes, fan, levels):
    """``nodes`` with their witness in their block, and on its last node the block's root as
    ``above``."""
    block = fan ** levels
    nodes = nodes.withColumn("block", F.expr(f"pos div {block}"))
    dealt = nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    schema = T.StructType([*nodes.schema.fields, T.StructField("witness", T.BinaryType()),
                           T.StructField("above", T.BinaryType())])
    names = schema.names

    def run(batches):
        tree = key = None
        size = 0
        whole, waiting, rows = [], [], 0  # batches to come out; witnesses and roots of them

        def finished():
            root = tree.finish(levels if size > block else None)
            last = len(tree.witnesses) - 1
            return [(bytes(w), root if i == last else None) for i, w in enumerate(tree.witnesses)]

        def out():
            """All rows whose block is closed, as one batch."""
            given = pa.Table.from_batches(whole).combine_chunks()
            ready = given.slice(0, len(waiting))
            rest = given.slice(len(waiting)).to_batches()
            made = [] if not waiting else [pa.RecordBatch.from_arrays(
                [*[c.combine_chunks() for c in ready.columns],
                 pa.array([w for w, _ in waiting], pa.binary()),
                 pa.array([a for _, a in waiting], pa.binary())], names=names)]
            whole[:] = rest
            waiting.clear()
            return made

        for batch in batches:
            whole.append(batch)
            rows += batch.num_rows
            for mine, number, n, digest in zip(*(batch.column(c).to_pylist() for c in (
                    "tree", "block", "size", "digest"))):
                if key != (mine, number) or tree is None:
                    if tree is not None:
                        waiting += finished()
                    tree, key, size = Appender(fan), (mine, number), n
                tree.append(digest)
            yield from out()
        if tree is not None:
            waiting += finished()
            yield from out()

    return dealt.mapInArrow(run, schema).drop("block")


@dataclass
class Manifest:
    """Tables of nodes with witness and above, from the leaves up to the sources' roots; and
    the same of the tree over these roots."""

    levels: list[DataFrame]
    tops: list[DataFrame]
    fan: int
    block_levels: int


def climbed(nodes, fan, levels, kept=None):
    """Tables of nodes from ``nodes`` up to one root per tree.

    ``kept`` holds the tables of an earlier state; ``nodes`` are then what was appended.
    Nodes of blocks that the change does not reach stay as they are.
    """
    block, tables, at = fan ** levels, [], 0
    while True:
        if kept is not None and at < len(kept):
            changed = nodes.groupBy(F.col("tree").alias("c_tree")).agg(
                F.min("pos").alias("from"), F.max("size").alias("c_size"))
            changed = materialize(changed, "merkle-changed")
            met = kept[at].join(few(changed), F.col("tree").eqNullSafe(F.col("c_tree")), "left")
            untouched = F.col("from").isNull() | (
                F.expr("pos div {0}".format(block)) < F.expr("`from` div {0}".format(block)))
            still = met.filter(untouched).withColumn("size", F.coalesce("c_size", "size")).drop(
                "c_tree", "from", "c_size")
            again = met.filter(~untouched & (F.col("pos") < F.col("from"))).withColumn(
                "size", F.col("c_size")).drop("c_tree", "from", "c_size", "witness", "above")
            made = still.unionByName(streamed(again.unionByName(nodes), fan, levels))
        else:
            still, made = None, streamed(nodes, fan, levels)
        tables.append(materialize(made, "merkle-level"))
        top = tables[-1]
        if top.isEmpty() or top.agg(F.max("size")).first()[0] == 1:
            return tables
        roots = top.filter("above is not null").select(
            "tree", F.expr(f"pos div {block}").alias("pos"),
            F.expr(f"(size + {block - 1}) div {block}").alias("size"),
            F.col("above").alias("digest"))
        if still is not None and at + 1 < len(kept):
            old = kept[at + 1].select(F.col("tree").alias("o_tree"), F.col("pos").alias("o_pos"),
                                      F.col("digest").alias("o_digest"))
            roots = roots.join(old, F.col("tree").eqNullSafe(F.col("o_tree"))
                               & (F.col("pos") == F.col("o_pos")), "left").filter(
                "o_digest is null or o_digest <> digest").drop("o_tree", "o_pos", "o_digest")
            roots = materialize(roots, "merkle-roots")
        nodes, at = roots, at + 1


def topped(levels, fan, block_levels):
    """The tree over the roots of all sources, anew: one node per source."""
    roots = levels[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "digest")
    return climbed(numbered(roots, ["source"]).select(*NODE, "source"), fan, block_levels)


def leaves(docs, id_col, source, fields, carried):
    return docs.select(
        quoted(source).cast("string").alias("tree"), quoted(id_col).alias("id"),
        leaf([quoted(c) for c in fields]).alias("digest"),
        *[made.alias(name) for name, made in carried.items()])


def manifest(docs, id_col="doc_id", source="source", fields=FIELDS, carried=None, fan=FAN,
             block_levels=LEVELS):
    """The manifest of all rows. ``carried`` names expressions to keep beside every leaf."""
    carried = carried or {}
    nodes = numbered(leaves(docs, id_col, source, fields, carried), ["id", "digest"])
    levels = climbed(nodes.select(*NODE, "id", *carried), fan, block_levels)
    return Manifest(levels, topped(levels, fan, block_levels), fan, block_levels)


def append(state, docs, id_col="doc_id", source="source", fields=FIELDS, carried=None):
    """``state`` with further rows, whose ids are all above those of their source so far."""
    carried = carried or {}
    new = numbered(leaves(docs, id_col, source, fields, carried), ["id", "digest"])
    sizes = state.levels[0].groupBy(F.col("tree").alias("s_tree")).agg(
        F.max("size").alias("had"))
    new = new.join(few(materialize(sizes, "merkle-sizes")),
                   F.col("tree").eqNullSafe(F.col("s_tree")), "left")
    had = F.coalesce("had", F.lit(0))
    new = materialize(new.withColumn("pos", F.col("pos") + had).withColumn(
        "size", F.col("size") + had).select(*NODE, "id", *carried), "merkle-new")
    if new.isEmpty():
        return state
    levels = climbed(new, state.fan, state.block_levels, state.levels)
    return Manifest(levels, topped(levels, state.fan, state.block_levels), state.fan,
                    state.block_levels)


def extended(levels, block, upper):
    """The lowest table with whole witnesses. ``upper`` has (tree, witness, and more) per tree."""
    more = [c for c in upper.columns if c not in ("tree", "pos", "witness")]
    upper = upper.withColumn("pos", F.lit(0).cast("long"))
    for table in reversed(levels):
        up = materialize(upper, "merkle-witnesses").select(
            F.col("tree").alias("u_tree"), F.col("pos").alias("u_pos"),
            F.col("witness").alias("further"), *more)
        same = F.col("tree").eqNullSafe(F.col("u_tree")) & (
            F.expr(f"pos div {block}") == F.col("u_pos"))
        upper = table.join(few(up, 20_000), same).withColumn(
            "witness", F.concat("witness", "further")).drop("u_tree", "u_pos", "further", "above")
    return upper


def proofs(state):
    """Every leaf with source, id, digest, pos and size in its source, the source's place and
    the number of sources, subroot, root, and its whole witness up to the root."""
    block = state.fan ** state.block_levels
    top = state.tops[-1].select("tree", F.lit(b"").alias("witness"), F.col("above").alias("root"))
    sources = extended(state.tops, block, top).select(
        F.col("source").alias("tree"), "witness", F.col("pos").alias("source_pos"),
        F.col("size").alias("sources"), F.col("digest").alias("subroot"), "root")
    return extended(state.levels, block, sources).withColumnRenamed("tree", "source")


def checked(proven, claimed, fan=FAN):
    """``proven`` with the root that follows from the digest in column ``claimed``, as
    ``folded``, and the digest of the witness as ``proof``."""
    schema = T.StructType([*proven.schema.fields, T.StructField("folded", T.BinaryType()),
                           T.StructField("proof", T.BinaryType())])

    def run(batches):
        for batch in batches:
            folded, proof = [], []
            for digest, witness, pos, size, place, count in zip(*(
                    batch.column(c).to_pylist() for c in (
                        claimed, "witness", "pos", "size", "source_pos", "sources"))):
                root, used = fold(digest, witness, pos, size, fan)
                folded.append(fold(root, witness[used:], place, count, fan)[0])
                proof.append(hashlib.sha256(witness.hex().encode()).digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(folded, pa.binary()), pa.array(proof, pa.binary())],
                names=schema.names)

    return proven.mapInArrow(run, schema)


def tampering(docs, id_col="doc_id", text="text", fields=FIELDS):
    """Leaf of a row after its line breaks are deleted where 2 divides the id's crc32."""
    even = F.crc32(quoted(id_col).cast("string")) % 2 == 0
    spoiled = F.when(even, F.replace(quoted(text), F.lit("\n"), F.lit(""))).otherwise(quoted(text))
    return leaf([spoiled if c == text else quoted(c) for c in fields])


def tamper_report(docs, id_col="doc_id"):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    state = manifest(docs, id_col, carried={"tampered": tampering(docs, id_col)})
    made = checked(proofs(state), "tampered")

    def shown(name):
        return F.lower(F.hex(F.col(name)))

    return made.select(
        F.col("id").alias("doc_id"), shown("digest").alias("leaf"),
        shown("subroot").alias("subroot"), shown("root").alias("root"),
        shown("proof").alias("proof_sha256"), shown("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


#: crc32 of a text in SQL: for each character's code and eight shifts, one step of the division.
CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
  string_split({0}, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
            ELSE a >> 1 END), 4294967295::bigint)"""


def oracle(depth=12, source_depth=6):
    """SQL for ``tamper_report`` of tables with at most 3^depth rows a source."""
    def shown(value):
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf_of(text):
        return "sha256(" + " || ".join(shown(v) for v in (
            "doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    def tree(name, levels, key, start):
        """Nodes of each level, with the siblings left and right."""
        parts = []
        before = start
        for j in range(levels):
            run = f"PARTITION BY {key}, pos // 3 ORDER BY pos ROWS BETWEEN"
            parts.append(f"""{name}{j} AS (
  SELECT {key}, pos, size, digest,
    coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM ({before}))""")
            before = f"""SELECT {key}, pos // 3 AS pos, (any_value(size) + 2) // 3 AS size,
    CASE WHEN any_value(size) = 1 THEN any_value(digest)
         ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}{j} GROUP BY {key}, pos // 3"""
        parts.append(f"{name}_top AS ({before})")
        return parts

    steps = [f"""leaves AS (
  SELECT doc_id, source, {leaf_of('text')} AS leaf,
    CASE WHEN coalesce({CRC32.format('doc_id::varchar')} % 2 = 0, false)
         THEN {leaf_of("replace(text, chr(10), '')")} ELSE {leaf_of('text')} END AS tampered
  FROM documents)""", """placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS size FROM leaves)"""]
    steps += tree("n", depth, "source", "SELECT source, pos, size, leaf AS digest FROM placed")
    steps.append("""subroots AS (
  SELECT 0 AS one, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS size FROM n_top)""")
    steps += tree("s", source_depth, "one", "SELECT one, pos, size, digest FROM subroots")
    steps.append("""w0 AS (SELECT p.*, '' AS proof, tampered AS folded FROM placed p)""")
    for j in range(depth):
        steps.append(f"""w{j + 1} AS (
  SELECT w.doc_id, w.source, w.leaf, w.pos, w.proof || n.l || n.r AS proof,
    CASE WHEN n.size = 1 THEN folded ELSE sha256(n.l || folded || n.r) END AS folded
  FROM w{j} w JOIN n{j} n ON w.source IS NOT DISTINCT FROM n.source
    AND w.pos // {3 ** j} = n.pos)""")
    steps.append(f"""v0 AS (
  SELECT w.doc_id, w.leaf, w.proof, w.folded, r.digest AS subroot, r.pos
  FROM w{depth} w JOIN subroots r ON w.source IS NOT DISTINCT FROM r.source)""")
    for j in range(source_depth):
        steps.append(f"""v{j + 1} AS (
  SELECT v.doc_id, v.leaf, v.subroot, v.pos, v.proof || s.l || s.r AS proof,
    CASE WHEN s.size = 1 THEN folded ELSE sha256(s.l || folded || s.r) END AS folded
  FROM v{j} v JOIN s{j} s ON v.pos // {3 ** j} = s.pos)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = digest AS verified
FROM v{source_depth}, s_top"""


ORACLE = oracle()
