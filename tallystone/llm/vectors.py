"""Near-duplicate vectors by range search on a flat graph of pruned neighbours.

Equal vectors of a label are one node. Nodes go to their ``OVERLAP`` nearest centroids
(k-means on a bounded sample, for each length that needs several shards), and each label and centroid is a shard; shards too large for
one task are cut into blocks by hash. In each block nodes are inserted batch by batch: a greedy
search from the medoid through the graph so far meets candidates, of which robust pruning
leaves the node's neighbours; a few random ones and edges back are added. What the medoid
cannot reach is tied to its nearest node that it can. A node's lists from all its shards are
united. Then every block, and every pair of blocks of a cut-up shard, is searched: from the
medoids a beam of nodes moves greedily towards each node's own vector, and from all that came
near the search spreads along edges for as long as it meets nodes near enough. What it meets
is compared in double precision; only pairs at or above the threshold are links.

A pair that meets in several shards counts in the lowest one. A task returns each node's
number of links and one link that ties it to its group, not the pairs. ``audit`` measures
recall against comparing a sample of vectors with all others.

Defined cases: a null label links with nothing, and so do vectors that are null, zero, or
hold null or non-finite components; vectors of different lengths do not link; rows repeated
whole are equal vectors and link; a null id takes part and has itself as component only if no
row with an id is linked; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from .common import materialize, quoted, spread_sample
from .components import connected

#: Vectors that centroids are fitted on; rows of a shard; centroids at most.
SAMPLE, SHARD, CENTROIDS = 20_000, 1000, 1024
#: A block holds more than a shard has with overlap, so only uneven shards are cut.
BLOCK, OVERLAP = 4000, 2
NEAREST, KEPT, RANDOM, BACK, ALPHA = 32, 16, 6, 16, 1.2
#: Queries searched together; links followed together while a search spreads.
BEAM, SLACK, TOGETHER, FRONT = 24, 0.02, 256, 50_000


def unit(vectors):
    vectors = np.asarray(vectors, np.float64)
    # scaled first, so squares of very large or small components stay finite
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def matrix(column):
    """Rows of a list column, all of one length."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(
        column, pa.ChunkedArray) else column.flatten()
    return unit(flat.to_numpy(zero_copy_only=False).reshape(len(column), -1))


def centroids(sample, k, rounds=12):
    """Spherical k-means."""
    k = min(k, len(sample))
    chosen = sample[np.random.default_rng(0).permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        nearest = (sample @ chosen.T).argmax(axis=1)
        total = np.zeros_like(chosen)
        np.add.at(total, nearest, sample)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        chosen = np.where(length > 0, total / np.maximum(length, 1e-300), chosen)
    return chosen


def pruned(near, node, others, most):
    """Robust pruning for all nodes at once; -1 pads.

    ``node`` has the distances of the candidates ``near`` in rising order, ``others`` those
    between candidates. A kept candidate drops all that are nearer to it than, by ALPHA, to
    the node.
    """
    alive = np.isfinite(node)
    made = np.full((len(near), most), -1)
    rows = np.arange(len(near))
    for r in range(most):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        made[some, r] = near[rows, first][some]
        alive &= ALPHA * others[rows, first] > node
        alive[rows, first] = False
        if not alive.any():
            break
    return made


def build(x, seed=0):
    """Neighbour lists (row: node, -1 pads) of a block and its medoid."""
    n = len(x)
    rng = np.random.default_rng(seed)
    medoid = int(np.argmax(x @ x.sum(axis=0)))
    own = KEPT + RANDOM
    made, gaps = np.full((n, own + BACK), -1), np.full((n, BACK), np.inf)
    turn = rng.permutation(n)
    turn = np.concatenate([[medoid], turn[turn != medoid]])
    done = 0
    while done < n and n > 1:
        new = turn[done:done + min(TOGETHER, max(done, NEAREST))]
        met = search(x, made, [medoid], new, 2.0) if done else np.full((len(new), n), -2.0)
        met[:, new] = x[new] @ x[new].T
        met[np.arange(len(new)), new] = -2
        done += len(new)
        near = np.argpartition(-met, min(NEAREST, n) - 1, axis=1)[:, :NEAREST]
        value = np.take_along_axis(met, near, axis=1)
        order = np.argsort(-value, axis=1)
        near, value = (np.take_along_axis(y, order, axis=1) for y in (near, value))
        gap = np.where(value > -2, np.sqrt(np.maximum(0, 2 - 2 * value)), np.inf)
        between = np.sqrt(np.maximum(0, 2 - 2 * (x[near] @ x[near].transpose(0, 2, 1))))
        made[new, :KEPT] = pruned(near, gap, between, KEPT)
        far = turn[rng.integers(0, done, (len(new), RANDOM))]
        made[new, KEPT:own] = np.where(far == new[:, None], medoid, far)
        # edges back, the nearest first, up to a limit per node
        a, b = np.repeat(new, own), made[new, :own].ravel()
        a, b = a[(b >= 0) & (a != b)], b[(b >= 0) & (a != b)]
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", x[a], x[b])))
        ends, b = np.unique(b, return_inverse=True)
        a = np.concatenate([made[ends, own:].ravel(), a])
        b = np.concatenate([np.repeat(np.arange(len(ends)), BACK), b])
        gap = np.concatenate([gaps[ends].ravel(), gap])
        order = np.lexsort((gap, b))
        a, b, gap = a[order], b[order], gap[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        a, b, gap, rank = (y[rank < BACK] for y in (a, b, gap, rank))
        made[ends[b], own + rank], gaps[ends[b], rank] = a, gap
    reached = np.zeros(n, bool)
    front = np.array([medoid])
    ties = []
    while True:
        while len(front):
            reached[front] = True
            ahead = made[front].ravel()
            front = np.unique(ahead[(ahead >= 0) & ~reached[np.maximum(ahead, 0)]])
        lost = np.flatnonzero(~reached)
        if not len(lost):
            break
        inside, lost = np.flatnonzero(reached), lost[:TOGETHER]
        nearest = x[inside] @ x[lost].T
        at = np.unravel_index(nearest.argmax(), nearest.shape)
        ties.append((inside[at[0]], lost[at[1]]))
        front = np.array([lost[at[1]]])
    if ties:
        extra = np.full((n, 1 + max(np.bincount([a for a, _ in ties]))), -1)
        used = np.zeros(n, int)
        for a, b in ties:
            extra[a, used[a]] = b
            used[a] += 1
        made = np.concatenate([made, extra], axis=1)
    return made, medoid


def search(x, lists, entries, queries, reach):
    """Cosines (query, node) of all nodes that a search for each query met; -2: not met."""
    n, q = len(x), len(queries)
    rows = np.arange(q)[:, None]
    met = np.full((q, n), -2.0)
    targets = x[queries]
    entry = np.tile(np.asarray(entries), (q, 1))
    met[rows, entry] = targets @ x[np.asarray(entries)].T
    done = np.zeros((q, n), bool)
    beam = entry
    while True:
        value = np.take_along_axis(met, beam, axis=1)
        value = np.where(np.take_along_axis(done, beam, axis=1), -3.0, value)
        best = value.argmax(axis=1)
        active = np.flatnonzero(value[rows[:, 0], best] > -3)
        if not len(active):
            break
        node = beam[active, best[active]]
        done[active, node] = True
        ahead = lists[node]
        line, place = np.nonzero((ahead >= 0) & (met[active[:, None], np.maximum(ahead, 0)] == -2))
        who, what = active[line], ahead[line, place]
        met[who, what] = np.einsum("ij,ij->i", targets[who], x[what])
        both = np.concatenate([beam, np.full((q, ahead.shape[1]), -1)], axis=1)
        both[who, beam.shape[1] + place] = what
        value = np.where(both >= 0, met[rows, np.maximum(both, 0)], -4.0)
        if both.shape[1] > BEAM:
            keep = np.argpartition(-value, BEAM - 1, axis=1)[:, :BEAM]
            beam = np.take_along_axis(both, keep, axis=1)
            short = np.take_along_axis(value, keep, axis=1) == -4
            # a padded place holds the query's best node again, which is expanded by then
            top = both[rows[:, 0], value.argmax(axis=1)][:, None]
            beam = np.where(short, top, beam)
        else:
            beam = np.where(both >= 0, both, both[:, :1])
    flat, (who, what) = met.ravel(), np.nonzero(met >= reach)
    while len(who):
        spread = [np.empty(0, np.int64)]
        for start in range(0, len(who), FRONT):
            ahead = lists[what[start:start + FRONT]]
            code = (who[start:start + FRONT, None] * n + ahead)[ahead >= 0]
            code = np.unique(code[flat[code] == -2])
            flat[code] = np.einsum("ij,ij->i", targets[code // n], x[code % n])
            spread.append(code[flat[code] >= reach])
        code = np.concatenate(spread)
        who, what = code // n, code % n
    return met


def lowest(labels, a, b):
    """Spread the lowest label along links until nothing changes."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        labels = labels[labels]
        if np.array_equal(before, labels):
            break
    return labels


def usable(vector):
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda v: v != 0)


def in_blocks(nodes):
    """Shards of nodes with the number of blocks and the node's own block."""
    sizes = materialize(nodes.groupBy("label", "size", "shard").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "vector-shards")
    return nodes.join(sizes, ["label", "size", "shard"]).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))


def linked_nodes(nodes, threshold):
    """Per node and task: (node, links, root), from a table of nodes and their vectors."""
    spark = nodes.sparkSession
    found = nodes.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"))
    # lengths whose labels fill more than a shard have centroids of their own
    wide = found.filter(F.col("n") > F.col("labels") * SHARD).collect()
    fitted = {}
    for r in sorted(wide):
        sample = spread_sample(nodes.filter(F.col("size") == r["size"]).select("node", "vector"),
                               [F.col("node")], SAMPLE, 3).collect()
        k = min(CENTROIDS, -(-r["n"] // (r["labels"] * SHARD)))
        fitted[r["size"]] = centroids(unit([x["vector"] for x in sample]), k)
    centers = spark.sparkContext.broadcast(fitted)

    def assign(batches):
        for batch in batches:
            vectors = batch.column("vector")
            sizes = batch.column("size").to_numpy()
            shards = [[0]] * len(vectors)
            for size in np.intersect1d(sizes, list(centers.value)).tolist():
                fit = np.flatnonzero(sizes == size)
                nearness = matrix(vectors.take(pa.array(fit))) @ centers.value[size].T
                top = np.argsort(-nearness, axis=1, kind="stable")[:, :OVERLAP]
                for i, t in zip(fit, top):
                    shards[i] = sorted(t.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "shards"])

    schema = T.StructType([*nodes.schema.fields,
                           T.StructField("shards", T.ArrayType(T.IntegerType()))])
    placed = materialize(nodes.mapInArrow(assign, schema), "vector-places")
    spread = materialize(in_blocks(placed.withColumn("shard", F.explode("shards"))),
                         "vector-blocks")
    key = ["label", "size", "shard", "block"]

    def grow(table: pa.Table) -> pa.Table:
        lists, _ = build(matrix(table.column("vector")))
        ids = table.column("node").to_numpy()
        return pa.table([pa.array(ids), pa.array(
            [ids[row[row >= 0]] for row in lists], pa.list_(pa.int64()))], names=["node", "near"])

    graph = spread.select(*key, "node", "vector").groupBy(*key).applyInArrow(
        grow, "node long, near array<long>")
    united = materialize(graph.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "vector-graph")
    tasks = spread.join(united, "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def find(table: pa.Table) -> pa.Table:
        ids = table.column("node").to_numpy()
        x, block = matrix(table.column("vector")), table.column("block").to_numpy()
        weight, shard = table.column("copies").to_numpy(), table.column("shard")[0].as_py()
        order = np.argsort(ids)
        near = table.column("near").to_pylist()
        lengths = np.fromiter(map(len, near), np.int64, len(near))
        flat = np.concatenate([np.asarray(v, np.int64) for v in near]) if len(near) else ids[:0]
        at = np.minimum(np.searchsorted(ids[order], flat), len(ids) - 1)
        here = ids[order][at] == flat
        row = np.repeat(np.arange(len(ids)), lengths)[here]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        lists = np.full((len(ids), int(place.max(initial=0)) + 1), -1)
        lists[row, place] = order[at[here]]
        entries = [int(own[np.argmax(x[own] @ x[own].sum(axis=0))])
                   for own in (np.flatnonzero(block == b) for b in np.unique(block))]
        cross = block.min() != block.max()
        table_shards = table.column("shards").to_pylist()
        homes = np.full((len(ids), OVERLAP), -1)
        for i, own in enumerate(table_shards):
            homes[i, :len(own)] = own
        pairs = np.zeros((len(ids), len(ids)), bool)
        for start in range(0, len(ids), TOGETHER):
            queries = np.arange(start, min(start + TOGETHER, len(ids)))
            pairs[queries] = search(x, lists, entries, queries, threshold - SLACK) >= threshold
        pairs |= pairs.T
        links, ties = np.zeros(len(ids)), [np.empty((2, 0), np.int64)]
        for start in range(0, len(ids), TOGETHER):
            a, b = np.nonzero(pairs[start:start + TOGETHER])
            a += start
            a, b = a[a < b], b[a < b]
            # the lowest shard that both belong to counts the pair
            common = np.where((homes[a][:, :, None] == homes[b][:, None, :])
                              & (homes[a][:, :, None] >= 0), homes[a][:, :, None], 1 << 30)
            mine = common.min(axis=(1, 2), initial=1 << 30) == shard
            if cross:
                mine &= block[a] != block[b]
            a, b = a[mine], b[mine]
            links += np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
            # of a portion's links only those that tie its groups together are kept
            low = lowest(np.arange(len(ids)), a, b)
            tied = np.flatnonzero(low != np.arange(len(ids)))
            ties.append(np.array([tied, low[tied]]))
        roots = lowest(np.arange(len(ids)), *np.concatenate(ties, axis=1))
        kept = np.flatnonzero(links > 0)
        return pa.table([pa.array(ids[kept]), pa.array(links[kept].astype(np.int64)),
                         pa.array(ids[roots[kept]])], names=["node", "links", "root"])

    return materialize(tasks.groupBy("label", "size", "shard", "low", "high").applyInArrow(
        find, "node long, links long, root long"), "vector-links")


def near_duplicates(table, id_col="vec_id", vector="embedding", label="label", threshold=0.98):
    """vec_id, n_links, component_id and kept of every row."""
    rows = table.select(quoted(id_col).alias("vec_id"), quoted(label).alias("label"),
                        quoted(vector).alias("vector"))
    good = F.coalesce(usable(F.col("vector")) & F.col("label").isNotNull(), F.lit(False))
    rows = materialize(rows.select(
        "vec_id", "label", F.when(good, F.col("vector")).alias("vector"),
        F.size("vector").alias("size")), "vectors")
    sound = rows.filter("vector is not null")
    nodes = sound.groupBy("label", "size", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    found = linked_nodes(nodes.select("node", "label", "size", "vector", "copies"), threshold)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    told = nodes.join(counts, "node", "left").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = told.groupBy("component").agg(F.min("first").alias("component_id"))
    told = materialize(told.join(least, "component").select(
        F.col("label").alias("l"), F.col("vector").alias("v"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-groups")
    same = (F.xxhash64("label", "vector") == F.xxhash64("l", "v")) & (
        F.col("label") == F.col("l")) & (F.col("vector") == F.col("v"))
    linked = sound.join(told, same).select("vec_id", "n_links", "component_id")
    alone = rows.filter("vector is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def audit(table, result, id_col="vec_id", vector="embedding", label="label", threshold=0.98,
          queries=200):
    """Share of the links of at most ``queries`` vectors, compared with all rows, that
    ``result`` has; 1.0 if they have none. Ids must be unique."""
    good = usable(quoted(vector)) & quoted(label).isNotNull()
    rows = table.filter(good).select(quoted(id_col).alias("id"), quoted(label).alias("label"),
                                     quoted(vector).alias("vector"))
    asked = spread_sample(rows, [F.col("id")], queries, 9).collect()
    if not asked:
        return 1.0
    targets = [(r["id"], r["label"], unit([r["vector"]])[0]) for r in asked]

    def compare(batches):
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), object)
            ids = np.array(batch.column("id").to_pylist(), object)
            vectors = batch.column("vector").to_pylist()
            x = unit(vectors) if len({len(v) for v in vectors}) == 1 else None
            total = []
            for name, own, y in targets:
                if x is not None:
                    near = x @ y >= threshold if x.shape[1] == len(y) else np.zeros(len(ids), bool)
                else:
                    near = np.array([len(v) == len(y) and unit([v])[0] @ y >= threshold
                                     for v in vectors])
                total.append(int((near & (labels == own) & (ids != name)).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(t[0]) for t in targets]), pa.array(total, pa.int64())],
                names=["id", "n"])

    true = rows.mapInArrow(compare, "id string, n long").groupBy("id").agg(F.sum("n").alias("n"))
    got = result.select(F.col("vec_id").cast("string").alias("id"), "n_links")
    sums = true.join(got, "id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
    return 1.0 if not sums[0] else sums[1] / sums[0]
