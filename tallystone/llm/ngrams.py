"""Score texts with an n-gram language model, as a weighted automaton with failure arcs.

The model counts the n-grams of all training texts and smooths each order towards the one
below: P(w | h) = (c(hw) + m P(w | h')) / (c(h) + m), where h' is h less its first word; single
tokens are discounted by ``DISCOUNT`` in favour of one more, unknown token. A history of
several tokens counts as a context from ``LEAST`` occurrences on; below that h' takes its
place, so probabilities still sum to one. As an automaton: every context is a state; every
counted continuation an arc with its log probability and the state of the longest context it
leads to; a failure arc leads to the state of h' at the cost of m / (c(h) + m). A text is
traversed once from left to right, carrying the state.

No task holds the whole model. Texts are encoded in blocks of about ``BLOCK`` tokens. Each
block sends its distinct n-grams with their training counts out by hash range; there they
are added up over all blocks, and every block gets the totals of the n-grams it asked for:
the part of the automaton that its own texts can reach. Single tokens and pairs go first;
of longer n-grams only those are asked for whose context has proved frequent enough. So
memory follows the block, and the counts follow the corpus. N-grams travel as 64-bit hashes.
A task takes about ``PER_TASK`` blocks or hash ranges, one after the other, so that files and
sort buffers are fewer. Places in a block are 32-bit numbers, and a step keeps only the hashes
and counts that it sends.
A text longer than ``BLOCK`` makes a longer block of its own.

Defined cases: a null or wordless text is its end token alone; rows repeated whole all count
and are all scored; a null id is trained on and not held out; with nothing to learn from
base_score and score are null; an empty table gives an empty result.
"""

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F, types as T

from .common import as_bytes, crc_bucket, materialize, quoted
from .tokens import Places

BLOCK = 600_000
KEYS_PER_TASK = 1_000_000
PER_TASK = 4
ORDER, LEAST, WEIGHT, DISCOUNT = 3, 2, 100.0, 0.75


def planes(values):
    """Packed bytes of an array, all first bytes first, then all second ones."""
    data = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(data.T.tobytes(), 1)


def from_planes(data, kind):
    size = np.dtype(kind).itemsize
    data = np.frombuffer(zstandard.decompress(data), np.uint8)
    return data.reshape(size, -1).T.copy().view(kind).ravel()


def encode(given, id_type):
    """Blocks of texts: ids, training flags, lengths in words, word numbers, word hashes.

    Number 0 is the end token; it ends every text and is not stored.
    """
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("train", T.ArrayType(T.BooleanType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("tokens", T.LongType()),
        T.StructField("words", T.BinaryType()), T.StructField("hashes", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 24
        places, texts, ids, train, number = Places(), [], [], [], 0
        places[b""] = 0

        def block():
            lengths = [len(x) for x in texts]
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, places), np.uint64, len(places))
            words = np.concatenate(texts) if texts else np.empty(0, np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array([first + number]),
                pa.ListArray.from_arrays([0, len(texts)], pa.concat_arrays(ids)),
                pa.array([train], pa.list_(pa.bool_())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([sum(lengths) + len(texts)]),
                pa.array([planes(words)], pa.binary()), pa.array([planes(hashes)], pa.binary()),
            ], names=[f.name for f in schema])

        count = 0
        for batch in batches:
            flags = batch.column(1).to_pylist()
            for i, text in enumerate(as_bytes(batch.column(2))):
                words = (text or b"").lower().split()
                texts.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
                ids.append(batch.column(0).slice(i, 1))
                train.append(flags[i])
                count += len(words) + 1
                if count >= BLOCK:
                    yield block()
                    number += 1
                    places, texts, ids, train, count = Places(), [], [], [], 0
                    places[b""] = 0
        if texts:
            yield block()

    return materialize(given.mapInArrow(run, schema), "lm-blocks")


def distinct_keys(keys):
    """Sorted distinct keys, a position of each, and each position's place among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    ranked = ranked[new]
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    at = np.empty(len(keys), np.int32)
    at[order] = number
    return ranked, order[new].astype(np.int32), at


class Grams:
    """The n-grams of a block by order, each position's n-gram being the one that ends there.

    A text is preceded by an end token, which is a context and not itself counted. Hashes and
    training counts stay for the orders in ``kept`` only.
    """

    def __init__(self, lengths, train, words, hashes, order, kept):
        lengths = np.asarray(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 2)])
        size = int(self.starts[-1])
        self.sequence = np.zeros(size, np.int32)
        inside = np.ones(size, bool)
        inside[self.starts[:-1]] = False
        inside[self.starts[1:] - 1] = False
        self.sequence[inside] = words
        self.counted = np.ones(size, bool)
        self.counted[self.starts[:-1]] = False
        learned = np.repeat(np.asarray(train, bool), lengths + 2)
        offset = np.arange(size, dtype=np.int32)
        offset -= np.repeat(self.starts[:-1].astype(np.int32), lengths + 2)
        self.width = len(hashes)
        key = hashes[self.sequence]
        self.keys, self.at, self.train, self.sample = {}, [], {}, []
        for k in range(1, order + 1):
            if k > 1:
                key = np.concatenate([key[:1], key[:-1]])
                key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                key = (key + hashes[self.sequence]) * np.uint64(0x94D049BB133111EB)
                key ^= key >> np.uint64(31)
            # an n-gram does not reach into the text before; the mark at the start is one itself
            valid = offset >= k - 1
            where = np.flatnonzero(valid)
            place = np.full(size, -1, np.int32)
            if k == 1:
                # every word of the block occurs, so its words are sorted and not its positions
                found, spot, rank = distinct_keys(hashes)
                last = np.zeros(self.width, np.int32)
                last[self.sequence] = where
                sample, place = last[spot], rank[self.sequence]
            else:
                found, sample, place[where] = distinct_keys(key[where])
                sample = where[sample].astype(np.int32)
            self.at.append(place)
            self.sample.append(sample)
            if k in kept:
                told = learned & valid & self.counted
                self.keys[k] = found
                self.train[k] = np.bincount(place[told], minlength=len(found)).astype(np.int32)


def edges(keys, ranges):
    """Where sorted hashes pass from one hash range to the next."""
    bounds = (np.arange(1, ranges, dtype=np.float64) * (2.0 ** 64 / ranges)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def rows_of(batch):
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def grams_of(row, order, kept=()):
    return Grams(row["lengths"], row["train"], from_planes(row["words"], np.int32),
                 from_planes(row["hashes"], np.uint64), order, kept)


def asked(keys, counts, order, ranges, block):
    """Sorted hashes of n-grams of one order, with the block's own counts, by hash range."""
    parts = [(r, a, b) for r, (a, b) in enumerate(pairwise(edges(keys, ranges))) if b > a]
    gaps = [np.diff(keys[a:b], prepend=np.uint64(0)) for _, a, b in parts]
    return pa.table([
        pa.array([(order - 1) * ranges + r for r, _, _ in parts], pa.int64()),
        pa.array([block] * len(parts), pa.int64()),
        pa.array([planes(g) for g in gaps], pa.binary()),
        pa.array([planes(counts[a:b]) for _, a, b in parts], pa.binary()),
    ], names=["place", "block", "keys", "counts"])


def added(ranges):
    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(x, np.uint64), dtype=np.uint64)
                for x in table.column("keys").to_pylist()]
        counts = np.concatenate([from_planes(x, np.int32)
                                 for x in table.column("counts").to_pylist()])
        at = distinct_keys(np.concatenate(keys))[2]
        total = np.bincount(at, counts).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        answer = total[at]
        told = [planes(answer[a:b]) for a, b in pairwise(cuts)]
        # the first row of a range of single tokens bears how many there are, and how many differ
        size, single = len(told), key[0].as_py() < ranges
        tokens = [int(counts.sum()) if single else None] + [None] * (size - 1)
        distinct = [int((total > 0).sum()) if single else None] + [None] * (size - 1)
        return pa.table([
            pa.array([key[0].as_py()] * size, pa.int64()), table.column("block"),
            pa.array(told, pa.binary()), pa.array(tokens, pa.int64()),
            pa.array(distinct, pa.int64())],
            names=["place", "block", "totals", "tokens", "distinct"])

    return add


def wanted(grams, counts, order, least):
    """Which n-grams of an order can be arcs, given the totals of the order below."""
    if order <= 2:
        return np.ones(len(grams.sample[order - 1]), bool)
    return counts[order - 2][grams.at[order - 2][grams.sample[order - 1] - 1]] >= least


def told(grams, answer, order, least):
    """Totals of each order up to ``order``; of n-grams that were not asked for, 0."""
    ranges = iter(answer.sort_by("place").column("totals"))
    counts = []
    for k in range(1, order + 1):
        at = np.flatnonzero(wanted(grams, counts, k, least))
        total = np.zeros(len(grams.sample[k - 1]), np.int64)
        while len(at):
            # a range holds n-grams of one order
            part = from_planes(next(ranges).as_py(), np.int64)
            total[at[:len(part)]] = part
            at = at[len(part):]
        counts.append(total)
    return counts


def totals(blocks, tokens, order, least):
    """Counts over all training texts of every n-gram, per asking block and hash range.

    Single tokens and pairs are asked for at once, each longer order when the one below it is
    known. ``tokens`` and ``distinct`` add up to the number of counted tokens and of different ones.
    """
    ranges = max(1, -(-tokens // KEYS_PER_TASK))
    form = "place long, block long, keys binary, counts binary"

    def ask(batches):
        for batch in batches:
            for row in rows_of(batch):
                first = min(order, 2)
                grams = grams_of(row, first, range(1, first + 1))
                for k in range(1, first + 1):
                    yield from asked(grams.keys.pop(k), grams.train.pop(k), k, ranges,
                                     row["block"]).to_batches()

    def sums(asked_for):
        # tasks in proportion to the ranges, so a task's share does not grow with the input
        return materialize(dealt(asked_for, "place", ranges).applyInArrow(
            added(ranges), "place long, block long, totals binary, tokens long, distinct long"),
            "lm-totals")

    answers = sums(blocks.select("block", "train", "lengths", "words", "hashes").mapInArrow(
        ask, form))
    for k in range(3, order + 1):
        def ask_longer(key: tuple[pa.Scalar, ...], block: pa.Table, answer: pa.Table) -> pa.Table:
            grams = grams_of(block.to_pylist()[0], k, (k,))
            own = wanted(grams, told(grams, answer, k - 1, least), k, least)
            return asked(grams.keys[k][own], grams.train[k][own], k, ranges, key[0].as_py())

        narrow = blocks.select("block", "train", "lengths", "words", "hashes")
        answers = answers.unionByName(sums(
            by_block(narrow, tokens).cogroup(by_block(answers, tokens)).applyInArrow(
                ask_longer, form)))
    return answers


def dealt(df, name, groups):
    return df.repartition(max(1, -(-groups // PER_TASK)), name).groupBy(name)


def by_block(df, tokens):
    return dealt(df, "block", -(-tokens // BLOCK))


class Automaton:
    """States, arcs and failure arcs that a block's texts can reach.

    State 0 is the empty context. ``key`` of an arc is state * width + word, in order.
    """

    def __init__(self, grams, counts, tokens, distinct, weight, least):
        self.width = grams.width
        order = len(counts)
        lowest = grams.sequence[grams.sample[0]]
        c = counts[0].astype(np.float64)
        spare = DISCOUNT * distinct / tokens / (distinct + 1)
        chance = np.where(c > 0, (c - DISCOUNT) / tokens, 0) + spare
        # states of contexts, and of the longest context that an n-gram ends in
        state_of, longest = [], []
        state = 0
        for k in range(order - 1):
            known = counts[k] >= (least if k else 1)
            number = np.zeros(len(known), np.int64)
            number[known] = state + 1 + np.arange(int(known.sum()))
            state += int(known.sum())
            state_of.append(number)
            longest.append(number if k == 0 else np.where(
                known, number, longest[k - 1][grams.at[k - 1][grams.sample[k]]]))
        self.fail = np.zeros(state + 1, np.int64)
        self.fail_cost = np.zeros(state + 1)
        self.root_cost = np.zeros(self.width)
        self.root_cost[lowest] = np.log10(chance)
        self.root_next = np.zeros(self.width, np.int64)
        if order > 1:
            self.root_next[lowest] = state_of[0]
        arc_key, arc_cost, arc_next = [], [], []
        for k in range(1, order):
            sample = grams.sample[k]
            context = grams.at[k - 1][sample - 1]
            suffix = grams.at[k - 1][sample]
            below = counts[k - 1][context].astype(np.float64)
            known = state_of[k - 1][context] > 0
            seen = known & (counts[k] > 0)
            chance = np.where(known, (counts[k] + weight * chance[suffix]) / (below + weight),
                              chance[suffix])
            word = grams.sequence[sample]
            ahead = longest[k] if k < order - 1 else longest[k - 1][suffix]
            own = (state_of[k - 1][context] * self.width + word)[seen]
            # states of longer contexts have higher numbers, so orders are sorted one by one
            ranked = np.argsort(own)
            arc_key.append(own[ranked])
            arc_cost.append(np.log10(chance[seen])[ranked])
            arc_next.append(ahead[seen][ranked])
            del own, ranked, word, ahead, below, known, seen
            contexts = np.flatnonzero(state_of[k - 1])
            own = state_of[k - 1][contexts]
            total = counts[k - 1][contexts].astype(np.float64)
            self.fail_cost[own] = np.log10(weight / (total + weight))
            if k > 1:
                shorter = grams.at[k - 2][grams.sample[k - 1][contexts]]
                self.fail[own] = state_of[k - 2][shorter]
        self.arc_key = np.concatenate([*arc_key, [np.iinfo(np.int64).max]])
        self.arc_cost = np.concatenate([*arc_cost, np.empty(0)])
        self.arc_next = np.concatenate([*arc_next, np.empty(0, np.int64)])
        self.start = int(self.root_next[0])

    def follow(self, state, word):
        """Log probabilities of ``word`` from ``state``, and the states they lead to."""
        cost = np.zeros(len(state))
        ahead = np.empty(len(state), np.int64)
        open_, at = np.arange(len(state)), state.copy()
        while len(open_):
            root = at == 0
            if root.any():
                here = open_[root]
                cost[here] += self.root_cost[word[here]]
                ahead[here] = self.root_next[word[here]]
                open_, at = open_[~root], at[~root]
            key = at * self.width + word[open_]
            arc = np.searchsorted(self.arc_key, key)
            hit = self.arc_key[arc] == key
            here = open_[hit]
            cost[here] += self.arc_cost[arc[hit]]
            ahead[here] = self.arc_next[arc[hit]]
            open_, at = open_[~hit], at[~hit]
            cost[open_] += self.fail_cost[at]
            at = self.fail[at]
        return cost, ahead


def traverse(automaton, sequence, starts):
    """Log probability of every text, all texts of a block stepping on together."""
    length = np.diff(starts) - 1
    order = np.argsort(-length, kind="stable")
    first, length = starts[:-1][order] + 1, length[order]
    total = np.zeros(len(order))
    state = np.full(len(order), automaton.start, np.int64)
    active = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")
    for step, n in enumerate(active.tolist()):
        cost, state = automaton.follow(state[:n], sequence[first[:n] + step])
        total[:n] += cost
    scores = np.empty(len(order))
    scores[order] = total
    return scores


def scores_of(row, answer, order, tokens, distinct, weight, least):
    """Of a block's texts: lengths in tokens, known tokens, base scores and scores."""
    grams = grams_of(row, order)
    counts = told(grams, answer, order, least)
    single = counts[0][grams.at[0]]
    known = np.add.reduceat(np.where(grams.counted, single > 0, False).astype(np.int64),
                            grams.starts[:-1])
    starts, sequence = grams.starts, grams.sequence
    if not tokens:
        return np.diff(starts) - 1, known, [None] * len(known), [None] * len(known)
    each = np.log10((single + 1) / (tokens + distinct + 1))
    base = np.add.reduceat(np.where(grams.counted, each, 0.0), starts[:-1])
    del single, each
    automaton = Automaton(grams, counts, tokens, distinct, weight, least)
    del grams, counts
    return np.diff(starts) - 1, known, base, traverse(automaton, sequence, starts)


def text_scores(docs, id_col="doc_id", text="text", folds=7, held=2, order=ORDER, weight=WEIGHT,
                least=LEAST):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    bucket = crc_bucket(quoted(id_col), folds)
    given = docs.select(quoted(id_col).alias("doc_id"),
                        F.coalesce(bucket != held, F.lit(True)).alias("train"),
                        quoted(text).cast("string").alias("text"))
    id_field = given.schema["doc_id"]
    blocks = encode(given, id_field.dataType)
    size = blocks.agg(F.sum("tokens")).first()[0] or 0
    answers = totals(blocks, size, order, least)
    tokens, distinct = (x or 0 for x in answers.agg(F.sum("tokens"), F.sum("distinct")).first())
    schema = T.StructType([
        id_field, T.StructField("held_out", T.BooleanType()),
        *[T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")],
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def score(key: tuple[pa.Scalar, ...], block: pa.Table, answer: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        size, known, base, score_ = scores_of(row, answer, order, tokens, distinct, weight, least)
        ids = pa.concat_arrays([c.flatten() for c in block.column("ids").chunks])
        held_out = [not t for t in row["train"]]
        return pa.table([
            ids, pa.array(held_out, pa.bool_()), pa.array(size), pa.array(known),
            pa.array(np.full(len(size), tokens)), pa.array(base, pa.float64()),
            pa.array(score_, pa.float64())], names=[f.name for f in schema])

    return by_block(blocks, size).cogroup(
        by_block(answers.select("place", "block", "totals"), size)).applyInArrow(score, schema)
