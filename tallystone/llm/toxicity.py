"""Toxicity of texts by a string-kernel support vector machine with Nyström landmarks.

The kernel compares two windows by the three-letter subsequences they share, with gaps, if they
span at most ``SPAN`` characters: a subsequence counts ``DECAY`` to the power of its span, so
"i.d.iot" is still close to "idiot". A text is read as one lower-cased sentence in which every
run of white space is one blank, a character like any other. Its windows are the stretches
between blanks and the pairs of neighbouring ones, so phrases are seen across their blank, and
in longer stretches the ``SPAN`` characters from every place on, so a language written without
blanks is seen as well. Letters spelled out one by one are also read as one stretch.

Labels are of whole sentences, so which windows make one toxic has to be found. At first they are
the windows, or in long stretches the runs of ``RUN`` characters, that by counts over the sample
speak for the label. Then the machine is trained on these windows against windows of clean
texts, and for some rounds every toxic text adds the window that the machine values most, chosen
anew each time, while each clean text adds its own highest one. The machine is a linear one
(squared hinge loss) on the Nyström features of kernel values with the landmarks, which are
windows of both kinds. Its value of a window, b + sum over landmarks of beta[m] * K(window, z[m]),
is linear in the window's subsequences, so scoring adds up one weight per subsequence, which
gives the same value; sums over overlapping windows are shared. A text's value is its largest
window's, mapped to a probability by logistic regression on the labelled texts.

Defined cases: a null or empty text has the value of no window at all, a low score; rows
repeated whole are scored alike; null labels are not learned from; without both labels to
learn from every score is 0; an empty table gives an empty result.
"""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F, types as T

from .common import (
    as_bytes, crc_bucket, map_texts, materialize, quoted, spread_sample,
)

SPAN, DECAY, CODES, BLANK, RUN = 10, 0.8, 64, 27, 6
#: Characters of a window between blanks, both blanks included.
LONGEST = 26
#: Bounds of the training sample: labelled texts per class, windows that tell at first, and
#: landmarks. In a round every text gives one window, clean ones three more at the start.
SAMPLE, TELLING, LANDMARKS, ROUNDS = 4000, 4000, 300, 3
#: Characters whose windows are summed in one go.
PORTION = 60_000
#: Hash functions of a signature, and the share of equal values that makes two texts near copies.
FACTORS = np.random.default_rng(9).integers(1 << 62, 1 << 63, 64, np.uint64) | np.uint64(1)
NEAR = 0.8
SPELLED = re.compile(r"(?<!\S)\w(?: \w){2,}(?!\S)")
PAD = np.zeros(SPAN, np.int32)


def stretches(text):
    """Lower-cased stretches of a text (bytes or None) between white space."""
    return text.decode("utf-8", "replace").lower().split() if text else []


def sentence(text):
    """A text (bytes or None) as it is read: one blank before, between and behind stretches."""
    parts = stretches(text)
    if not parts:
        return ""
    plain = " ".join(parts)
    parts += [m[0].replace(" ", "") for m in SPELLED.finditer(plain)]
    return f" {' '.join(parts)} "


def letter_codes(text):
    """Codes 1 to 63 of characters; a to z and the blank have their own."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = 28 + points % 36
    latin = (points >= 97) & (points <= 122)
    codes[latin] = points[latin] - 96
    codes[points == 32] = BLANK
    return codes.astype(np.int32)


def triples(size):
    return [(s, j, k, DECAY ** (k - s + 1)) for s in range(size)
            for k in range(s + 2, min(size, s + SPAN)) for j in range(s + 1, k)]


#: Root of the kernel of a window of so many characters with itself, if none repeats.
NORMS = np.array([1.0 if n < 3 else np.sqrt(sum(w * w for *_, w in triples(n)))
                  for n in range(LONGEST + 1)])
_triples = {}


def subsequences(window):
    """Numbers and normalized weights of the subsequences of one window of codes."""
    size = len(window)
    if size not in _triples:
        _triples[size] = np.array(triples(size)).reshape(-1, 4)
    s, j, k = _triples[size][:, :3].T.astype(np.int64)
    codes = np.asarray(window, np.int64)
    numbers, at = np.unique(codes[s] << 12 | codes[j] << 6 | codes[k], return_inverse=True)
    weights = np.bincount(at, _triples[size][:, 3], len(numbers))
    return numbers, (weights / NORMS[size]).astype(np.float32)


def spread(numbers, weights):
    """The same as a vector over all subsequence numbers."""
    vector = np.zeros(CODES ** 3, np.float32)
    vector[numbers] = weights
    return vector


def windows_of(codes, starts):
    """First places and ends of all windows of sentences that begin at ``starts``, one behind
    the other with ``PAD`` behind each."""
    blanks = np.flatnonzero(codes == BLANK)
    owner = np.searchsorted(starts, blanks, "right")
    found = []
    for step in (1, 2):
        a, b = blanks[:-step], blanks[step:] + 1
        whole = (owner[:-step] == owner[step:]) & (b - a <= LONGEST)
        found.append((a[whole], b[whole]))
    a, b = blanks[:-1] + 1, blanks[1:]
    long = (owner[:-1] == owner[1:]) & (b - a > SPAN)
    count = b[long] - a[long] - SPAN + 1
    inside = np.repeat(a[long], count) + np.arange(count.sum()) - np.repeat(
        np.cumsum(count) - count, count)
    found.append((inside, inside + SPAN))
    return [np.concatenate(x) for x in zip(*found)]


def window_values(codes, starts, ends, weights):
    """Sum of the weights of each window's subsequences, by its norm.

    A window's subsequences are those between any two of its places not too far apart; for each
    distance the sum over a window is a difference of running sums.
    """
    n = len(codes)
    codes = codes.astype(np.intp)
    high, mid = codes << 12, codes << 6
    total = np.zeros(len(starts))
    number, weight = np.empty(n, np.intp), np.empty(n, np.float32)
    for distance in range(2, SPAN):
        wide = n - distance
        inner = np.zeros(wide, np.float32)
        outer = high[:wide] | codes[distance:]
        for j in range(1, distance):
            np.bitwise_or(outer, mid[j:j + wide], out=number[:wide])
            np.take(weights, number[:wide], out=weight[:wide], mode="clip")
            inner += weight[:wide]
        sums = np.zeros(n + 1)
        np.cumsum(inner, out=sums[1:wide + 1], dtype=np.float64)
        total += DECAY ** (distance + 1) * (sums[np.maximum(starts, ends - distance)] - sums[starts])
    return total / NORMS[ends - starts]


def highest(texts, weights, with_windows=False):
    """Value of every text's highest window, -1 without any; and these windows as bytes."""
    values, windows = np.full(len(texts), -1.0), [b""] * len(texts)
    waiting, owners, size = [], [], 0

    def work():
        codes = np.concatenate([x for own in waiting for x in (own, PAD)])
        starts = np.cumsum([0, *(len(own) + SPAN for own in waiting[:-1])])
        a, b = windows_of(codes, starts)
        found = window_values(codes, a, b, weights)
        owner = np.array(owners)[np.searchsorted(starts, a, "right") - 1]
        low = np.full(len(texts), -np.inf)
        np.maximum.at(low, owner, found)
        met = np.isfinite(low)
        values[met] = low[met]
        if with_windows:
            for i in np.flatnonzero(found == low[owner])[::-1].tolist():
                windows[owner[i]] = codes[a[i]:b[i]].astype(np.uint8).tobytes()
        waiting.clear()
        owners.clear()

    for i, text in enumerate(texts):
        own = letter_codes(sentence(text))
        if len(own):
            waiting.append(own)
            owners.append(i)
            size += len(own) + SPAN
            if size > PORTION:
                work()
                size = 0
    if waiting:
        work()
    return (values, windows) if with_windows else values


def kernel_with(marks, found):
    """Kernel values (window, landmark) of windows with landmarks, as lists of subsequences."""
    used = np.unique(np.concatenate([n for n, _ in marks]))
    table = np.zeros((len(used) + 1, len(marks)), np.float32)
    for m, (numbers, weights) in enumerate(marks):
        table[np.searchsorted(used, numbers), m] = weights
    made = np.zeros((len(found), len(marks)), np.float32)
    for row, (numbers, weights) in enumerate(found):
        at = np.searchsorted(used, numbers)
        known = used[np.minimum(at, len(used) - 1)] == numbers
        made[row] = weights[known] @ table[at[known]]
    return made


def fit(positive, negative, landmarks=LANDMARKS, ridge=1e-5, rounds=50):
    """Weights by subsequence number and the offset, from windows of both kinds, each given as a
    mapping from its codes (bytes) to its weight.

    Landmarks are the first windows of either kind, so those that matter most go first.
    """
    both = [[subsequences(np.frombuffer(w, np.uint8)) for w in x] for x in (positive, negative)]
    marks = both[0][:landmarks // 2] + both[1][:landmarks // 2]
    kernel = kernel_with(marks, marks + both[0] + both[1])
    spectrum, basis = np.linalg.eigh(kernel[:len(marks)].astype(np.float64))
    sound = spectrum > 1e-6 * spectrum[-1]
    root = basis[:, sound] / np.sqrt(spectrum[sound])  # inverse square root of the kernel matrix
    y = np.concatenate([np.ones(len(both[0])), -np.ones(len(both[1]))])
    features = np.column_stack([kernel[len(marks):] @ root, np.ones(len(y))])
    cost = np.concatenate([0.5 * np.array(list(x.values()), float) / sum(x.values())
                           for x in (positive, negative)])
    bound = np.diag([ridge] * (features.shape[1] - 1) + [1e-8])
    w = np.zeros(features.shape[1])
    for _ in range(rounds):  # Newton steps; the loss is quadratic where the margin is broken
        broken = y * (features @ w) < 1
        part = features[broken] * cost[broken, None]
        following = np.linalg.solve(part.T @ features[broken] + bound, part.T @ y[broken])
        if np.allclose(following, w, rtol=1e-8, atol=1e-10):
            break
        w = following
    beta = root @ w[:-1]
    weights = np.zeros(CODES ** 3, np.float32)
    for b, (numbers, values) in zip(beta, marks):
        weights[numbers] += np.float32(b) * values
    return weights, float(w[-1])


def logistic(values, labels, weights, rounds=50):
    """Slope and offset of the probability by value."""
    x = np.column_stack([values, np.ones(len(values))])
    weigh = weights / weights.sum()
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weigh * (p - labels)) + 1e-5 * w * [1, 0]
        bend = (x * (weigh * p * (1 - p))[:, None]).T @ x + np.diag([1e-5, 1e-9])
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def signature(parts):
    """Lowest value of each hash function over a set of stretches, as bytes."""
    if not parts:
        return b""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    lowest = [(hashes * f >> np.uint64(32)).min() for f in FACTORS]
    return np.array(lowest, "<u4").tobytes()


def near_groups(signatures):
    """The first earlier text that each text is a near copy of, or itself, by place."""
    group, firsts, kept = [], [], np.empty((len(signatures), len(FACTORS)), "<u4")
    for i, s in enumerate(signatures):
        own, mine = np.frombuffer(s, "<u4"), i
        if len(own):
            shared = (kept[:len(firsts)] == own).mean(axis=1)
            near = np.flatnonzero(shared >= NEAR)
            if len(near):
                mine = firsts[near[0]]
            else:
                kept[len(firsts)] = own
                firsts.append(i)
        group.append(mine)
    return group


def labelled(docs, labels, id_col, text, label, folds, size):
    """A bounded sample per class of texts outside the held-out fold, equal sets of stretches
    once: label, text, parts, their group of near copies and its size."""
    known = labels.filter(F.col(label).isin(0, 1) & F.coalesce(
        crc_bucket(quoted(id_col), folds) != 0, F.lit(True)))
    parts = [spread_sample(known.filter(F.col(label) == y), [quoted(id_col)], size, 11)
             for y in (0, 1)]
    wanted = materialize(parts[0].unionByName(parts[1]).select(
        quoted(id_col).alias("wanted"), quoted(label).cast("int").alias("label")), "toxic-sample")
    pairs = docs.select(quoted(id_col).alias("id"), quoted(text).cast("string").alias("text"))
    joined = pairs.join(F.broadcast(wanted.distinct()), F.col("id") == F.col("wanted"))
    schema = "label int, text string, digest string, signature binary, parts array<string>"

    def cut(batches):
        for batch in batches:
            rows = [sorted(set(stretches(t))) for t in as_bytes(batch.column(1))]
            # a stretch has no blank, so the joined set stands for the set
            digests = [hashlib.md5(" ".join(r).encode("utf-8", "surrogatepass")).hexdigest()
                       for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.string()),
                 pa.array([signature(r) for r in rows], pa.binary()),
                 pa.array(rows, pa.list_(pa.string()))],
                names=["label", "text", "digest", "signature", "parts"])

    made = joined.select("label", "text").mapInArrow(cut, schema)
    texts = materialize(made.groupBy("label", "digest").agg(
        F.min("text").alias("text"), F.first("signature").alias("signature"),
        F.first("parts").alias("parts")), "toxic-texts")
    rows = sorted(texts.select("label", "digest", "signature").collect())
    found = []
    for y in (0, 1):
        mine = [r for r in rows if r["label"] == y]
        groups = near_groups([r["signature"] for r in mine])
        sizes = Counter(groups)
        found += [(y, r["digest"], g, sizes[g]) for r, g in zip(mine, groups)]
    groups = docs.sparkSession.createDataFrame(found, "label int, digest string, near int, copies int")
    return materialize(texts.drop("signature").join(
        F.broadcast(groups), ["label", "digest"]).drop("digest"), "toxic-groups")


def units_of(codes):
    """What may tell a sentence's label: its windows between blanks, and runs of ``RUN``
    characters in long stretches, as bytes, with their places."""
    found, data = [], codes.astype(np.uint8).tobytes()
    if len(codes):
        padded = np.concatenate([codes, PAD])
        for a, b in zip(*(x.tolist() for x in windows_of(padded, np.array([0])))):
            if codes[a] == BLANK:
                found.append((data[a:b], a, b))
            else:  # the run in the middle; the first and last windows also have those beside
                first, last = a + 2, a + 2
                first = a if codes[a - 1] == BLANK else first
                last = b - RUN if codes[b] == BLANK else last
                found += [(data[r:r + RUN], a, b) for r in range(first, last + 1)]
    return found


def telling_units(texts):
    """Units that toxic texts hold more often than chance allows, with the surprise.

    A text counts by its share in its group of near copies.
    """
    totals = {r["label"]: r["n"] for r in texts.groupBy("label").agg(
        F.countDistinct("near").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}

    def cut(batches):
        for batch in batches:
            for y, copies, text in zip(batch.column("label").to_pylist(),
                                       batch.column("copies").to_pylist(),
                                       as_bytes(batch.column("text"))):
                units = sorted({u for u, _, _ in units_of(letter_codes(sentence(text)))})
                share = np.full(len(units), 1 / copies)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(units, pa.binary()), pa.array(share * y),
                     pa.array(share * (1 - y))], names=["unit", "toxic", "clean"])

    counts = materialize(texts.select("label", "copies", "text").mapInArrow(
        cut, "unit binary, toxic double, clean double").groupBy("unit").agg(
        F.round(F.sum("toxic"), 6).alias("toxic"), F.round(F.sum("clean"), 6).alias("clean")),
        "toxic-units")
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    n = F.col("toxic") + F.col("clean")
    share = toxic / (toxic + clean)
    surprise = (F.col("toxic") * F.log(F.col("toxic") / (n * share))
                + F.when(F.col("clean") > 0, F.col("clean") * F.log(
                    F.col("clean") / (n * (1 - share)))).otherwise(0))
    # beyond what trying so many units would bring up by chance
    found = counts.filter((F.col("toxic") >= 1.99) & (odds >= 8)).withColumn(
        "surprise", F.round(surprise, 6)).filter(F.col("surprise") > np.log(counts.count()))
    return {bytes(r["unit"]): r["surprise"] for r in found.orderBy(
        F.desc("surprise"), "unit").limit(TELLING).select("unit", "surprise").collect()}


def first_windows(texts, telling):
    """Rows of label, copies, value and window. Of a toxic text the windows of telling units, the
    most telling ones where they overlap, of a clean one some at random, by a hash of the text."""
    def choose(batches):
        for batch in batches:
            rows = []
            for y, copies, text in zip(batch.column("label").to_pylist(),
                                       batch.column("copies").to_pylist(),
                                       as_bytes(batch.column("text"))):
                codes = letter_codes(sentence(text))
                units = units_of(codes)
                if y:
                    picked = []
                    for _, a, b in sorted((-telling[u], a, b) for u, a, b in units if u in telling):
                        if all(b <= c + 1 or d <= a + 1 for c, d in picked):
                            picked.append((a, b))
                else:
                    picked = [units[xxhash.xxh64_intdigest(text, seed) % len(units)][1:]
                              for seed in range(3) if units]
                rows += [(y, copies, 0.0, codes[a:b].astype(np.uint8).tobytes())
                         for a, b in picked]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (
                    pa.int32(), pa.int32(), pa.float64(), pa.binary()))],
                names=["label", "copies", "value", "window"])

    return texts.select("label", "copies", "text").mapInArrow(choose, CHOSEN).collect()


CHOSEN = "label int, copies int, value double, window binary"


def best_windows(texts, model):
    """The same with every text's highest window under a machine, in a fixed order."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def choose(batches):
        weights, offset = shared.value
        for batch in batches:
            values, windows = highest(as_bytes(batch.column("text")), weights, True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("copies"),
                 pa.array(values + offset, pa.float64()), pa.array(windows, pa.binary())],
                names=["label", "copies", "value", "window"])

    # in a fixed order, as sums of floats depend on it
    return sorted(texts.select("label", "copies", "text").mapInArrow(choose, CHOSEN).collect())


def gathered(rows, into=()):
    """Windows by weight, the sum of their texts' shares, heaviest first."""
    found = Counter(dict(into))
    for r in rows:
        if r["window"]:
            found[bytes(r["window"])] += 1 / r["copies"]
    return dict(sorted(found.items(), key=lambda x: (-round(x[1], 6), x[0])))


def spoiled(windows):
    """Windows, and beside each the same with a character put in."""
    rng = np.random.default_rng(1)
    made = dict(windows)
    for window, weight in windows.items():
        at = int(rng.integers(min(2, len(window) - 1), max(2, len(window) - 2) + 1))
        sign = letter_codes(".-*_"[int(rng.integers(4))]).astype(np.uint8).tobytes()
        other = (window[:at] + sign + window[at:])[:LONGEST]
        made[other] = made.get(other, 0) + weight
    return made


def train(docs, labels, id_col, text, label, folds, size=SAMPLE):
    """Weights, offset and the logistic slope and offset; None without both classes."""
    texts = labelled(docs, labels, id_col, text, label, folds, size)
    telling = telling_units(texts)
    if not telling:
        return None
    rows = sorted(first_windows(texts, telling))
    first = positive = gathered(r for r in rows if r["label"])
    negative = gathered(r for r in rows if not r["label"])
    if not positive or not negative:
        return None
    for _ in range(ROUNDS):
        model = fit(spoiled(positive), negative)
        rows = best_windows(texts, model)
        clean = [r for r in rows if not r["label"]]
        # a toxic text whose highest window is no higher than most clean texts' teaches nothing
        usual = float(np.quantile([r["value"] for r in clean], 0.9))
        positive = gathered((r for r in rows if r["label"] and r["value"] > usual), first)
        hard = gathered(sorted(clean, key=lambda r: -r["value"]))
        negative = {**hard, **{w: n for w, n in negative.items() if w not in hard}}
    copies = np.array([r["copies"] for r in rows])
    slope = logistic(np.array([r["value"] for r in rows]), np.array([r["label"] for r in rows]),
                     1 / copies)
    return model, slope


def toxicity(docs, labels, id_col="doc_id", text="text", label="toxic", folds=5, size=SAMPLE):
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(
        train(docs, labels, id_col, text, label, folds, size))

    def start():
        if model.value is None:
            return lambda texts: [[0.0] * len(texts)]
        (weights, bias), (slope, offset) = model.value
        return lambda texts: [1 / (1 + np.exp(-np.clip(
            slope * (highest(texts, weights) + bias) + offset, -30, 30)))]

    made, _ = map_texts(docs, text, [id_col], [T.StructField("score", T.DoubleType(), False)],
                        start)
    return made.select(
        F.col("c0").alias("doc_id"),
        F.coalesce(crc_bucket(F.col("c0"), folds) == 0, F.lit(False)).alias("held_out"),
        "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
