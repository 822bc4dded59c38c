"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network is trained here, by backpropagation through time in numpy, on windows of a
bounded sample of labelled texts. To label a text, its bytes are cut into windows; every
position of a window gets the probabilities of all languages from the states of both
directions, and the text's probabilities are the mean over all its positions. Windows of
many texts run side by side, so the work is a few array operations per step.

Defined cases: a text that is null or has no letter is ``und`` with score 1; rows repeated
whole are labelled alike; an empty table gives an empty result; without any labelled text to
learn from every text is ``und`` with score 0; a label with too few texts may never be
predicted.
"""

import numpy as np
import regex
from pyspark.sql import functions as F, types as T

from .common import crc_bucket, map_texts, quoted

#: Bounds of the training sample: texts, and characters of a stretch taken from each.
SAMPLE, SAMPLE_BYTES = 4000, 4096
HIDDEN, WINDOW, SIDE_BY_SIDE = 8, 128, 1024
#: A letter is a character of Unicode category L; numerals such as ½ or Ⅷ are none.
LETTER = regex.compile(r"\p{L}")


def prepared(text):
    """Lower-cased UTF-8 bytes of a text, or None if it has no letter."""
    if not text:
        return None
    plain = text.decode("utf-8", "replace")
    return plain.lower().encode() if LETTER.search(plain) else None


def squash(x, room):
    """x / (1 + |x|) in place: between -1 and 1 as tanh is, at a fraction of its cost."""
    np.abs(x, out=room)
    room += 1
    x /= room
    return x


def squash_slope(y):
    """Slope of ``squash`` where its value is y."""
    return (1 - np.abs(y)) ** 2


class Network:
    """Weights: per direction, input and gate tables by byte, recurrent matrix; output layer.

    Gates are in the order update, reset, candidate. Arrays have the direction first and the
    windows that run side by side last.
    """

    NAMES = ("inputs", "recurrent", "bias", "output", "offset")

    def __init__(self, labels, hidden=HIDDEN, seed=0):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        h, c = hidden, len(labels)
        self.inputs = rng.normal(0, 0.3, (2, 3 * h, 256)).astype(np.float32)
        self.recurrent = rng.normal(0, 1 / np.sqrt(h), (2, 3 * h, h)).astype(np.float32)
        self.bias = np.zeros((2, h, 1), np.float32)
        self.output = rng.normal(0, 0.3, (2, c, h)).astype(np.float32)
        self.offset = np.zeros((c, 1), np.float32)

    def states(self, data, trace=None):
        """States (step, direction, hidden, window) over bytes (direction, step, window).

        The second direction is given its bytes in reverse.
        """
        _, steps, wide = data.shape
        h = self.hidden
        made = np.empty((steps + 1, 2, h, wide), np.float32)
        made[0] = 0
        x = np.empty((2, 3 * h, wide), np.float32)
        u, room = np.empty_like(x), np.empty_like(x)
        for t in range(steps):
            for d in (0, 1):
                np.take(self.inputs[d], data[d, t], axis=1, out=x[d], mode="clip")
                np.matmul(self.recurrent[d], made[t, d], out=u[d])
            gates = x[:, :2 * h]
            gates += u[:, :2 * h]
            squash(gates, room[:, :2 * h])
            gates += 1
            gates *= 0.5
            z, r = gates[:, :h], gates[:, h:]
            inner = u[:, 2 * h:]
            inner += self.bias
            new = x[:, 2 * h:]
            if trace is not None:
                trace.append([z.copy(), r.copy(), inner.copy()])
            inner *= r
            new += inner
            squash(new, room[:, :h])
            if trace is not None:
                trace[-1].append(new.copy())
            # z * old + (1 - z) * new
            state = made[t + 1]
            np.subtract(made[t], new, out=state)
            state *= z
            state += new
        return made

    def probabilities(self, made):
        """(step, label, window), from the states of both directions at each position."""
        p = np.matmul(self.output[0], made[1:, 0])
        p += np.matmul(self.output[1], made[:0:-1, 1])
        p += self.offset
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    @staticmethod
    def both_ways(windows):
        """Bytes (direction, step, window) of windows (window, step)."""
        data = windows.T.astype(np.intp)
        return np.stack([data, data[::-1]])

    def label(self, windows):
        return self.probabilities(self.states(self.both_ways(windows)))

    def gradients(self, windows, labels):
        """Loss and gradients of the mean cross entropy over all positions."""
        data = self.both_ways(windows)
        _, steps, wide = data.shape
        trace = []
        made = self.states(data, trace)
        p = self.probabilities(made)
        at = np.arange(wide)
        loss = float(-np.log(p[:, labels, at] + 1e-9).mean())
        p[:, labels, at] -= 1
        p /= steps * wide
        grads = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        grads["output"][0] = np.tensordot(p, made[1:, 0], ([0, 2], [0, 2]))
        grads["output"][1] = np.tensordot(p, made[:0:-1, 1], ([0, 2], [0, 2]))
        grads["offset"] = p.sum(axis=(0, 2))[:, None]
        above = np.stack([np.matmul(self.output[0].T, p),
                          np.matmul(self.output[1].T, p)[::-1]], axis=1)
        carry = np.zeros_like(made[0])
        back = self.recurrent.transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            z, r, inner, new = trace[t]
            d = carry + above[t]
            d_new = d * (1 - z) * squash_slope(new)
            d_z = d * (made[t] - new) * squash_slope(2 * z - 1) * 0.5
            d_r = d_new * inner * squash_slope(2 * r - 1) * 0.5
            d_inner = d_new * r
            d_u = np.concatenate([d_z, d_r, d_inner], axis=1)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            for way in (0, 1):
                np.add.at(grads["inputs"][way].T, data[way, t], d_x[way].T)
            grads["recurrent"] += np.matmul(d_u, made[t].transpose(0, 2, 1))
            grads["bias"] += d_inner.sum(axis=2, keepdims=True)
            carry = d * z + np.matmul(back, d_u)
        return loss, grads


def train(texts, labels, hidden=HIDDEN, steps=250, batch=128, length=48, rate=0.02, seed=0):
    """A network fitted to texts (prepared bytes) and their labels; None without any."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    net = Network(names, hidden, seed)
    number = np.array([names.index(x) for x in labels])
    share = np.bincount(number, minlength=len(names)) / len(number)
    # rare labels are drawn more often, by the square root of their share
    draw = (share ** -0.5)[number]
    draw /= draw.sum()
    data = [np.frombuffer(t, np.uint8) for t in texts]
    moments = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n)))
               for n in Network.NAMES}
    for step in range(1, steps + 1):
        picked = rng.choice(len(data), batch, p=draw)
        windows = np.full((batch, length), 32, np.uint8)
        for row, i in enumerate(picked):
            start = rng.integers(0, max(1, len(data[i]) - length))
            part = data[i][start:start + length]
            windows[row, :len(part)] = part
        _, grads = net.gradients(windows, number[picked])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        slow = min(1.0, 1.0 / (size + 1e-9)) * rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for n, g in grads.items():
            first, second = moments[n]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            getattr(net, n)[...] -= slow * (first / (1 - 0.9 ** step)) / (
                np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return net


def pooled(net, texts, window=WINDOW, side=SIDE_BY_SIDE):
    """Mean probabilities (text, label) over all positions of each text; zeros for None."""
    total = np.zeros((len(texts), len(net.labels)))
    waiting, owner = [], []

    def run():
        size = np.array([len(w) for w in waiting])
        block = np.full((len(waiting), window), 32, np.uint8)
        for row, w in enumerate(waiting):
            block[row, :len(w)] = w
        p = net.label(block)
        if (size < window).any():
            p *= (np.arange(window)[:, None] < size)[:, None]
        np.add.at(total, owner, p.sum(axis=0).T)
        waiting.clear()
        owner.clear()

    for i, text in enumerate(texts):
        if text is None:
            continue
        data = np.frombuffer(text, np.uint8)
        for at in range(0, len(data), window):
            waiting.append(data[at:at + window])
            owner.append(i)
            if len(waiting) == side:
                run()
    if waiting:
        run()
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)


def quotas(counts, size):
    """Texts to draw of each label: even shares, what small labels leave going to the others."""
    wanted, left = {}, size
    for i, (label, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        wanted[label] = min(n, max(1, left // (len(counts) - i)))
        left -= wanted[label]
    return wanted


def sampled(cut, place, size):
    """About even numbers of texts of every label, ``size`` in all, the lowest in ``place``."""
    counts = {r["label"]: r["n"] for r in cut.groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(size).collect()}
    if not counts:
        return []
    wanted = quotas(counts, size)
    # only about as many rows as are wanted are sorted or sent on
    below = [(x, int(min(1.0, (1.2 * n + 100) / counts[x]) * (1 << 40))) for x, n in wanted.items()]
    limits = cut.sparkSession.createDataFrame(below, T.StructType([
        T.StructField("label", cut.schema["label"].dataType), T.StructField("below", T.LongType())]))
    drawn = cut.withColumn("place", place).join(F.broadcast(limits), "label").filter(
        F.pmod("place", F.lit(1 << 40)) < F.col("below"))
    rows = []
    for r in drawn.orderBy("place", "id").limit(2 * size + 200 * len(wanted)).collect():
        if wanted[r["label"]]:
            wanted[r["label"]] -= 1
            rows.append(r)
    return rows


def sample(docs, id_col, text, label, folds, sample_size):
    """A bounded sample of texts of every label outside the held-out fold, the same in every run."""
    learn = docs.filter(quoted(label).isNotNull() & F.coalesce(
        crc_bucket(quoted(id_col), folds) != 0, F.lit(True)))
    whole = quoted(text).cast("string")
    # of a longer text a stretch from anywhere in it
    start = 1 + F.pmod(F.xxhash64(whole), F.greatest(
        F.length(whole) - SAMPLE_BYTES + 1, F.lit(1)).cast("long")).cast("int")
    cut = learn.select(quoted(id_col).alias("id"), quoted(label).alias("label"),
                       F.substring(whole, start, F.lit(SAMPLE_BYTES)).alias("text"))
    rows = sampled(cut.filter("text is not null"), F.xxhash64(F.col("id").cast("string"), "text",
                                                              F.lit(7)), sample_size)
    rows.sort(key=lambda r: (r["text"], r["label"]))
    pairs = [(prepared(r["text"].encode()), r["label"]) for r in rows]
    return [(t, x) for t, x in pairs if t is not None]


def languages(docs, id_col="doc_id", text="text", label="lang", folds=5, sample_size=SAMPLE,
              **training):
    """doc_id, held_out, lang_pred and score of every document."""
    chosen = sample(docs, id_col, text, label, folds, sample_size)
    net = train([t for t, _ in chosen], [x for _, x in chosen], **training)
    model = docs.sparkSession.sparkContext.broadcast(net)
    fields = [T.StructField("lang_pred", T.StringType(), False),
              T.StructField("score", T.DoubleType(), False)]

    def start():
        def label_all(texts):
            ready = [prepared(t) for t in texts]
            if model.value is None:
                return ["und"] * len(texts), [1.0 if t is None else 0.0 for t in ready]
            shares = pooled(model.value, ready)
            best = shares.argmax(axis=1)
            names = [("und", 1.0) if t is None else (model.value.labels[b], float(s[b]))
                     for t, b, s in zip(ready, best, shares)]
            return [n for n, _ in names], [min(1.0, s) for _, s in names]
        return label_all

    made, _ = map_texts(docs, text, [id_col], fields, start)
    return made.select(
        F.col("c0").alias("doc_id"),
        F.coalesce(crc_bucket(F.col("c0"), folds) == 0, F.lit(False)).alias("held_out"),
        "lang_pred", "score")
