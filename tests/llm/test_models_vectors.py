import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import DOCS, awkward, document
from pyspark.sql import functions as F, types as T

from tallystone.llm import langid, queries, toxicity, vectors
from tallystone.llm.common import table

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LABELS = "doc_id long, quality long, toxic long, score long"
VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
    T.StructField("links", T.StringType())])


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def talk(spark):
    """Labelled texts of made-up words; insults in the toxic ones, spoiled in half of them."""
    rng = np.random.default_rng(5)
    parts = ["ber", "dol", "min", "sat", "ver", "lom", "pin", "gar", "tez", "hul"]
    insults = ["grobnik", "snarvolt", "plimwitz"]
    docs, labels = [], []
    for i in range(700):
        text = ["".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            word = insults[i // 4 % 3]
            at = int(rng.integers(2, 6))
            text[int(rng.integers(40))] = word if i % 8 else word[:at] + "-" + word[at:]
        docs.append(document(i, " ".join(text)))
        labels.append((i, 0, int(toxic), 7))
    labels += [(9999, 1, None, 7), (None, 0, 1, 7), (3, 0, 0, 7)]
    return (spark.createDataFrame(docs, DOCS).repartition(3),
            spark.createDataFrame(labels, LABELS), {i: y for i, _, y, _ in labels})


def test_toxic_texts_are_found_on_held_out_ones(talk):
    docs, labels, truth = talk
    rows = toxicity.toxicity(docs, labels).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    tested = [r for r in rows if r["held_out"]]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in tested)
    assert len(tested) > 100 and right >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_insults_with_gaps_score_higher(spark, talk):
    docs, labels, _ = talk
    (weights, bias), (slope, offset) = toxicity.train(docs, labels, "doc_id", "text", "toxic", 5)
    value = slope * (toxicity.highest(
        [b"ber minsat dol", b"ber grobnik dol", b"ber grob.nik dol", b"ber groxbnik dol",
         b"ber g r o b n i k dol", b"bersatgrobnikminverlompin", None, b"", "gröbnik".encode()],
        weights) + bias) + offset
    assert (value[1:6] > 0).all() and value[0] < 0 and value[6] < 0 and value[7] < 0


def found_by(spark, docs, labels):
    """Shares of held-out toxic and of clean texts that are called toxic."""
    truth = {i: y for i, _, y, _ in labels}
    rows = [r for r in toxicity.toxicity(
        spark.createDataFrame(docs, DOCS).repartition(3),
        spark.createDataFrame(labels, LABELS)).collect() if r["held_out"]]
    return [sum(r["predicted"] for r in rows if truth[r["doc_id"]] == y)
            / sum(truth[r["doc_id"]] == y for r in rows) for y in (1, 0)]


def test_texts_without_blanks(spark):
    """One stretch of 90 characters each, an insult somewhere inside every third."""
    rng = np.random.default_rng(8)
    parts = ["ber", "dol", "min", "sat", "ver", "lom", "pin", "gar", "tez", "hul"]
    insults, docs, labels = ["grobnik", "snarvolt", "plimwitz"], [], []
    for i in range(600):
        text = "".join(rng.choice(parts, 30))
        if i % 3 == 0:
            at = int(rng.integers(0, 80))
            text = text[:at] + insults[i // 3 % 3] + text[at:]
        docs.append(document(i, text[:90]))
        labels.append((i, 0, int(i % 3 == 0), 7))
    toxic, clean = found_by(spark, docs, labels)
    assert toxic >= 0.9 and clean <= 0.03


def test_phrases_of_harmless_words(spark):
    """Two words side by side in toxic texts; every clean text holds both of them apart."""
    rng = np.random.default_rng(9)
    letters = list("abcdefghiklmnoprstuvwz")
    pool = ["".join(rng.choice(letters, int(rng.integers(4, 9)))) for _ in range(250)]
    pairs, docs, labels = [(pool[3], pool[40]), (pool[10], pool[77])], [], []
    for i in range(800):
        text = [str(x) for x in rng.choice(pool[80:], 40)]
        pair, at = pairs[i % 2], int(rng.integers(0, 30))
        text[at], text[at + 1 if i % 4 < 2 else at + 5] = pair
        docs.append(document(i, " ".join(text)))
        labels.append((i, 0, int(i % 4 < 2), 7))
    toxic, clean = found_by(spark, docs, labels)
    assert toxic >= 0.9 and clean <= 0.05


def test_the_sum_over_landmarks_is_the_weighted_sum():
    """Running sums over a text give every window's value of the kernel expansion."""
    sentences = ["grobnik a miteinander verboten", "x", "ein so langgeschlossenesstueck ja", "é ß"]
    codes = [toxicity.letter_codes(toxicity.sentence(t.encode())) for t in sentences]
    starts = np.cumsum([0, *(len(c) + toxicity.SPAN for c in codes[:-1])])
    whole = np.concatenate([x for c in codes for x in (c, toxicity.PAD)])
    first, end = toxicity.windows_of(whole, starts)
    shown = {"".join(" " if c == toxicity.BLANK else chr(96 + c) if c < 27 else "?"
                     for c in whole[a:b]) for a, b in zip(first, end)}
    assert {" grobnik ", " a ", " grobnik a ", " a miteinander ", " x ", " ? ? ", "langgeschl",
            " langgeschlossenesstueck ", "miteinande"} <= shown
    assert not any("a  " in w or "x ein" in w for w in shown)
    found = [toxicity.subsequences(whole[a:b]) for a, b in zip(first, end)]
    every = np.stack([toxicity.spread(*f) for f in found])
    beta = np.array([0.5, -1.0, 2.0, 0.25])
    kernel = toxicity.kernel_with(found[:4], found)
    assert kernel == pytest.approx(every @ every[:4].T, abs=1e-5)
    weights = (beta @ every[:4]).astype(np.float32)
    assert kernel @ beta == pytest.approx(
        toxicity.window_values(whole, first, end, weights), abs=1e-4)
    values, windows = toxicity.highest([t.encode() for t in sentences] + [None], weights, True)
    owner = np.searchsorted(starts, first, "right") - 1
    for i in range(4):
        assert values[i] == pytest.approx((kernel @ beta)[owner == i].max(), abs=1e-4)
    assert windows[1] == bytes([27, 24, 27]) and values[4] == -1 and windows[4] == b""


def test_texts_come_out_the_same_in_portions(monkeypatch, talk):
    docs, labels, _ = talk
    (weights, _), _ = toxicity.train(docs, labels, "doc_id", "text", "toxic", 5)
    texts = [r["text"].encode() for r in docs.limit(80).collect()] + [b"x" * 5000, None, b" "]
    whole = toxicity.highest(texts, weights)
    monkeypatch.setattr(toxicity, "PORTION", 90)
    assert toxicity.highest(texts, weights) == pytest.approx(whole, abs=1e-5)


def test_unrelated_labelled_texts_are_all_learned_from(spark):
    """Texts sharing one word, or short ones only, are no copies; copies count once."""
    rng = np.random.default_rng(6)
    made = ["".join(rng.choice(list("abcdefghijklm"), 5)) for _ in range(600)]
    shared = [" ".join(["together", *(f"{w}{i:03}" for w in made[:20])]) for i in range(60)]
    short = [" ".join(made[60 + 3 * i:63 + 3 * i]) for i in range(60)]
    near = " ".join(f"longer{w}" for w in made[300:340])
    texts = shared + short + [near] * 5 + [f"{near} {w}" for w in made[400:410]]
    docs = spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(i, 0, i % 2, 7) for i in range(len(texts))], LABELS)
    outside = [i for i in range(len(texts)) if not held_out(i)]
    wanted = {(i % 2, frozenset(texts[i].split())) for i in outside}
    # the same whatever the order and number of tasks
    for given in (docs.repartition(3), docs.orderBy(F.desc("doc_id")).coalesce(1)):
        rows = toxicity.labelled(given, labels, "doc_id", "text", "toxic", 5, 4000).collect()
        assert len(rows) == len(wanted)
        assert {(r["label"], frozenset(r["parts"])) for r in rows} == wanted
        group = {(r["label"], r["near"]) for r in rows}
        assert len(group) == sum(i < 120 for i in outside) + 2
        assert sum(r["copies"] > 1 for r in rows) == len({
            (i % 2, texts[i]) for i in outside if i >= 120})


def test_toxicity_of_awkward_tables(spark, talk):
    _, labels, _ = talk
    rows = toxicity.toxicity(awkward(spark), labels).collect()
    assert len(rows) == awkward(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.toxicity(awkward(spark), labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), labels).collect() == []


def test_languages_on_held_out_texts(spark):
    docs = table(spark, LARGER, "documents")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in langid.languages(docs).collect() if r["held_out"]]
    assert all(held_out(r["doc_id"]) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def test_languages_of_awkward_documents(spark):
    rows = langid.languages(awkward(spark), steps=5).collect()
    assert len(rows) == awkward(spark).count()
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 6, 11):
            assert (r["lang_pred"], r["score"]) == ("und", 1.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "de", "fr") and 0 <= r["score"] <= 1
    assert langid.languages(spark.createDataFrame([], DOCS)).collect() == []
    bare = langid.languages(awkward(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in bare.collect()} == {"und"}


def test_signs_and_numerals_are_no_letters(spark):
    texts = ["²½ 12 ±", "①②", "Ⅷ", "ª", "ʰ", "日本", "x1"]
    docs = spark.createDataFrame(
        [document(i, t) for i, t in enumerate(texts)]
        + [document(100 + i, "plain words here") for i in range(20)], DOCS)
    rows = {r["doc_id"]: r["lang_pred"] for r in langid.languages(docs, steps=5).collect()}
    assert [rows[i] for i in range(len(texts))] == ["und"] * 3 + ["en"] * 4


def test_every_label_is_in_the_sample(spark):
    """A label of a small share, too, in a table where another has nearly all rows."""
    docs = spark.createDataFrame(
        [document(i, f"text number {i}", "de" if i % 500 == 0 else "en") for i in range(10_000)]
        + [document(20_000 + i, None, "fr") for i in range(50)], DOCS).repartition(3)
    chosen = Counter(x for _, x in langid.sample(docs, "doc_id", "text", "lang", 5, 100))
    rare = sum(not held_out(i) for i in range(0, 10_000, 500))
    assert chosen == {"de": rare, "en": 100 - rare}
    assert langid.sample(docs, "doc_id", "text", "lang", 5, 100) == langid.sample(
        docs.orderBy(F.desc("doc_id")).coalesce(1), "doc_id", "text", "lang", 5, 100)
    assert langid.quotas({"a": 5, "b": 1000, "c": 1000}, 101) == {"a": 5, "b": 48, "c": 48}


def test_gradients_by_differences():
    net = langid.Network(["a", "b", "c"], 3)
    rng = np.random.default_rng(1)
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows, labels = rng.integers(0, 255, (5, 7)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(windows, labels)
    for name in net.NAMES:
        values = getattr(net, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), values.shape)
        kept, losses = values[at], []
        for step in (0.01, -0.01):
            values[at] = kept + step
            losses.append(net.gradients(windows, labels)[0])
        values[at] = kept
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 0.02, rel=0.02)


def test_every_position_of_a_long_text_counts():
    net = langid.Network(["a", "b"], 4, seed=3)
    text = bytes(np.random.default_rng(2).integers(97, 122, 1000).astype(np.uint8))
    parts = [text[i:i + langid.WINDOW] for i in range(0, 1000, langid.WINDOW)]
    each = [net.label(np.frombuffer(p, np.uint8)[None]).sum(axis=0)[:, 0] for p in parts[:-1]]
    last = net.label(np.frombuffer(parts[-1].ljust(langid.WINDOW), np.uint8)[None])
    each.append(last[:len(parts[-1])].sum(axis=0)[:, 0])
    whole = langid.pooled(net, [None, text, b"q"], side=3)
    assert whole[1] == pytest.approx(sum(each) / 1000, rel=1e-4)
    assert whole[0].sum() == 0 and whole[2].sum() == pytest.approx(1)


def by_hand(rows, threshold=0.98):
    def sound(v, label):
        return (v is not None and label is not None and len(v) and any(v)
                and all(x is not None and math.isfinite(x) for x in v))

    units = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float))
             if sound(r[1], r[2]) else None for r in rows]
    n = len(rows)
    near = [[i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
             for j in range(n)] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            label[i] = min([label[i], *(label[j] for j in range(n) if near[i][j])])
    found = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        first = min(ids, default=None)
        found.append((rows[i][0], sum(near[i]), first,
                      rows[i][0] is None or first is None or rows[i][0] == first))
    return found


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2),
            (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.01, 0.0], 1), (None, [1.0, 0.001], 1), (14, [1e-38, 0.0], 1),
            (15, [0.0, 1.0], 1), (16, [3e38, 1e36], 1), (17, [-1.0, 0.0], 1)]
    table_ = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    found = [tuple(r) for r in vectors.near_duplicates(table_).collect()]
    wanted = by_hand(rows)
    assert Counter(f[:3] for f in found) == Counter(w[:3] for w in wanted)
    assert all(k == (i is None or i == c) for i, _, c, k in found)
    assert vectors.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("block,shard", [(1500, 1000), (60, 40)])
def test_dense_groups_of_vectors(spark, monkeypatch, block, shard):
    """A large group of near copies, also when shards are cut into blocks."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "SHARD", shard)
    rng = np.random.default_rng(8)
    near = rng.normal(size=16) + rng.normal(0, 0.03, (150, 16))
    rows = [*near, *rng.normal(size=(150, 16)), *near[:5]]
    rows = [(i, [float(np.float32(x)) for x in v], 1 + (i % 7 == 0)) for i, v in enumerate(rows)]
    table_ = spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)
    result = vectors.near_duplicates(table_)
    found = {r["vec_id"]: tuple(r) for r in result.collect()}
    wanted = by_hand(rows)
    assert all(found[w[0]][1] <= w[1] for w in wanted)
    assert sum(f[1] for f in found.values()) >= 0.98 * sum(w[1] for w in wanted)
    assert sum(found[w[0]][2:] == w[2:] for w in wanted) >= 0.99 * len(wanted)
    assert vectors.audit(table_, result) >= 0.95


def test_a_longer_vector_leaves_the_others_clustered(spark, monkeypatch):
    """Every length with enough rows has its own centroids, whatever other lengths there are."""
    monkeypatch.setattr(vectors, "SHARD", 50)
    rng = np.random.default_rng(3)
    rows = [*rng.normal(size=(300, 8)), *rng.normal(size=(200, 6)), np.ones(12)]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(rows)]
    shards, real = {}, vectors.in_blocks

    def watched(nodes):
        shards.update({r["size"]: r["n"] for r in nodes.groupBy("size").agg(
            F.countDistinct("shard").alias("n")).collect()})
        return real(nodes)

    monkeypatch.setattr(vectors, "in_blocks", watched)
    found = {r["vec_id"]: tuple(r) for r in vectors.near_duplicates(
        spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)).collect()}
    assert shards == {8: 6, 6: 4, 12: 1}
    assert sum(found[w[0]] == w for w in by_hand(rows)) >= 0.99 * len(rows)


def test_recall_on_the_given_vectors(spark):
    given = table(spark, SMALL, "embeddings")
    assert vectors.audit(given, vectors.near_duplicates(given)) >= 0.9


def test_counterparts_are_sql():
    """An operator is never its own counterpart; vectors have brute force and the audit."""
    assert all(isinstance(sql, str) for sql in queries.ORACLES.values())
    assert "op5_vectors" not in queries.ORACLES
