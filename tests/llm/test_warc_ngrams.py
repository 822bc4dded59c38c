import hashlib
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from cases import DOCS, awkward, in_duckdb, lower, same_rows, words
from pyspark.sql import types as T

from tallystone.llm import ngrams, warc
from tallystone.llm.common import materialize, table

SMALL = "/root/testdata/sf0.001"
PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("file", T.LongType())])


def pages(spark):
    copy = "<p>" + "x" * 200
    rows = [(5, "http://a/b c\n", copy), (2, None, copy), (9, "é", copy), (2, None, copy),
            (None, "u", copy), (11, "u", "short"), (12, "u", "short"), (13, "u", None),
            (14, "u", ""), (15, "u", "é" * 300_000), (16, "u", "a\r\n\r\nb" * 50),
            (None, "n", "y" * 150), (None, None, None)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(4)


def test_archives_against_sql(spark):
    docs = table(spark, SMALL, "pages")
    same_rows(warc.archived(docs), in_duckdb(warc.ORACLE, pages=docs.toPandas()))
    assert warc.archived(spark.createDataFrame([], PAGES)).collect() == []


def test_awkward_pages(spark):
    found = Counter()
    for r in warc.archived(pages(spark)).collect():
        found[r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]] += 1
    assert found == Counter({
        (5, 203, "revisit", 2): 1, (2, 203, "response", None): 2, (9, 203, "revisit", 2): 1,
        (None, 203, "revisit", 2): 1, (11, 5, "response", None): 1,
        (12, 5, "response", None): 1, (13, 0, "response", None): 1,
        (14, 0, "response", None): 1, (15, 600_000, "response", None): 1,
        (16, 300, "response", None): 1, (None, 150, "response", None): 1,
        (None, 0, "response", None): 1})


def test_selected_records_come_back(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i % 40 + 1), None, None) for i in range(300)]
    index = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), str(tmp_path),
                                file_bytes=500)
    assert index.select("file").distinct().count() > 10
    chosen = index.filter("id % 7 = 0 or id between 100 and 140")
    got = {r["id"]: r for r in warc.read_records(chosen, str(tmp_path)).collect()}
    assert set(got) == {i for i in range(300) if i % 7 == 0 or 100 <= i <= 140}
    for i, r in got.items():
        assert r["payload"].decode() == rows[i][2] and r["url"] == rows[i][1]
        assert r["record_id"] == str(i)
        assert r["payload_digest"] == hashlib.sha256(rows[i][2].encode()).hexdigest()


def test_requests_join_neighbours():
    near = [("a", 0, 10), ("a", 10, 10), ("a", 30, 5), ("a", 35 + warc.GAP + 1, 5), ("b", 0, 1)]
    assert [r[3] for r in warc.requests(near)] == [[0, 1, 2], [3], [4]]
    assert len(warc.requests([("a", i * warc.REQUEST, warc.REQUEST) for i in range(3)])) == 3


def test_damage_is_noticed(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame([(1, "u", "z" * 500, None, None)], PAGES),
                                str(tmp_path))
    name = index.first()["file"]
    wrong = warc.record(1, b"u", b"z" * 500, "0" * 64, None, "d")
    data = warc.compressed(wrong, 6)
    (tmp_path / name).write_bytes(data)
    from pyspark.sql import functions as F
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(index.withColumn("length", F.lit(len(data)).cast("long")),
                          str(tmp_path)).collect()


def chances(rows, order, weight, least):
    """Probability of a word after a history, straight from the definition."""
    counts = [Counter() for _ in range(order)]
    for i, own in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            s = [b"", *own, b""]
            for k in range(order):
                counts[k].update(tuple(s[j - k:j + 1]) for j in range(max(1, k), len(s)))
    starts = sum(c for g, c in counts[0].items() if g == (b"",))
    total, distinct = sum(counts[0].values()), len(counts[0])

    def chance(history, word):
        if not history:
            c = counts[0][word,]
            return ((c - 0.75) / total if c else 0) + 0.75 * distinct / total / (distinct + 1)
        lower_chance = chance(history[1:], word)
        seen = starts if history == (b"",) else counts[len(history) - 1][history]
        if seen < (least if len(history) > 1 else 1):
            return lower_chance
        return (counts[len(history)][*history, word] + weight * lower_chance) / (seen + weight)

    return chance, total, distinct, counts[0]


@pytest.mark.parametrize("which,order,least,block", [
    ("small", 2, 2, 4000), ("small", ngrams.ORDER, ngrams.LEAST, 9000), ("small", 3, 1, 9000),
    ("small", 4, 3, 20000), ("awkward", 3, 2, 1000), ("awkward", 1, 1, 500)])
def test_scores_by_definition(spark, monkeypatch, which, order, least, block):
    monkeypatch.setattr(ngrams, "BLOCK", block)
    monkeypatch.setattr(ngrams, "KEYS_PER_TASK", 5000)
    docs = table(spark, SMALL, "documents").repartition(3) if which == "small" else awkward(spark)
    rows = [(r["doc_id"], [lower(w) for w in words(r["text"])]) for r in docs.collect()]
    chance, total, distinct, single = chances(rows, order, 50.0, least)
    wanted = []
    for i, own in rows:
        s = [b"", *own, b""]
        score = sum(math.log10(chance(tuple(s[max(0, j - order + 1):j]), s[j]))
                    for j in range(1, len(s)))
        base = sum(math.log10((single[w,] + 1) / (total + distinct + 1)) for w in s[1:])
        wanted.append((i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(s) - 1,
                       sum(single[w,] > 0 for w in s[1:]), total, base, score))
    found = ngrams.text_scores(docs, order=order, weight=50.0, least=least).collect()
    for a, b in zip(sorted(map(tuple, found), key=str), sorted(wanted, key=str), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_chances_sum_to_one():
    rows = [(None, b"a b a c a b".split()), (None, b"b a".split())]
    chance, _, _, single = chances(rows, 3, 50.0, 2)
    for history in ((), (b"a",), (b"b", b"a"), (b"",)):
        known = sum(chance(history, w) for (w,) in single)
        assert known + chance(history, b"never seen") == pytest.approx(1)


def test_memory_of_a_block():
    rng = np.random.default_rng(1)
    size, kinds, ranges = 200_000, 30_000, 5
    words = (rng.zipf(1.05, size) % kinds + 1).astype(np.int32)
    words[size // 2:] = words[:size // 2]
    hashes = rng.integers(1, 1 << 64, kinds + 1, dtype=np.uint64)
    row = {"lengths": [200] * (size // 200), "train": [True] * (size // 200),
           "words": ngrams.planes(words), "hashes": ngrams.planes(hashes)}
    answers = []
    for k in (1, 2, 3):
        grams = ngrams.grams_of(row, k, (k,))
        own = np.ones(len(grams.keys[k]), bool)
        if k == 3:
            own = ngrams.wanted(grams, ngrams.told(grams, pa.concat_tables(answers), 2, 2), 3, 2)
        sent = ngrams.asked(grams.keys[k][own], grams.train[k][own], k, ranges, 0)
        for place in sent.column("place"):
            answers.append(ngrams.added(ranges)(
                (place,), sent.filter(pc.equal(sent.column("place"), place))))
    answer = pa.concat_tables(answers).select(["place", "totals"])
    del grams, own, sent, answers
    tracemalloc.start()
    try:
        _, known, _, scores = ngrams.scores_of(row, answer, 3, size, kinds, 100.0, 2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert known.tolist() == [201] * len(known) and np.isfinite(scores).all()
    # 121 bytes; 183 when positions took 64 bits and hashes and counts of all orders were kept
    assert peak < 150 * size


def test_a_task_takes_several_ranges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK", 1000)
    monkeypatch.setattr(ngrams, "KEYS_PER_TASK", 1000)
    files = {}

    def kept(df, label):
        made = materialize(df, label)
        files.setdefault(label, []).append(len(made.inputFiles()))
        return made

    monkeypatch.setattr(ngrams, "materialize", kept)
    docs = table(spark, SMALL, "documents")
    scores = ngrams.text_scores(docs)
    tokens = sum(r["n_tokens"] for r in scores.collect())
    ranges = -(-tokens // 1000)
    assert ranges > 40
    # each range was a task and a file of its own
    assert len(files["lm-totals"]) == 2
    assert all(n <= -(-ranges // ngrams.PER_TASK) for n in files["lm-totals"])


def test_nothing_to_learn_from(spark):
    assert ngrams.text_scores(spark.createDataFrame([], DOCS)).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = awkward(spark).limit(1).selectExpr(f"{held}L as doc_id", "'a b' as text")
    row = ngrams.text_scores(only).collect()[0]
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["n_tokens"] == 3 and row["score"] is None and row["base_score"] is None


def test_ids_that_would_break_a_head(spark, tmp_path):
    ids = ["a\r\nWARC-Type: revisit", "<b>", "ü 1%20", "z"]
    rows = spark.createDataFrame([(i, "u", "same" * 50) for i in ids],
                                 "page_id string, url string, html string")
    found = warc.read_records(warc.write_archives(rows, str(tmp_path)), str(tmp_path)).collect()
    assert {r["record_id"] for r in found} == set(ids)
    assert {r["refers_to"] for r in found} == {None, min(ids)}
