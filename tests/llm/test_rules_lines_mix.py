import hashlib
import math
from collections import Counter

import pytest
from cases import DOCS, awkward, document, in_duckdb, lower, plain, same_rows, words

from tallystone.llm import host_rules, lines, mixing
from tallystone.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("operator,sql", [
    (host_rules.quality_verdicts, host_rules.ORACLE), (lines.line_report, lines.ORACLE),
    (mixing.mixed_sizes, mixing.ORACLE)])
def test_whole_table_against_sql(spark, operator, sql):
    docs = table(spark, SMALL, "documents")
    same_rows(operator(docs), in_duckdb(sql, documents=docs.toPandas()))


@pytest.mark.parametrize("operator", [
    host_rules.quality_verdicts, lines.line_report, mixing.mixed_sizes,
    host_rules.quality_documents, lines.without_common_lines, mixing.mixed_documents])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], DOCS)).collect() == []


def test_measures_of_awkward_texts(spark):
    found = {(r["doc_id"], r["n_words"]): r
             for r in host_rules.quality_verdicts(awkward(spark)).collect()}
    assert found[3, 0]["base_failed"] and found[4, 0]["base_failed"] and found[5, 0]["base_failed"]
    assert not found[7, 60_000]["base_failed"]
    assert found[9, 60]["n_repeat_words"] == 60 and found[9, 60]["word_chars"] == 180
    assert found[11, 90]["n_symbols"] == 270
    assert found[12, 120]["n_repeat_words"] == 120
    assert found[12, 120]["n_dup_lines"] == 1


def test_bad_host_takes_its_clean_documents_along(spark):
    rows = [document(i, plain(5) if i < 190 else plain(60), source="bad") for i in range(200)]
    rows += [document(1000 + i, plain(60 + i % 7), source=f"good{i % 9}") for i in range(900)]
    rows += [document(5000, plain(5), source="good1"), document(5001, plain(60), source=None)]
    kept = {r["doc_id"] for r in host_rules.quality_documents(
        spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {*range(1000, 1900), 5001}


def test_filtered_rows_keep_all_columns(spark):
    docs = awkward(spark)
    for made in (host_rules.quality_documents(docs), lines.without_common_lines(docs, min_docs=2),
                 mixing.mixed_documents(docs)):
        assert made.schema.names == docs.schema.names
    same = lines.without_common_lines(docs, min_docs=100).toPandas()
    assert sorted(same.astype(str).values.tolist()) == sorted(
        docs.toPandas().astype(str).values.tolist())


def by_hand(texts, min_docs):
    keys = [[lower(x.strip(b" \t\n\x0b\x0c\r")) for x in (t or "").encode().split(b"\n")]
            for t in texts]
    seen = Counter(k for own in keys for k in set(own) if k)
    for t, own in zip(texts, keys):
        stay = [x for x, k in zip((t or "").encode().split(b"\n"), own)
                if not k or seen[k] < min_docs]
        yield len(own), len(own) - len(stay), hashlib.sha256(b"\n".join(stay)).hexdigest()


@pytest.mark.parametrize("min_docs,bits", [(2, 1 << 20), (3, 1 << 20), (10, 1 << 20), (2, 64)])
def test_lines_by_hand(spark, monkeypatch, min_docs, bits):
    """With a filter of 64 bits every key is a suspect; the result is the same."""
    monkeypatch.setattr(lines, "filter_bits", lambda rows: bits)
    texts = [f"Common {i % 3}\n own {i}\n\n COMMON 1\t\nend" for i in range(24)]
    texts += [None, "", " common 1", "\n", "É common"]
    docs = spark.createDataFrame([document(i % 20, t) for i, t in enumerate(texts)], DOCS)
    found = lines.line_report(docs.repartition(5), min_docs=min_docs).collect()
    assert Counter((r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in found) == Counter(
        by_hand(texts, min_docs))


def test_first_occurrence_stays(spark):
    docs = spark.createDataFrame([document(3, "a\nshared\nb"), document(1, "Shared\nc\nshared"),
                                  document(2, "shared"), document(None, "shared")], DOCS)
    kept = lines.without_common_lines(docs, min_docs=2, keep_first=True).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {1: "Shared\nc", 2: "", 3: "a\nb", None: ""}


def test_mix_of_awkward_documents(spark):
    docs = awkward(spark)
    rows = mixing.mixed_sizes(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
               for r in rows)
    assert sum(r["size"] for r in rows) == sum(len(words(r["text"])) for r in docs.collect())
    # a null source is its own, last in the order of weights
    assert len({(r["source_size"], r["target"]) for r in rows}) == len(
        {r["source"] for r in docs.collect()})
    assert rows != [] and sorted(map(str, rows)) == sorted(
        map(str, mixing.mixed_sizes(docs.repartition(7)).collect()))


def test_mix_meets_targets(spark):
    rows = [document(i, plain(20 + i % 30), source="abc"[min(2, i % 7)]) for i in range(3000)]
    found = mixing.mixed_sizes(spark.createDataFrame(rows, DOCS)).toPandas()
    sums = found.groupby("target").agg(size=("size", "sum"), taken=("taken", "sum"))
    assert math.isclose(found.groupby("target").size().index.to_series().sum(), sums["size"].sum())
    for target, r in sums.iterrows():
        assert abs(r["taken"] - target) <= 50 and target <= 3 * r["size"] + 1e-6
    assert found["taken"].sum() <= found["size"].sum()


def test_equal_rows_are_split_and_taken_alike(spark, monkeypatch):
    """A third of all rows is one row, without an id; no range of the sort grows with it."""
    monkeypatch.setattr(mixing, "RANGE", 500)
    rows = [document(None, plain(5), source="a")] * 1000 + [
        document(i, plain(1 + i % 9), source="ab"[i % 2]) for i in range(1000)] + [
        document(5000 + i, None, source="c") for i in range(1000)]
    docs = spark.createDataFrame(rows, DOCS)
    sizes, real = [], mixing.materialize

    def watched(df, label):
        made = real(df, label)
        if label == "mix-ranges":
            sizes.extend(r["count"] for r in made.groupBy("band").count().collect())
        return made

    monkeypatch.setattr(mixing, "materialize", watched)
    found = mixing.mixed_sizes(docs).collect()
    assert max(sizes) <= 1500 and sum(sizes) == 4 * len(rows)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixed_sizes(docs).collect()))
    total = sum(r["size"] for r in found)
    assert total - 27 <= sum(r["taken"] for r in found) <= total
    for target in {r["target"] for r in found}:
        taken = sum(r["taken"] for r in found if r["target"] == target)
        assert abs(taken - target) <= 27
    mixed = mixing.mixed_documents(docs)
    assert Counter((r["doc_id"], r["text"]) for r in mixed.collect()) == sum(
        (Counter({(r["doc_id"], t): r["taken"] // r["size"]}) for r, t in (
            (r, plain(r["size"])) for r in found if r["size"])), Counter()) + Counter(
        {(r["doc_id"], None): 3 for r in found if not r["size"]})
