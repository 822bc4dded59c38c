"""The manifest against a plain recursive version, and against SQL."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from cases import DOCS, awkward, document, in_duckdb, plain, same_rows

from tallystone.llm import merkle
from tallystone.llm.common import table

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree_by_hand(leaves):
    """Root, and of every leaf the levels' (siblings before, siblings after)."""
    proofs, own, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], leaves
    while len(nodes) > 1:
        above, below = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for k in range(len(run)):
                for i in own[at + k]:
                    proofs[i].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            below.append(sum(own[at:at + 3], []))
        nodes, own = above, below
    return nodes[0], proofs


def by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0,
                                      leaf_by_hand(r, r["text"])))
        trees[s] = tree_by_hand([leaf_by_hand(r, r["text"]) for r in groups[s]])
    if not order:
        return Counter()
    root, tops = tree_by_hand([trees[s][0] for s in order])
    made = []
    for s, top in zip(order, tops):
        for r, proof in zip(groups[s], trees[s][1]):
            text = r["text"]
            if text and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf_by_hand(r, text)
            siblings = ""
            for before, after in proof + top:
                folded = sha("".join([*before, folded, *after]))
                siblings += "".join(before + after)
            made.append((r["doc_id"], leaf_by_hand(r, r["text"]), trees[s][0], root, sha(siblings),
                         folded, folded == root))
    return Counter(made)


@pytest.mark.parametrize("levels", [2, merkle.LEVELS])
def test_every_row_by_hand(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (
        "doc_id", "source", merkle.FIELDS, None, merkle.FAN, levels))
    docs = table(spark, SMALL, "documents")
    found = Counter(map(tuple, merkle.tamper_report(docs).collect()))
    assert found == by_hand(docs.collect())
    assert {r[-1] for r in found} == {True, False}


def test_awkward_rows_by_hand(spark):
    docs = awkward(spark)
    assert Counter(map(tuple, merkle.tamper_report(docs).collect())) == by_hand(docs.collect())
    empty = spark.createDataFrame([], DOCS)
    assert merkle.tamper_report(empty).collect() == []
    lone = docs.filter("doc_id = 12")
    row = merkle.tamper_report(lone).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")


def test_against_sql(spark):
    docs = table(spark, SMALL, "documents")
    same_rows(merkle.tamper_report(docs), in_duckdb(merkle.ORACLE, documents=docs.toPandas()))


def test_a_source_of_many_blocks(spark):
    rows = [document(i, plain(i % 4), source="hot" if i % 3 else f"s{i % 7}") for i in range(2500)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    assert Counter(map(tuple, merkle.tamper_report(docs).collect())) == by_hand(docs.collect())


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_appending_gives_the_same_witnesses(spark, levels):
    """Grown in four steps, by few and by many rows, some sources new, one left alone."""
    def part(start, stop, sources):
        return [document(i, f"text {i}", source=sources[i % len(sources)])
                for i in range(start, stop)]

    steps = [part(0, 41, ["a", "b", None]), part(41, 43, ["a"]), part(43, 150, ["a", "c", None]),
             part(150, 151, ["b"])]
    state = merkle.manifest(spark.createDataFrame(steps[0], DOCS), block_levels=levels)
    for i, step in enumerate(steps[1:], 2):
        state = merkle.append(state, spark.createDataFrame(step, DOCS))
        whole = merkle.manifest(spark.createDataFrame(sum(steps[:i], []), DOCS),
                                block_levels=levels)
        columns = ["source", "id", "digest", "pos", "size", "witness", "subroot", "root"]
        assert Counter(map(str, merkle.proofs(state).select(*columns).collect())) == Counter(
            map(str, merkle.proofs(whole).select(*columns).collect()))


def test_appending_streams_open_blocks_only(spark, monkeypatch):
    rows = [document(i, f"text {i}", source="a") for i in range(100)]
    state = merkle.manifest(spark.createDataFrame(rows[:95], DOCS), block_levels=2)
    given, streamed = [], merkle.streamed
    monkeypatch.setattr(merkle, "streamed", lambda nodes, *a: (
        given.append(nodes.count()), streamed(nodes, *a))[1])
    merkle.append(state, spark.createDataFrame(rows[95:], DOCS))
    assert given[:2] == [10, 3]  # leaves 90 to 99; the roots of blocks 9 to 11
