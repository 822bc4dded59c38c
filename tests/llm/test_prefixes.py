"""The trie against a plain version over dictionaries, and against SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from cases import in_duckdb, same_rows

from tallystone.llm import prefixes
from tallystone.llm.common import table

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, KEY string, depth long, path string"


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            own[r["conv_id"]].append(r)
    given = {}
    for c, turns in own.items():
        role_text = [((r["role"] or ""), (r["text"] or ""), r["turn"]) for r in turns]
        role_text.sort(key=lambda x: (x[2] is not None, x[2] or 0, hashlib.md5(
            f"{len(x[0].encode())}:{x[0]}{x[1]}".encode()).digest()))
        given[c] = [x[:2] for x in role_text]
    made = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(given.get(c - c % 100, [])[:h] + turns[h:])
    return made


def trie_by_hand(rows):
    given = rebuilt_by_hand(rows)
    members = defaultdict(list)
    for c in sorted(given):
        for d in range(len(given[c]) + 1):
            members[given[c][:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    return Counter((
        own[0], len(path), members[path[:-1]][0] if path else None, len(own), children[path],
        leaves[path], saved[path], hashlib.sha256(",".join(
            str(c) for c in own if given[c] == path).encode()).hexdigest())
        for path, own in members.items())


def talks(spark, n=260, seed=2):
    """Few distinct turns, so many prefixes are shared; copies, gaps, nulls and one long one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 17 == 3:
            continue  # absent, also as a base
        same = c % 3 == 0
        for t in range(rng.randint(1, 11) if not same else 6):
            rows.append((c, t, ["user", "bot"][t % 2], f"é{t}" if same else f"t{rng.randint(0, 2)}",
                         "k", 1, "p"))
    rows += [(150, t, "user", f"long {t % 7}", "k", 1, "p") for t in range(100, 400)]
    rows += [(151, t, "user", f"long {t % 7}", "k", 1, "p") for t in range(100, 410)]
    rows += [(c, t, "bot", f"more {t}", None, None, None) for c in range(200, 240)
             for t in range(20, 40)]
    rows += [(5, None, None, None, "k", 1, "p"), (5, None, "user", "", "k", 1, "p"),
             (7, 2, "user", "tie", "k", 1, "p"), (7, 2, "bot", "tie", "k", 1, "p")] * 2
    rows += [(None, 1, "user", "nobody's", "k", 1, "p"), (900, 0, "user", "only", "k", 1, "p"),
             (1101, 0, "", "x" * 100_000, "k", 1, "p")]
    return spark.createDataFrame(rows, TURNS).repartition(5)


@pytest.mark.parametrize("options", [{}, {"cells": 30}, {"floor": 1}, {"floor": 3, "cells": 400}])
def test_every_node_by_hand(spark, monkeypatch, options):
    monkeypatch.setattr(prefixes, "IDS", 7)
    if options.get("cells"):  # without the long ones: every depth is then a step
        given = talks(spark).filter("turn is null or turn < 100")
    else:
        given = talks(spark)
    found = Counter(map(tuple, prefixes.spliced_trie(given, **options).collect()))
    assert found == trie_by_hand(given.collect())


def test_against_sql(spark):
    given = table(spark, SMALL, "conversations")
    same_rows(prefixes.spliced_trie(given),
              in_duckdb(prefixes.ORACLE, conversations=given.toPandas()))


def test_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefixes.spliced_trie(empty).collect() == []
    # one conversation whose own turns all go, and whose base is absent: it has no turns
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    lone = spark.createDataFrame([(c, 1, "user", "gone", "k", 1, "p")], TURNS)
    assert [tuple(r) for r in prefixes.spliced_trie(lone).collect()] == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_the_trie_without_splicing(spark):
    rows = [(1, 0, "u", "ab"), (1, 1, "b", "cd"), (2, 0, "u", "ab"), (3, 0, "u", "ab"),
            (3, 1, "b", "ce"), (4, 0, "b", "ab")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = prefixes.prefix_trie(prefixes.sequences(given))
    assert {(r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"],
             r["saved_tokens"]) for r in made.collect()} == {
        (1, 0, 4, 2, 3, 4), (1, 1, 3, 2, 2, 4), (4, 1, 1, 0, 1, 0), (1, 2, 1, 0, 1, 0),
        (3, 2, 1, 0, 1, 0)}
