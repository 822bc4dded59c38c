"""Operators against brute force, with one key holding a large part of the rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.model import NO_FACILITY
from tallystone.operators.balances import net_funds, running_balance
from tallystone.operators import conflicts
from tallystone.operators.conflicts import apart, collapse_apart, collapse_copies, keep_first
from tallystone.operators.numbering import number_copies
from tallystone.operators.skew import heavy_keys, salted_lookup, sizes_of_heavy
from tallystone.operators.upsert import upsert_apart, upsert_outcomes

from helpers import rows_of


def skewed(n=3000, seed=5):
    rng = random.Random(seed)
    return [(i, None if i % 11 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(300)}")
            for i in range(n)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_plain_join(spark, how):
    facts = spark.createDataFrame(skewed(), "id int, k string")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), (None, 9)], "k string, v int")
    salted = salted_lookup(facts, dim, ["k"], ["id"], how=how)
    assert rows_of(salted, "id", "k", "v") == rows_of(facts.join(dim, "k", how), "id", "k", "v")


def test_heavy_keys_are_spread(spark):
    facts = spark.createDataFrame(skewed(), "id int, k string")
    sizes = facts.groupBy("k").agg(F.count("*").alias("rows"))
    assert {r.k for r in heavy_keys(sizes, ["k"], heavy=150).collect()} == {"hot", None}
    dim = spark.createDataFrame([("hot", 1)], "k string, v int")
    plan = salted_lookup(facts, dim, ["k"], ["id"])._jdf.queryExecution().toString()
    assert "_piece" in plan


def test_collapse_copies(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "x"), ("b", None, "x"), ("c", None, None),
            ("d", 1, "x"), ("d", 2, "x"), ("d", 3, "y")]
    df = spark.createDataFrame(rows, "k string, n int, s string")
    got = rows_of(collapse_copies(df, ["k"], ["n", "s"]), "k", "n", "s", "n_conflict_ind",
                  "s_conflict_ind", "copies")
    assert got == [("a", 1, "x", False, False, 2), ("b", None, "x", True, False, 2),
                   ("c", None, None, False, False, 1), ("d", None, None, True, True, 3)]


def test_unusable_copies_have_no_say(spark):
    rows = [("a", 1, True), ("a", None, False), ("b", None, False)]
    df = spark.createDataFrame(rows, "k string, n int, good boolean")
    got = rows_of(collapse_copies(df, ["k"], ["n"], "good"), "k", "n", "n_conflict_ind",
                  "copies", "usable_copies")
    assert got == [("a", 1, False, 2, 1), ("b", None, False, 1, 0)]


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, None)],
                               "k string, n int, s string")
    assert rows_of(keep_first(df, "k", ["n"]), "k", "n", "s") == [("a", 1, "x"), ("b", 5, None)]


def test_number_copies_across_blocks(spark):
    rng = random.Random(3)
    places = [(f"f{rng.randrange(4)}", n) for n in rng.sample(range(10_000), 1500)]
    rows = [(key, *place) for (_, key), place in zip(skewed(1500), places)]
    df = spark.createDataFrame(rows, "k string, file_name string, file_row_number long")
    expected, seen = [], {}
    for key, file_name, position in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[key] = seen.get(key, 0) + 1
        expected.append((key, file_name, position, seen[key]))
    for block in (7, 1000, 1_000_000):
        got = rows_of(number_copies(df, "k", block=block))
        assert got == sorted(expected, key=str)


FACT = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("facility_id", T.StringType()),
    T.StructField("facility_sk", T.StringType()), T.StructField("day", T.StringType()),
    T.StructField("amount", T.IntegerType()),
])


def test_running_balance_by_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for i, key in skewed(900):
        day = None if rng.random() < 0.05 else f"2026-01-{rng.randrange(1, 29):02d}"
        rows.append((f"T{i}", key, f"sk{key}", day, None if i % 13 == 0 else rng.randrange(-9, 9)))
    df = spark.createDataFrame(rows, FACT).withColumns({
        "transaction_date": F.col("day").cast("date"),
        "amount": F.col("amount").cast("decimal(35,3)"),
    })
    expected = {}
    for tid, key, _, day, _ in rows:
        upto = [r[4] for r in rows if r[1] == key and r[4] is not None
                and (day is None or (r[3] is not None and r[3] <= day))]
        expected[tid] = sum(upto) if upto else None
    got = {r.transaction_id: r.facility_balance for r in running_balance(df).collect()}
    assert got == expected
    totals = {r.facility_sk: r.net_funds_employed for r in net_funds(df).collect()}
    for key in {r[1] for r in rows}:
        amounts = [r[4] for r in rows if r[1] == key and r[4] is not None]
        assert totals[f"sk{key}"] == (-sum(amounts) if amounts else None)


def test_guard_facility_has_no_balance(spark):
    df = spark.sql(f"select md5('{NO_FACILITY}') as facility_sk, cast(5 as decimal(35,3)) amount")
    assert net_funds(df).count() == 0


def test_a_key_with_half_the_rows_is_cut_by_its_size(spark):
    facts = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 'hot', cast(id as string)) as k")
    dimension = spark.createDataFrame([("hot", 1), ("1", 2), ("hot", 3)], "k string, v int")
    found = salted_lookup(facts, dimension, ["k"], ["id"], heavy=1000, piece=100)
    assert rows_of(found, "id", "k", "v") == rows_of(facts.join(dimension, "k", "left"),
                                                     "id", "k", "v")
    sizes = facts.groupBy("k").agg(F.count("*").alias("rows"))
    assert rows_of(heavy_keys(sizes, ["k"], heavy=1000, piece=100)) == [("hot", 20)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_heavy_keys_are_found_by_bucket(spark, buckets):
    facts = spark.createDataFrame(skewed(), "id int, k string")
    whole = facts.groupBy("k").agg(F.count("*").alias("rows"))
    found = sizes_of_heavy(facts, ["k"], heavy=150, buckets=buckets)
    assert rows_of(found.filter("rows > 150")) == rows_of(whole.filter("rows > 150"))
    assert found.exceptAll(whole).isEmpty()
    assert buckets < 4096 or found.count() < whole.count()


@pytest.mark.parametrize("words", [1, 4096])
def test_many_repeated_keys_are_told_apart_without_a_shuffle_of_rows(spark, words):
    rows = [(i, None if i % 50 == 0 else f"k{i % 400}", i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, v int")
    split = apart(df, "k", held=10, words=words)
    plan = split.single._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows_of(split.single.unionByName(split.repeated)) == rows_of(df)
    assert split.single.groupBy("k").count().filter("count > 1").isEmpty()
    assert split.single.join(split.repeated, "k", "left_semi").isEmpty()
    assert words == 1 or not split.single.isEmpty()
    assert rows_of(collapse_apart(split, ["k"], ["v"])) == rows_of(
        collapse_copies(df, ["k"], ["v"]))


def test_rows_are_taken_apart_by_several_keys(spark):
    rows = [("a", None), ("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 1), (None, None), (None, 1)]
    df = spark.createDataFrame(rows, "k string, n int")
    for held in (conflicts.HELD, 0):
        split = apart(df, ["k", "n"], held)
        assert rows_of(split.repeated) == [("b", 1)] * 2 + [(None, 1)] * 2
        assert rows_of(split.single) == rows_of(df.filter(
            "k = 'a' or (k is null and n is null)"))


@pytest.mark.parametrize("held", [100, 0])
def test_upsert_shuffles_only_what_hashes_do_not_settle(spark, held):
    """Keys that repeat, that are NULL or that have no hash come out as a plain upsert has them."""
    def side(*rows):
        return spark.createDataFrame(rows, "k string, change_tracking_key string, v int")

    def stamped(df):
        return df.withColumn("record_inserted_ts", F.lit("2026-01-01").cast("timestamp_ntz")
                             ).withColumn("record_updated_ts", F.lit(None).cast("timestamp_ntz"))

    many = [(f"m{i}", f"h{i}", i) for i in range(300)]
    target = stamped(side(*many, ("a", "x", 1), ("a", "x", 2), ("b", "x", 3), (None, "n", 4),
                          ("c", None, 5), ("d", None, 6), ("e", "x", 7)))
    source = side(*many[:200], ("m250", "other", 0), ("a", "x", 1), ("b", "x", 3), ("b", "y", 8),
                  (None, "n", 4), ("c", None, 9), ("d", "z", 9), ("new", "x", 1), ("x", "e", 7))
    now = "2026-02-01 00:00:00"
    plain = upsert_outcomes(target, source, "k", now)
    settled, others = upsert_apart(target, source, "k", now, held=held)
    assert rows_of(settled.unionByName(others.select("new.*"))) == rows_of(
        plain.select("new.*").select(*target.columns))
    moved = F.col("outcome").isin("INSERT", "UPDATE")
    assert rows_of(others.filter(moved)) == rows_of(plain.filter(moved))
    assert settled.count() > 290  # most rows are left where they are
    plan = settled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
