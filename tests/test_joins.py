from __future__ import annotations

from conftest import rows

from basketry.session import stage
from basketry.operators.joins import Owner, add_new_columns, hot_keys, left_lookup, unmatched, unmatched_counts


def skewed(spark):
    """A third of all rows on one key, a block of equal copies, null keys and orphans."""
    data = [("hot", i) for i in range(300)] + [("copy", 7)] * 200 + [(f"k{i}", i) for i in range(300)]
    data += [(None, i) for i in range(150)] + [("orphan", 1)]
    return spark.createDataFrame(data, "k string, v int").repartition(6)


def lookup(spark):
    names = ["hot", "copy", *[f"k{i}" for i in range(0, 300, 2)]]
    return spark.createDataFrame([(n, n.upper()) for n in names], "k string, name string")


def test_hot_keys_are_counted(spark):
    assert rows(hot_keys(skewed(spark), "k", 150)) == [(None, 150), ("copy", 200), ("hot", 300)]
    assert rows(hot_keys(skewed(spark), "k", 1000)) == []


def test_spread_join_equals_plain_join(spark):
    fact, side = skewed(spark), lookup(spark)
    plain = fact.join(side, "k", "left")
    spread = left_lookup(fact, side, "k", spread=True, hot_rows=20)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_spread_join_splits_the_hot_key(spark):
    """No join task may hold the hot key alone: its rows carry many salts."""
    fact, side = skewed(spark), lookup(spark)
    spread = left_lookup(fact, side, "k", spread=True, hot_rows=20)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan
    cold = left_lookup(fact, side, "k", spread=True, hot_rows=10_000)
    assert "__salt" not in cold._jdf.queryExecution().optimizedPlan().toString()


def test_spread_join_keeps_fanout(spark):
    fact, side = skewed(spark), lookup(spark)
    twice = side.unionByName(side)
    assert rows(left_lookup(fact, twice, "k", spread=True, hot_rows=20)) == rows(fact.join(twice, "k", "left"))


def test_keys_may_be_counted_on_a_cheaper_table(spark):
    fact, side = skewed(spark), lookup(spark)
    spread = left_lookup(fact, side, "k", keys_from=Owner(fact.select("k")), spread=True, hot_rows=20)
    assert rows(spread) == rows(fact.join(side, "k", "left"))


def test_small_lookup_is_broadcast(spark):
    small = left_lookup(skewed(spark), stage(lookup(spark), "lookup"), "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_large_lookup_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = left_lookup(skewed(spark), lookup(spark), "k")
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert rows(large) == rows(skewed(spark).join(lookup(spark), "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_add_new_columns_keeps_the_left_value(spark):
    left = spark.createDataFrame([(1, 10.0, "UPI")], "order_id int, amount double, payment_method string")
    right = spark.createDataFrame([(1, 99.0, "x", "Success")], "order_id int, amount double, payment_method string, payment_status string")
    assert rows(add_new_columns(left, right, "order_id")) == [(1, 10.0, "UPI", "Success")]
    assert add_new_columns(left, right.drop("order_id"), "order_id").columns == left.columns


def test_unmatched_counts_null_and_ghost_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("ghost",), ("ghost",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "id string")
    assert rows(unmatched_counts(child, parent, "k", "id")) == [(5, 3)]
    assert rows(unmatched(child, parent, "k", "id")) == [(None,), ("ghost",), ("ghost",)]
    assert rows(unmatched(child, parent, "k", "id", spread=True, hot_rows=2)) == [(None,), ("ghost",), ("ghost",)]
    assert rows(unmatched_counts(child.limit(0), parent, "k", "id")) == [(0, 0)]


def test_shared_folder_is_the_one_the_cluster_names(spark):
    from basketry.session import CHECKPOINT_SETTING, new_folder, shared_folder

    named = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_folder(spark) == named and new_folder(spark, "x").startswith(f"{named}/basketry/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")
