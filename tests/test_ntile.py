from __future__ import annotations

import hashlib
import random

import pytest
from conftest import rows

from basketry.operators.faults import sample_exact
from basketry.operators.ntile import add_ntiles, cut_points, ranked, tile_ends
from basketry.session import stage


def expected(data, tiles):
    """ntile by sorting everything: the definition."""
    order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(str(r[0]).encode()).hexdigest()))
    size, longer = divmod(len(order), tiles)
    out, at = {}, 0
    for tile in range(1, tiles + 1):
        step = size + (1 if tile <= longer else 0)
        out |= {r[0]: tile for r in order[at:at + step]}
        at += step
    return out


def cases():
    rng = random.Random(5)
    yield "spread", [(i, rng.randrange(10**9)) for i in range(500)]
    yield "ties", [(i, rng.choice([1, 1, 1, 2])) for i in range(301)]
    yield "all equal", [(i, 42) for i in range(100)]
    yield "one outlier", [(i, i % 5) for i in range(200)] + [(999, 10**15)]
    yield "widest", [(i, (-(1 << 63) + 1 + i) if i % 2 else (1 << 63) - 1 - i) for i in range(60)]
    yield "nulls", [(i, None if i % 3 else i) for i in range(100)]
    yield "only nulls", [(i, None) for i in range(10)]
    yield "negative", [(i, rng.randrange(-1000, 1000)) for i in range(250)]
    for n in range(6):
        yield f"{n} rows", [(i, 10 - i) for i in range(n)]


@pytest.mark.parametrize("name,data", list(cases()), ids=[c[0] for c in cases()])
@pytest.mark.parametrize("tiles", [3, 4])
def test_cut_points_give_exact_tiles(spark, name, data, tiles):
    df = spark.createDataFrame(data, "id long, v long")
    want = expected(data, tiles)
    got = add_ntiles(df, {"t": "v"}, "id", tiles)
    assert {r["id"]: r["t"] for r in got.collect()} == want


def test_large_path_has_no_single_partition_window(spark):
    df = stage(spark.createDataFrame([(i, i * 7 % 11) for i in range(100)], "id long, v long"), "t")
    plan = add_ntiles(df, {"t": "v"}, "id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_all_orders_take_one_shuffle_and_few_jobs(spark):
    df = stage(spark.createDataFrame([(i, i * 7 % 11, -i, i % 3) for i in range(300)], "id long, a long, b long, c long"), "t")
    spark.sparkContext.setJobGroup("ranks", "ranks")
    cut_points(df, ["a", "b", "c"], "id", 3)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("ranks")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 8  # borders, ranges, sizes and ends, with their shuffles, for three orders
    places = ranked(df, ["a", "b"], "id")
    order = [tuple(r) for r in places.orderBy("part", "at").select("order", "value", "digest").collect()]
    assert order == sorted(order) and len(order) == 600


def test_two_columns_share_the_passes(spark):
    df = spark.createDataFrame([(i, i % 7, -i) for i in range(90)], "id long, a long, b long")
    cuts = cut_points(df, ["a", "b"], "id", 3)
    assert [len(c) for c in cuts.values()] == [2, 2]


def test_tile_ends():
    assert tile_ends(10, 3) == [4, 7]
    assert tile_ends(2, 3) == [1, 2]
    assert tile_ends(0, 3) == [0, 0]


def test_sample_exact_size(spark):
    df = spark.range(1000)
    assert sample_exact(df, "id", 0.037, "s").count() == 37
    assert sample_exact(df, "id", 0.00001, "s").count() == 1
    assert sample_exact(df, "id", 2.0, "s").count() == 1000
    assert sample_exact(df, "id", 0.0, "s").count() == 0
    assert sample_exact(spark.range(0), "id", 0.5, "s").count() == 0
    assert rows(sample_exact(df, "id", 0.05, "s")) == rows(sample_exact(df.repartition(7), "id", 0.05, "s"))
    assert rows(sample_exact(df, "id", 0.05, "s")) != rows(sample_exact(df, "id", 0.05, "other"))
