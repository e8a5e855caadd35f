"""Streams with state: several batches and restarts against the batch figures."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.session import new_folder
from basketry.sources.lake import Lake
from basketry.sources.messages import publish_counted
from basketry.streaming import state
from basketry.streaming.ingest import folder_stream, late_flag

AT = dt.datetime(2024, 6, 1)
ROW = "id bigint, topic string, at timestamp, amount bigint"


def put(spark, folder, *batches):
    """One file a batch; a row is (id, topic, minutes)."""
    for batch in batches:
        spark.createDataFrame([(i, t, AT + dt.timedelta(minutes=m), i) for i, t, m in batch], ROW).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return folder_stream(spark, folder, ROW, "*.parquet", 1)


def test_fan_out_repeats_a_batch_after_a_crash(spark, monkeypatch):
    folder, lake = new_folder(spark, "in"), Lake(spark, root=new_folder(spark, "lake"))
    put(spark, folder, [(1, "a", 0), (2, "b", 0)], [(3, "a", 1), (4, "c", 1)])
    write, calls = state.land_batch, []

    def crash(*arguments):
        write(*arguments)  # the rows are there, but the batch is not committed
        calls.append(arguments[2])
        if calls == [0, 1]:
            raise RuntimeError("lost")

    monkeypatch.setattr(state, "land_batch", crash)
    with pytest.raises(Exception):
        state.fan_out(lake, source(spark, folder), "bronze", "topic", f"{lake.root}/cp")
    monkeypatch.setattr(state, "land_batch", lambda *a: (calls.append(a[2]), write(*a))[1])
    put(spark, folder, [(5, "a", 2)])
    state.fan_out(lake, source(spark, folder), "bronze", "topic", f"{lake.root}/cp")
    assert calls == [0, 1, 1, 2]
    assert rows(lake.read("bronze").select("id", "topic")) == [(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "a")]
    only = state.share_of(lake, "bronze", "topic", "a")
    assert rows(only.select("id")) == [(1,), (3,), (5,)]
    assert "PartitionFilters: [isnotnull(topic" in only._jdf.queryExecution().executedPlan().toString()


def test_first_arrivals_over_batches_and_a_restart(spark):
    folder, lake = new_folder(spark, "in"), Lake(spark, root=new_folder(spark, "lake"))

    def run():
        events = state.first_arrivals(source(spark, folder), ["id"], "at", "30 minutes")
        lake.append_stream(events, "events", f"{lake.root}/cp").awaitTermination()
        return rows(lake.read("events").select("id", "topic"))

    put(spark, folder, [(1, "a", 0), (1, "a", 0), (2, "a", 5)], [(1, "a", 10), (3, "a", 12)])
    assert run() == [(1, "a"), (2, "a"), (3, "a")]
    put(spark, folder, [(3, "a", 20), (4, "a", 21)])
    assert run() == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]
    assert run() == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]


def test_windows_close_once_with_the_batch_figures(spark):
    folder, lake = new_folder(spark, "in"), Lake(spark, root=new_folder(spark, "lake"))
    batches = [[(i, "a", m) for i, m in enumerate(minutes)] for minutes in ((0, 5, 61), (20, 70, 100), (95, 130, 200), (210, 330))]

    def run():
        sums = state.window_sums(source(spark, folder), "at", "1 hour", "1 hour", amount=F.col("amount"))
        lake.append_stream(sums, "sums", f"{lake.root}/cp").awaitTermination()
        return rows(lake.read("sums").select("start", "rows", "amount"))

    put(spark, folder, *batches[:2])
    first = run()
    put(spark, folder, *batches[2:])
    every = [(m // 60, i) for b in batches for i, _, m in b]
    closed = [h for h in sorted({h for h, _ in every}) if (h + 1) * 60 <= 330 - 60]
    want = [(AT + dt.timedelta(hours=h), sum(x == h for x, _ in every), sum(i for x, i in every if x == h)) for h in closed]
    assert run() == want and set(first) < set(want)


def test_late_rows_go_apart_and_nothing_is_dropped(spark):
    folder, lake = new_folder(spark, "in"), Lake(spark, root=new_folder(spark, "lake"))
    # (id, event minute, minute of arrival), in the order of arrival: 7 and 8 come too late for their window
    sent = [(1, 0, 1), (2, 30, 31), (3, 90, 91), (4, 200, 201), (7, 10, 210), (5, 260, 261), (8, 5, 300), (6, 500, 501)]
    for part in (sent[:3], sent[3:5], sent[5:]):
        spark.createDataFrame([(i, "a", AT + dt.timedelta(minutes=m), i, AT + dt.timedelta(minutes=n)) for i, m, n in part], ROW + ", seen timestamp").coalesce(1).write.mode("append").parquet(folder)
    stream = folder_stream(spark, folder, ROW + ", seen timestamp", "*.parquet", 1)
    on_time, late = state.split_late(stream, late_flag(F.col("at"), F.col("seen"), "1 hour"))
    sums = state.window_sums(on_time, "at", "1 hour", "1 hour", amount=F.col("amount"))
    for name, df in (("sums", sums), ("late", late), ("on_time", on_time)):
        lake.append_stream(df, name, f"{lake.root}/cp/{name}").awaitTermination()
    assert rows(lake.read("late").select("id")) == [(7,), (8,)]
    assert sorted(r["id"] for n in ("late", "on_time") for r in lake.read(n).collect()) == list(range(1, 9))
    assert rows(lake.read("sums").select("rows", "amount")) == sorted([(2, 3), (1, 3), (1, 4), (1, 5)])


def test_counters_of_the_sending_job(spark):
    data = [("a", '{"id": 1}'), ("a", "{cut"), ("b", '{"id": 2}'), ("a", None), ("x", '{"id": 3}'), (None, "{")]
    lines = spark.createDataFrame(data, "topic string, value string")
    lake = Lake(spark, root=new_folder(spark, "sent"))
    got = publish_counted(lines, ("a", "b", "c"), lambda good: lake.overwrite(good, "messages"))
    assert rows(got) == [(None, 1, 1), ("a", 1, 2), ("b", 1, 0), ("c", 0, 0)]
    assert rows(lake.read("messages")) == [("a", '{"id": 1}'), ("b", '{"id": 2}'), ("x", '{"id": 3}')]
