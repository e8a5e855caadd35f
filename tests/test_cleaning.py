from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.contracts import CONTRACTS, ORDER_PREVIEW, PAYMENT_METHOD_SPELLINGS
from basketry.functions.columns import (
    discounted, exact, mean_money, money, padded_id, percent, rounded_ratio, to_event_date, to_event_timestamp,
)
from basketry.operators import cleaning
from basketry.operators.decode import (
    decode_entity, decode_inferred, decode_typed, infer_schema, spark_type, unknown_fields, unreadable,
)

AT = dt.datetime(2024, 6, 1)


def lines(spark, *values):
    return spark.createDataFrame([(v, AT) for v in values], "value string, timestamp timestamp")


def test_event_date_takes_every_stand_in_for_missing(spark):
    texts = ["NaT", "", "null", None, "garbage", "2024-05-18T10:00:00", "2024-05-18T23:59:59.999999", "2024-05-18"]
    df = spark.createDataFrame([(t,) for t in texts], "event_time string")
    day = dt.date(2024, 5, 18)
    assert [r[0] for r in df.select(to_event_date(df)).collect()] == [None] * 5 + [day] * 3
    assert [r[0] for r in df.select(to_event_timestamp(F.col("event_time")).isNull()).collect()] == [True] * 5 + [False] * 3


def test_event_date_of_typed_columns(spark):
    df = spark.createDataFrame([(AT, AT.date())], "event_time timestamp, d date")
    assert df.select(to_event_date(df), to_event_date(df, "d")).first() == (AT.date(), AT.date())


def test_row_dedupe_keeps_a_redelivery_and_key_dedupe_does_not(spark):
    df = spark.createDataFrame(
        [("k", "v", 0, 1), ("k", "v", 0, 1), ("k", "v", 0, 2)], "message_key string, value string, partition int, offset int"
    )
    assert cleaning.clean(df).count() == 2
    assert rows(cleaning.dedupe_by_key(df, ["message_key"], ["offset"])) == [("k", "v", 0, 2)]


def test_clean_strips_blanks_last_unless_told(spark):
    df = spark.createDataFrame([("a", 1), (" a ", 1), (None, None)], "s string, n int")
    assert rows(cleaning.clean(df)) == [("a", 1), ("a", 1)]
    assert rows(cleaning.clean(df, trim_first=True)) == [("a", 1)]


def test_trim_leaves_other_types(spark):
    df = spark.createDataFrame([(" x ", 1, AT)], "s string, n int, t timestamp")
    assert rows(cleaning.trim_strings(df)) == [("x", 1, AT)]
    assert cleaning.trim_strings(df.select("n")).columns == ["n"]


def test_dedupe_by_key_is_the_latest_whole_row(spark):
    df = spark.createDataFrame(
        [("a", 1, "old", None), ("a", 2, None, 5), ("a", 2, None, 4), ("b", None, "x", 1)], "k string, t int, s string, n int"
    )
    assert rows(cleaning.dedupe_by_key(df, ["k"], ["t"])) == [("a", 2, None, 5), ("b", None, "x", 1)]
    assert rows(cleaning.dedupe_by_key(df, ["k"], ["t"], fill=True)) == [("a", 2, "old", 5), ("b", None, "x", 1)]


def test_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), (None, 2, "y"), ("a", 1, "z"), ("a", 2, "z")], "k string, t int, s string")
    assert rows(cleaning.dedupe_by_key(df, ["k"], ["t"])) == [(None, 2, "y"), ("a", 2, "z")]
    kept = cleaning.dedupe_by_key(df, ["k"], ["t"], keep_unkeyed=True)
    assert kept.columns == df.columns
    assert rows(kept) == [(None, 1, "x"), (None, 2, "y"), ("a", 2, "z")]


def test_dedupe_by_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 2, "x")], "k int, t int, s string")
    plan = cleaning.dedupe_by_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_canonicalize(spark):
    texts = [" UPI ", "upi", "U.P.I", "COD", "Bitcoin ", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "payment_method string")
    got = [r[0] for r in cleaning.canonicalize(df, "payment_method", PAYMENT_METHOD_SPELLINGS).collect()]
    assert got == ["UPI", "UPI", "UPI", "Cash on Delivery", "Bitcoin", None, ""]


def test_lookup_default(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = [r[0] for r in df.select(cleaning.lookup_literal(F.col("k"), {"a": "A"}, "dflt")).collect()]
    assert got == ["A", "dflt", "dflt"]


def test_quarantine_parts_make_up_the_input(spark):
    df = spark.createDataFrame([(1, 5.0), (-1, -2.0), (None, None), (-3, 1.0)], "quantity int, price double")
    flagged = cleaning.quarantine(df, {"q": F.col("quantity") < 0, "p": F.col("price") < 0})
    assert rows(flagged.select("quantity", F.concat_ws("+", "reasons"))) == [(None, ""), (-1, "q+p"), (-3, "q"), (1, "")]
    good, bad = cleaning.accepted(flagged), cleaning.rejected(flagged).drop("reasons")
    assert rows(good.unionByName(bad)) == rows(df)


# ----- decoding ---------------------------------------------------------------------------


def test_typed_decode_nulls_what_does_not_fit(spark):
    df = lines(
        spark, '{"order_id": "o1", "quantity": 3, "amount": 5.5, "event_time": "2024-05-18T10:00:00"}',
        '{"order_id": "o2", "quantity": "7"}', '{"order_id": "o3", "quantity": 1.0, "extra": true}', "{broken", None,
    )
    got = decode_typed(df, ORDER_PREVIEW).select("order_id", "quantity", "amount", "payment_id").collect()
    assert [tuple(r) for r in got] == [
        ("o1", 3, 5.5, None), ("o2", None, None, None), ("o3", None, None, None), (None,) * 4, (None,) * 4,
    ]


def test_contract_reads_whole_numbers_written_as_decimals(spark):
    df = lines(spark, '{"order_id": "o1", "quantity": 1.0}', '{"order_id": "o2", "quantity": 2, "coupon_code": "SAVE5"}')
    got = decode_entity(df, "orders").select("order_id", "quantity", "coupon_code", "kafka_timestamp").collect()
    assert [tuple(r) for r in got] == [("o1", 1.0, None, AT), ("o2", 2.0, "SAVE5", AT)]


def test_schema_merges_all_records(spark):
    df = lines(spark, '{"a": 1, "b": null}', '{"a": 2.5, "c": "x"}', '{"b": {"d": [1]}}', "junk", None)
    schema = infer_schema(df)
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "a": "decimal(21,1)", "b": "struct<d:array<bigint>>", "c": "string"
    }
    assert decode_inferred(df).columns == ["a", "b", "c", "kafka_timestamp"]


def test_null_fields_become_text_and_empty_tables_do_not_fail(spark):
    assert infer_schema(lines(spark, '{"a": null}')).fields[0].dataType == T.StringType()
    assert infer_schema(lines(spark).limit(0)).fields == []
    assert decode_inferred(lines(spark, "junk")).columns == ["kafka_timestamp"]
    assert spark_type("OBJECT<a: DECIMAL(21,1), b: VOID>") == T.DataType.fromDDL("STRUCT<a: DECIMAL(21,1), b: STRING>")


def test_inferred_types_keep_names_and_decimals(spark):
    kind = spark_type("OBJECT<VOID: DECIMAL(3,1), `a VARIANT`: VARIANT, b: ARRAY<VOID>, c: OBJECT<d: BIGINT>>")
    assert kind == T.StructType([
        T.StructField("VOID", T.DecimalType(3, 1)), T.StructField("a VARIANT", T.StringType()),
        T.StructField("b", T.ArrayType(T.StringType())), T.StructField("c", T.StructType([T.StructField("d", T.LongType())]))])


def test_drift_report_and_unreadable_rows(spark):
    df = lines(spark, '{"customer_id": "c", "loyalty": 1}', '{"loyalty": 2, "tier": null}', "{broken", None)
    assert rows(unknown_fields(df, CONTRACTS["customers"])) == [("loyalty", 2), ("tier", 1)]
    assert unreadable(df).count() == 2


# ----- numbers -------------------------------------------------------------------------------


def test_sums_are_exact_and_rounded_once(spark):
    df = spark.createDataFrame([(10.05, 0.5), (0.5, 0.01), (-0.29, 0.1), (10.005, 0.075), (1.5, None)], "price double, d double")
    assert [float(r[0]) for r in df.select(exact(F.col("price"))).collect()] == [10.05, 0.5, -0.29, 10.005, 1.5]
    less = [r[0] for r in df.select(discounted(F.col("price"), F.col("d"))).collect()]
    assert [None if v is None else float(v) for v in less] == [5.025, 0.495, -0.261, 9.254625, None]
    assert df.select(money(F.sum(discounted(F.col("price"), F.col("d"))))).first()[0] == 14.51  # by rows: 5.03 + 0.50 - 0.26 + 9.25
    halves = spark.createDataFrame([(0.005,), (-0.005,), (0.0049,)], "v double").select(money(exact(F.col("v"))))
    assert [r[0] for r in halves.collect()] == [0.01, -0.01, 0.0]
    one = spark.createDataFrame([(5, 2, 0), (-5, 2, 0), (1, 3, 0)], "s bigint, n bigint, z bigint")
    total = (F.col("s") / 100).cast("decimal(38,12)")
    assert [r[0] for r in one.select(mean_money(total, F.col("n"))).collect()] == [0.03, -0.03, 0.0]
    assert [r[0] for r in one.select(mean_money(total, F.col("z"))).collect()] == [None] * 3
    assert [r[0] for r in one.select(rounded_ratio(F.col("s"), F.col("z"), 2)).collect()] == [None] * 3
    assert [r[0] for r in one.select(percent(F.col("s"), F.col("n"))).collect()] == [250.0, -250.0, 33.33]


def test_padded_id_grows_beyond_its_width(spark):
    df = spark.createDataFrame([(7,), (12345678,)], "n bigint")
    assert [r[0] for r in df.select(padded_id("CUST", F.col("n"), 6)).collect()] == ["CUST000007", "CUST12345678"]
