"""Message, stream and layer queries."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.catalog import sqlkit as q
from basketry.catalog.registry import query
from basketry.catalog.retail import COPIED, KEY, RETAIL, copied_orders
from basketry.contracts import ENTITIES, FAULT_SHARES, ORDER_PREVIEW
from basketry.functions.columns import chosen
from basketry.operators import cleaning, faults
from basketry.operators.decode import decode_inferred, decode_typed, field_presence, payload_type, unknown_fields
from basketry.plans import shop
from basketry.plans.roles import STAR_SCHEMAS, StarRetail, read_table
from basketry.session import new_folder, stage
from basketry.sources import files
from basketry.sources.lake import Lake, layer_counts, preview
from basketry.sources.messages import envelope, message_key, number_lines, publish_counted, publish_stats, to_messages
from basketry.streaming.ingest import as_topic, folder_stream, land, land_all, late_flag, parsed, preview_stream
from basketry.streaming.state import fan_out, first_arrivals, share_of, split_late, window_sums

# ----- messages of the events table ---------------------------------------------------

EVENT_JSON_SQL = (
    "'{\"event_id\":' || event_id || ',\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\",\"cents\":'"
    " || CAST(round(value * 100) AS BIGINT) || ',\"at\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '\"}'"
)
ENVELOPE_SQL = (
    f"SELECT CAST(event_id AS VARCHAR) AS message_key, {EVENT_JSON_SQL} AS value, event_type AS topic,"
    " CAST(event_id % 4 AS INTEGER) AS \"partition\", event_id AS \"offset\", ts AS \"timestamp\" FROM events"
)


def event_value():
    return files.json_text(
        F.col("event_id"), F.col("user_id"), F.col("event_type"), F.rint(F.col("value") * 100).cast("bigint").alias("cents"),
        F.date_format("ts", files.ISO_SECONDS).alias("at"),
    )


def event_topic(df):
    """Events in the shape a broker delivers."""
    return as_topic(
        df, F.col("event_id"), event_value(), F.col("event_type"), F.pmod("event_id", F.lit(4)), F.col("event_id"), F.col("ts")
    )


def event_stream(spark, sf):
    return event_topic(folder_stream(spark, sf, STAR_SCHEMAS["events"], "events.parquet"))


def event_messages(spark, sf):
    """The same messages as a table."""
    return envelope(event_topic(read_table(spark, sf, "events")))


@query("ingest_envelope", ENVELOPE_SQL)
def _ingest_envelope(spark, sf):
    lake = Lake(spark, root=new_folder(spark, "ingest"))
    land(lake, event_stream(spark, sf), "bronze_events", f"{lake.root}/checkpoints/events")
    return lake.read("bronze_events")


@query("bronze_append", "SELECT event_type AS topic, COUNT(*) AS messages, MIN(event_id) AS first, MAX(event_id) AS last FROM events GROUP BY 1")
def _bronze_append(spark, sf):
    """Two runs on one checkpoint: the second finds nothing new."""
    lake = Lake(spark, root=new_folder(spark, "bronze"))
    for _ in range(2):
        land(lake, event_stream(spark, sf), "bronze_events", f"{lake.root}/checkpoints/events")
    return lake.read("bronze_events").groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first"), F.max("offset").alias("last")
    )


def star_topics(spark, sf):
    """One stream per entity over the star files."""

    def topic(name, table, key, fields, at):
        df = folder_stream(spark, sf, STAR_SCHEMAS[table], f"{table}.parquet")
        value = files.json_text(*[F.col(column).alias(alias) for alias, column in fields.items()])
        return as_topic(df, F.col(key), value, F.lit(name), F.pmod(key, F.lit(4)), F.col(key), at)

    unknown = F.lit("2024-06-01 00:00:00").cast("timestamp")
    return {
        "customers": topic("customers", "customer", "c_custkey", {"customer_id": "c_custkey", "name": "c_name", "gender": "c_mktsegment"}, unknown),
        "products": topic("products", "part", "p_partkey", {"product_id": "p_partkey", "product_name": "p_name", "brand": "p_brand"}, unknown),
        "orders": topic("orders", "lineitem", "l_orderkey", {
            "order_id": "l_orderkey", "product_id": "l_partkey", "quantity": "l_quantity", "amount": "l_extendedprice", "event_time": "l_shipdate",
        }, F.col("l_shipdate")),
        "payments": topic("payments", "orders", "o_orderkey", {"payment_id": "o_orderkey", "order_id": "o_orderkey", "payment_status": "o_orderstatus"}, F.col("o_orderdate")),
        "shipping": topic("shipping", "lineitem", "l_orderkey", {"order_id": "l_orderkey", "delivery_status": "l_returnflag"}, F.col("l_shipdate")),
    }


@query("ingest_all_topics", " UNION ALL ".join(
    f"SELECT '{name}' AS topic, COUNT(*) AS messages, COUNT(DISTINCT {key}) AS keys, MIN({key}) AS first, MAX({key}) AS last FROM {table}"
    for name, table, key in (
        ("customers", "customer", "c_custkey"), ("products", "part", "p_partkey"), ("orders", "lineitem", "l_orderkey"),
        ("payments", "orders", "o_orderkey"), ("shipping", "lineitem", "l_orderkey"),
    )))
def _ingest_all_topics(spark, sf):
    """Five concurrent streams into five bronze tables."""
    lake = Lake(spark, root=new_folder(spark, "topics"))
    names = land_all(lake, star_topics(spark, sf), f"{lake.root}/checkpoints")
    landed = lake.read(names[0])
    for name in names[1:]:
        landed = landed.unionByName(lake.read(name))
    return landed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("message_key").alias("keys"),
        F.min("offset").alias("first"), F.max("offset").alias("last"),
    )


@query("ingest_fan_out", " UNION ALL ".join(
    f"SELECT '{name}' AS topic, COUNT(*) AS messages, COUNT(DISTINCT {key}) AS keys, MIN({key}) AS first, MAX({key}) AS last FROM {table}"
    for name, table, key in (
        ("customers", "customer", "c_custkey"), ("products", "part", "p_partkey"), ("orders", "lineitem", "l_orderkey"),
        ("payments", "orders", "o_orderkey"), ("shipping", "lineitem", "l_orderkey"),
    )))
def _ingest_fan_out(spark, sf):
    """One subscription of five topics, split by topic as it lands."""
    lake = Lake(spark, root=new_folder(spark, "fan-out"))
    topics = star_topics(spark, sf)
    raw = functools.reduce(DataFrame.unionByName, topics.values())
    fan_out(lake, envelope(raw), "bronze", "topic", f"{lake.root}/checkpoints/bronze")
    landed = functools.reduce(DataFrame.unionByName, [share_of(lake, "bronze", "topic", t) for t in topics])
    return landed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.count_distinct("message_key").alias("keys"), F.min("offset").alias("first"), F.max("offset").alias("last"))


# ----- streams with state -------------------------------------------------------------------

SLICES = 4


def sliced_events(spark, sf):
    """Events in files of a new folder, in the order of their time, some sent again, half of these a file later; returns the folder and a file's seconds."""
    events = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    ends = events.agg(F.min("ts").cast("bigint").alias("lo"), F.max("ts").cast("bigint").alias("hi")).first()
    width = (ends["hi"] - ends["lo"]) // SLICES + 1
    sent = faults.add_copies(events, "event_id", 0.2, "sent-again")
    later = (F.col("copy_no") == 1) & chosen(0.5, "sent-later", F.col("event_id"))
    number = F.least(F.floor((F.col("ts").cast("bigint") - ends["lo"]) / width) + later.cast("int"), F.lit(SLICES - 1))
    sent, folder = stage(sent.withColumn("slice", number), "slices"), new_folder(spark, "sliced-events")
    for i in range(SLICES):
        sent.where(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(folder)
    return folder, width


_EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, copy_no int"


@query("stream_dedupe", "SELECT event_id, ts, user_id, event_type FROM events")
def _stream_dedupe(spark, sf):
    """Four batches, copies in the same and in the next one: each event once."""
    folder, width = sliced_events(spark, sf)
    lake = Lake(spark, root=new_folder(spark, "first-arrivals"))
    events = first_arrivals(folder_stream(spark, folder, _EVENT, "*.parquet", 1), ["event_id"], "ts", f"{2 * width} seconds")
    lake.append_stream(events, "events", f"{lake.root}/checkpoints/events").awaitTermination()
    return lake.read("events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")


@query("stream_window_sums", """SELECT date_trunc('hour', ts) AS start, COUNT(*) AS rows, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM events GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR""")
def _stream_window_sums(spark, sf):
    """Hours that the watermark has closed, over four batches; the copies are dropped ahead of them."""
    folder, _ = sliced_events(spark, sf)
    lake = Lake(spark, root=new_folder(spark, "window-sums"))
    events = folder_stream(spark, folder, _EVENT, "*.parquet", 1).where("copy_no = 0")
    sums = window_sums(events, "ts", "2 hours", "1 hour", cents=F.rint(F.col("value") * 100).cast("bigint"))
    lake.append_stream(sums, "sums", f"{lake.root}/checkpoints/sums").awaitTermination()
    return lake.read("sums").select(F.col("start").cast("timestamp_ntz").alias("start"), "rows", "cents")


@query("stream_late_split", f"""SELECT {q.chosen(FAULT_SHARES['late'], 'late', 'event_id')} AS is_late, event_type, COUNT(*) AS rows FROM events GROUP BY ALL""")
def _stream_late_split(spark, sf):
    """Late rows and rows on time land apart, and make up all rows."""
    lake = Lake(spark, root=new_folder(spark, "late"))
    events = folder_stream(spark, sf, STAR_SCHEMAS["events"], "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    timed = faults.add_ingestion_time(events, "event_id", "ts", FAULT_SHARES["late"])
    running = [
        lake.append_stream(rows, name, f"{lake.root}/checkpoints/{name}")
        for name, rows in zip(("on_time", "late"), split_late(timed, late_flag(F.col("ts"), F.col("ingestion_time"))))]
    for stream in running:
        stream.awaitTermination()
    both = lake.read("on_time").withColumn("is_late", F.lit(False)).unionByName(lake.read("late").withColumn("is_late", F.lit(True)))
    return both.groupBy("is_late", "event_type").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_preview_raw", f"SELECT * FROM ({ENVELOPE_SQL}) ORDER BY \"offset\" LIMIT 50")
def _stream_preview_raw(spark, sf):
    """The first fifty messages to arrive, from the memory sink."""
    return preview_stream(envelope(event_stream(spark, sf)), f"preview_raw_{uuid.uuid4().hex}", 50)


_PARSED_ORDER = ["order_id", "product_id", "quantity", "amount", "event_time"]


@query("stream_preview_parsed", """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS amount, CAST(NULL AS VARCHAR) AS payment_id, CAST(NULL AS VARCHAR) AS shipment_id,
  l_shipdate AS event_time FROM lineitem ORDER BY order_id, product_id, quantity, amount, event_time LIMIT 50""")
def _stream_preview_parsed(spark, sf):
    """Orders typed on the stream; ids the payload lacks are null."""
    lines = folder_stream(spark, sf, STAR_SCHEMAS["lineitem"], "lineitem.parquet")
    value = files.json_text(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("event_time"),
    )
    typed = parsed(lines.select(value.alias("value")), ORDER_PREVIEW)
    lake = Lake(spark, root=new_folder(spark, "preview-parsed"))
    lake.append_stream(typed, "parsed", f"{lake.root}/checkpoints/parsed").awaitTermination()
    return preview(lake.read("parsed"), 50, _PARSED_ORDER)


# ----- publishing ---------------------------------------------------------------------------


def event_lines(spark, sf):
    """JSON lines; some lack the key field, some have it null, some are cut off."""
    k = F.col("event_id")
    rest = [F.col("user_id"), F.col("event_type")]
    value = (
        F.when(chosen(0.03, "no-key", k), files.json_text(*rest))
        .when(chosen(0.03, "null-key", k), files.json_text(F.lit(None).cast("bigint").alias("event_id"), *rest))
        .when(chosen(0.03, "cut", k), F.concat(F.lit('{"event_id":'), k.cast("string")))
        .otherwise(files.json_text(k, *rest))
    )
    return read_table(spark, sf, "events").select("event_id", F.col("event_type").alias("topic"), value.alias("value"))


_REST_SQL = "'\"user_id\":' || user_id || ',\"event_type\":\"' || event_type || '\"}'"
_NO_KEY, _NULL_KEY, _CUT = (q.chosen(0.03, s, "event_id") for s in ("no-key", "null-key", "cut"))


@query("publish_messages", f"""SELECT CASE WHEN {_NO_KEY} THEN CAST(event_id AS VARCHAR) WHEN {_NULL_KEY} THEN 'None' ELSE CAST(event_id AS VARCHAR) END AS key,
  CASE WHEN {_NO_KEY} THEN '{{' || {_REST_SQL} WHEN {_NULL_KEY} THEN '{{"event_id":null,' || {_REST_SQL} ELSE '{{"event_id":' || event_id || ',' || {_REST_SQL} END AS value,
  'events' AS topic FROM events WHERE {_NO_KEY} OR {_NULL_KEY} OR NOT {_CUT}""")
def _publish_messages(spark, sf):
    """A line without its key field takes its running number; events are stored in the order of their ids."""
    numbered = number_lines(event_lines(spark, sf).drop("topic"))
    return to_messages(numbered, "events", F.col("line"), "event_id")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("publish_stats", f"""SELECT event_type AS topic, COUNT(*) FILTER ({_NO_KEY} OR {_NULL_KEY} OR NOT {_CUT}) AS published,
  COUNT(*) FILTER (NOT ({_NO_KEY} OR {_NULL_KEY} OR NOT {_CUT})) AS failed FROM events GROUP BY 1""")
def _publish_stats(spark, sf):
    """Counted by the job that sends the messages, here to a folder."""
    sent = Lake(spark, root=new_folder(spark, "sent"))
    lines = event_lines(spark, sf)
    return publish_counted(lines, EVENT_TYPES, lambda good: sent.overwrite(
        good.select(message_key(F.col("value"), "event_id", F.col("event_id")).alias("key"), "value", "topic"), "messages"))


@query("publish_report", f"""SELECT event_type AS topic, COUNT(*) FILTER ({_NO_KEY} OR {_NULL_KEY} OR NOT {_CUT}) AS published,
  COUNT(*) FILTER (NOT ({_NO_KEY} OR {_NULL_KEY} OR NOT {_CUT})) AS failed FROM events GROUP BY 1""")
def _publish_report(spark, sf):
    """The same figures of lines that are already stored, whatever their topics."""
    return publish_stats(event_lines(spark, sf))


# ----- files ------------------------------------------------------------------------------------

@query("csv_roundtrip", "SELECT * FROM part")
def _csv_roundtrip(spark, sf):
    folder = new_folder(spark, "csv")
    files.write_csv(read_table(spark, sf, "part"), folder)
    return files.read_csv(spark, folder, T.StructType.fromDDL(STAR_SCHEMAS["part"]))


@query("jsonl_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _jsonl_roundtrip(spark, sf):
    """Rows to JSON lines on storage and back by contract."""
    orders = read_table(spark, sf, "orders").drop("o_orderdate")
    folder = new_folder(spark, "jsonl")
    files.write_lines(files.encode(orders), folder)
    return files.read_json_lines(spark, folder, orders.schema)


# ----- decoding -----------------------------------------------------------------------------------


@query("infer_payload_schema", """SELECT 'OBJECT<' || string_agg(field || ': ' || kind, ', ' ORDER BY field) || '>' AS payload_type FROM (
  SELECT field, CASE json_type(props, '$.' || field) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || field) END AS kind
  FROM (SELECT props, unnest(json_keys(props)) AS field FROM events) GROUP BY ALL)""")
def _infer_payload_schema(spark, sf):
    return payload_type(read_table(spark, sf, "events"), "props")


@query("decode_inferred", f"""SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "at", ts AS kafka_timestamp FROM events""")
def _decode_inferred(spark, sf):
    return decode_inferred(event_messages(spark, sf))


_BAD_DOC, _TEXT_QTY = q.chosen(0.02, "doc", "l_orderkey", "l_linenumber"), q.chosen(0.02, "text", "l_orderkey", "l_linenumber")


@query("decode_typed", f"""SELECT CASE WHEN NOT {_BAD_DOC} THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN NOT {_BAD_DOC} THEN CAST(l_partkey AS VARCHAR) END AS product_id,
  CASE WHEN NOT {_BAD_DOC} AND NOT {_TEXT_QTY} THEN CAST(l_quantity AS INTEGER) END AS quantity,
  CASE WHEN NOT {_BAD_DOC} THEN l_extendedprice END AS amount, CASE WHEN NOT {_BAD_DOC} THEN l_shipdate END AS event_time FROM lineitem""")
def _decode_typed(spark, sf):
    """A field of the wrong type is null, a broken document is null throughout."""
    at = [F.col("l_orderkey"), F.col("l_linenumber")]
    qty = F.col("l_quantity").cast("int")
    fields = [
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("event_time"),
    ]
    value = (
        F.when(chosen(0.02, "doc", *at), F.lit("{broken"))
        .when(chosen(0.02, "text", *at), files.json_text(*fields, qty.cast("string").alias("quantity")))
        .otherwise(files.json_text(*fields, qty.alias("quantity")))
    )
    lines = read_table(spark, sf, "lineitem").select(value.alias("value"))
    return decode_typed(lines, ORDER_PREVIEW).select(*_PARSED_ORDER)


@query("payload_fields", "SELECT field, COUNT(*) AS messages FROM (SELECT unnest(json_keys(props)) AS field FROM events) GROUP BY 1")
def _payload_fields(spark, sf):
    return field_presence(read_table(spark, sf, "events"), "props")


@query("unknown_payload_fields", "SELECT 'at' AS field, COUNT(*) AS messages FROM events UNION ALL SELECT 'cents', COUNT(*) FROM events")
def _unknown_payload_fields(spark, sf):
    """Fields of the messages that a narrower contract does not name."""
    narrow = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string")
    return unknown_fields(event_messages(spark, sf), narrow)


# ----- layers -----------------------------------------------------------------------------------------


@query("silver_clean", f"""SELECT trim(message_key) AS message_key, value, topic, "partition", "offset" FROM (
  SELECT DISTINCT * FROM (SELECT message_key, value, topic, "partition", "offset" FROM ({ENVELOPE_SQL})
  UNION ALL SELECT CASE WHEN {q.chosen(0.5, 'pad', '"offset"')} THEN ' ' || message_key || '  ' ELSE message_key END, value, topic, "partition", "offset"
  FROM ({ENVELOPE_SQL}) WHERE {q.chosen(0.1, 'again', '"offset"')}))""")
def _silver_clean(spark, sf):
    """Exact copies go; copies that differ in blanks stay, because blanks are stripped last."""
    sent = faults.add_copies(event_messages(spark, sf).drop("timestamp"), "offset", 0.1, "again")
    padded = F.concat(F.lit(" "), F.col("message_key"), F.lit("  "))
    key = F.when((F.col("copy_no") == 1) & chosen(0.5, "pad", F.col("offset")), padded).otherwise(F.col("message_key"))
    bronze = Lake(spark, root=new_folder(spark, "sent-twice")).overwrite(sent.withColumn("message_key", key).drop("copy_no"), "bronze_events")
    return cleaning.clean_stored(bronze)


def _envelope_of(df, topic, key, offset, at):
    fields = [c for c in df.columns if c not in ("copy_no", "low", "high")]
    copy = F.col("copy_no") if "copy_no" in df.columns else F.lit(0)
    return df.select(
        F.col(key).alias("message_key"), files.json_text(*[F.col(c) for c in fields]).alias("value"), F.lit(topic).alias("topic"),
        F.pmod(offset, F.lit(4)).cast("int").alias("partition"), (offset * 2 + copy).cast("bigint").alias("offset"),
        (at + F.make_dt_interval(mins=copy)).alias("timestamp"),
    )


def retail_messages(spark, sf):
    """Bronze rows of the five entities; re-deliveries carry a new offset."""
    share = FAULT_SHARES["duplicate"]
    today = F.lit(q.TODAY).cast("timestamp")
    sold = copied_orders(spark, sf)
    paid = faults.add_copies(shop.payments(spark, sf), KEY, share, "copy-payments")
    who = faults.add_copies(shop.customers(spark, sf), "customer_id", share, "copy-customers")
    number = F.substring("customer_id", 5, 20).cast("bigint")
    return {
        "customers": _envelope_of(who, "customers", "customer_id", number, today),
        "products": _envelope_of(shop.products(spark, sf), "products", "product_id", F.substring("product_id", 5, 20).cast("bigint"), today),
        "orders": _envelope_of(sold, "orders", "order_id", F.col(KEY), F.col("event_time")),
        "payments": _envelope_of(paid, "payments", "payment_id", F.col(KEY), today),
        "shipping": _envelope_of(shop.shipping(spark, sf), "shipping", "shipment_id", F.col(KEY), today),
    }


_LAYERS_SQL = f"""{COPIED}, {q.SHOP_PAID}, {q.copies('paid2', 'paid', KEY, salt='copy-payments')}, {q.copies('people2', 'people', 'customer_id', salt='copy-customers')},
sizes AS (SELECT 'customers' AS "table", COUNT(*) AS n FROM people2 UNION ALL SELECT 'products', COUNT(*) FROM items
UNION ALL SELECT 'orders', COUNT(*) FROM copied UNION ALL SELECT 'payments', COUNT(*) FROM paid2 UNION ALL SELECT 'shipping', COUNT(*) FROM retail)"""


def twice_sent(messages):
    """Every message twice at the same offset, as after a failed commit."""
    return {name: df.unionByName(df) for name, df in messages.items()}


def build_layers(spark, sf):
    """Write bronze and silver tables of the five entities; returns the lake."""
    lake = Lake(spark, root=new_folder(spark, "layers"))
    for name, df in twice_sent(retail_messages(spark, sf)).items():
        bronze = lake.overwrite(df, f"bronze_{name}")
        lake.overwrite(cleaning.clean_stored(bronze), f"silver_{name}")
    return lake


@query("layer_counts", f'{_LAYERS_SQL} SELECT "table", 2 * n AS bronze_count, n AS silver_count FROM sizes')
def _layer_counts(spark, sf):
    lake = build_layers(spark, sf)
    return layer_counts(
        {n: lake.read(f"bronze_{n}") for n in ENTITIES}, {n: lake.read(f"silver_{n}") for n in ENTITIES}
    )


@query("silver_build", f"""{_LAYERS_SQL} SELECT 'orders' AS topic, order_id AS message_key, CAST(order_seq % 4 AS INTEGER) AS "partition",
  order_seq * 2 + copy_no AS "offset" FROM copied""")
def _silver_build(spark, sf):
    """Silver orders: one row per message although each was stored twice."""
    return build_layers(spark, sf).read("silver_orders").select("topic", "message_key", "partition", "offset")


@query("silver_by_key", f"{RETAIL} SELECT order_seq, order_id, customer_id, product_id FROM retail")
def _silver_by_key(spark, sf):
    """Keyed de-duplication removes re-deliveries that row de-duplication cannot."""
    return cleaning.dedupe_by_key(copied_orders(spark, sf), ["order_id"], ["copy_no"]).select(
        KEY, "order_id", "customer_id", "product_id"
    )
