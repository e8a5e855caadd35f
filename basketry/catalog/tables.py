"""Quality and quarantine of the star tables, with faults put into their own columns.

Every table gets copies, nulls, ghost keys and invalid values in a share of its rows, drawn from
its row key, so that the SQL finds the same ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.catalog import sqlkit as q
from basketry.catalog.registry import query
from basketry.contracts import FAULT_SHARES
from basketry.operators import cleaning, faults, quality
from basketry.operators.joins import unmatched
from basketry.plans.roles import read_table
from basketry.session import new_folder
from basketry.sources.lake import Lake

NOW = f"TIMESTAMP '{q.TODAY} 00:00:00'"
KEY, AT = "row_key", ("row_key", "copy_no")

#: Table: its row key, its columns, those that lose values, those that point at another table.
FAULTY = {
    "customer": ("c_custkey", "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "c_name c_mktsegment", ""),
    "part": ("p_partkey", "p_partkey p_name p_brand p_type p_retailprice", "p_type", ""),
    "orders": ("o_orderkey", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "o_orderpriority o_orderstatus", "o_custkey"),
    "lineitem": (
        "l_orderkey * 8 + l_linenumber", "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_discount l_returnflag l_shipdate",
        "l_returnflag l_shipdate", "l_orderkey l_partkey l_suppkey"),
    "events": ("event_id", "event_id ts user_id event_type value", "value event_type", ""),
}
#: Columns that make up a table's id.
IDS = {"customer": ["c_custkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}


def copied(spark, sf, table):
    """Columns of a table, some rows twice."""
    key, columns, *_ = FAULTY[table]
    df = read_table(spark, sf, table).select(*columns.split(), F.expr(key).cast("bigint").alias(KEY))
    return df.transform(faults.add_copies, KEY, FAULT_SHARES["duplicate"], f"copy-{table}")


def faulty(spark, sf, table):
    """The same with nulls and ghost keys; copies are hit each for itself."""
    _, _, nulls, ghosts = FAULTY[table]
    df = copied(spark, sf, table).transform(faults.set_nulls, KEY, nulls.split(), FAULT_SHARES["null"])
    for column in ghosts.split():
        df = faults.ghost_numbers(df, KEY, column, FAULT_SHARES["ghost"])
    return df


def faulty_sql(table):
    """Common table expressions that end in <table>_c with copies and <table>_x with all faults."""
    key, columns, nulls, ghosts = FAULTY[table]
    changes = q.nulled(nulls.split(), *AT)
    changes |= {c: f"CASE WHEN {q.chosen(FAULT_SHARES['ghost'], f'ghost-{c}', *AT)} THEN -abs({c}) ELSE {c} END" for c in ghosts.split()}
    return ", ".join([
        f"{table}_k AS (SELECT {', '.join(columns.split())}, CAST({key} AS BIGINT) AS row_key FROM {table})",
        q.copies(f"{table}_c", f"{table}_k", KEY, salt=f"copy-{table}"), q.replaced(f"{table}_x", f"{table}_c", **changes),
    ])


# ----- reports --------------------------------------------------------------------------


_NULLS = [(t, c) for t, (_, _, nulls, _) in FAULTY.items() for c in nulls.split()]


@query("dq_nulls", f"WITH {', '.join(map(faulty_sql, FAULTY))} " + " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", COUNT(*) - COUNT({c}) AS nulls, COUNT(*) AS rows,
    CAST((20000 * (COUNT(*) - COUNT({c})) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS null_pct FROM {t}_x""" for t, c in _NULLS))
def _dq_nulls(spark, sf):
    """Null counts of five tables, each read once."""
    return quality.null_report({t: (faulty(spark, sf, t), nulls.split()) for t, (_, _, nulls, _) in FAULTY.items()})


def _without_id(table):
    return [c for c in FAULTY[table][1].split() if c not in IDS[table]]


@query("dq_duplicates", f"WITH {', '.join(map(faulty_sql, FAULTY))} " + " UNION ALL ".join(
    f"""SELECT '{t} {how}' AS "check", COUNT(*) AS rows, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {t}_c)) AS duplicates FROM {t}_c"""
    for t in FAULTY for how, columns in (("by id", IDS[t]), ("without id", _without_id(t)))))
def _dq_duplicates(spark, sf):
    """Ten checks on five tables: five scans and one exchange of rows."""
    checks = {}
    for t in FAULTY:
        df = copied(spark, sf, t)
        checks |= {f"{t} by id": (df, IDS[t]), f"{t} without id": (df, _without_id(t))}
    return quality.duplicate_report(checks)


#: (child, column, parent, key)
LINKS = (
    ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)


@query("dq_referential", f"WITH {faulty_sql('orders')}, {faulty_sql('lineitem')} " + " UNION ALL ".join(
    f"""SELECT '{child}' AS child, '{column}' AS "column", '{parent}' AS parent, COUNT(*) AS rows,
    COUNT(*) FILTER ({column} NOT IN (SELECT {key} FROM {parent})) AS orphans FROM {child}_x""" for child, column, parent, key in LINKS))
def _dq_referential(spark, sf):
    """Four foreign keys of two tables: every table is read once."""
    frames = {t: faulty(spark, sf, t) if t in ("orders", "lineitem") else read_table(spark, sf, t) for t in ("orders", "lineitem", "customer", "part", "supplier")}
    return quality.reference_report([(c, frames[c], column, p, frames[p], key) for c, column, p, key in LINKS])


@query("orphan_rows", f"WITH {faulty_sql('orders')} SELECT row_key, copy_no, o_custkey FROM orders_x WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def _orphan_rows(spark, sf):
    """Orders whose customer does not exist."""
    return unmatched(faulty(spark, sf, "orders").select(KEY, "copy_no", "o_custkey"), read_table(spark, sf, "customer"), "o_custkey", "c_custkey")


# ----- quarantine ---------------------------------------------------------------------------


_SPOILED = q.spoiled([
    ("o_totalprice", "-abs(o_totalprice)"), ("o_orderdate", f"{NOW} + to_days(CAST({q.between(1, 60, 'invalid-days', *AT)} AS INTEGER))"), ("o_orderstatus", "'?'"),
], *AT, share=FAULT_SHARES["invalid"], salt="invalid")
_JUDGED = f"""WITH {faulty_sql('orders')}, {q.replaced('spoiled', 'orders_x', **_SPOILED)}, judged AS (SELECT *, concat_ws(',',
  CASE WHEN o_totalprice < 0 THEN 'price_negative' END, CASE WHEN o_orderdate > {NOW} THEN 'date_in_future' END,
  CASE WHEN o_orderstatus NOT IN ('F', 'O', 'P') THEN 'status_unknown' END, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 'o_custkey_orphan' END
  ) AS reasons FROM spoiled)"""
_SHOWN = "row_key, copy_no, o_custkey, o_orderstatus, o_totalprice, o_orderdate"


def spoiled_orders(spark, sf):
    """Orders with every fault: also negative prices, dates to come and unknown status."""
    at = [F.col(c) for c in AT]
    to_come = F.lit(q.TODAY).cast("timestamp_ntz") + F.make_dt_interval(days=faults.draw_between(1, 60, "invalid-days", *at).cast("int"))
    return faults.spoil(faulty(spark, sf, "orders"), KEY, FAULT_SHARES["invalid"], "invalid", [
        ("o_totalprice", -F.abs("o_totalprice")), ("o_orderdate", to_come), ("o_orderstatus", F.lit("?"))])


def quarantined(spark, sf):
    rules = {
        "price_negative": F.col("o_totalprice") < 0, "date_in_future": F.col("o_orderdate") > F.lit(q.TODAY).cast("timestamp_ntz"),
        "status_unknown": ~F.col("o_orderstatus").isin("F", "O", "P"),
    }
    references = [("o_custkey", read_table(spark, sf, "customer"), "c_custkey")]
    return cleaning.route(spoiled_orders(spark, sf), rules, references, Lake(spark, root=new_folder(spark, "quarantine")), "orders")


@query("quarantine_accepted", f"{_JUDGED} SELECT {_SHOWN} FROM judged WHERE reasons = ''")
def _quarantine_accepted(spark, sf):
    return quarantined(spark, sf).accepted.select(*_SHOWN.split(", "))


@query("quarantine_rejected", f"{_JUDGED} SELECT {_SHOWN}, reasons FROM judged WHERE reasons <> ''")
def _quarantine_rejected(spark, sf):
    """Rejected orders with all their reasons, a missing customer among them."""
    return quarantined(spark, sf).rejected.select(*_SHOWN.split(", "), F.concat_ws(",", "reasons").alias("reasons"))


@query("quarantine_split", f"{_JUDGED} SELECT reasons, COUNT(*) AS rows, CAST(SUM(row_key) AS BIGINT) AS key_sum FROM judged GROUP BY 1")
def _quarantine_split(spark, sf):
    """Rows per set of reasons; the empty set is what passes."""
    table = quarantined(spark, sf).table
    return table.groupBy(F.concat_ws(",", "reasons").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"), F.sum(KEY).alias("key_sum"))
