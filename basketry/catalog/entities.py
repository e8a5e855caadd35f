"""Every metric end to end from messages: JSON with re-deliveries, cleaned, decoded, keyed, measured.

The SQL computes the same figures from the star tables, of which the messages are made.
"""

from __future__ import annotations

from basketry.catalog import metrics, sqlkit as q
from basketry.catalog.metrics import OTHER_SQL, SALES_SQL, SNAPSHOT, rfm_sql
from basketry.catalog.registry import REGISTRY, query, register
from basketry.catalog.retail import decoded_entities
from basketry.plans.metrics import avg_delivery_time, metric
from basketry.plans.rfm import rfm_segments

_EXACT = "CAST(amount AS DECIMAL(18,6)) AS amount, CAST(CAST(amount AS DECIMAL(18,6)) * 1000000 AS HUGEINT) * 1000000 AS units"
SALES = f"""WITH {q.SHOP}, sales AS (SELECT retail.* EXCLUDE (amount), CAST(event_time AS DATE) AS event_date, CAST(retail.amount AS DECIMAL(18,6)) AS amount,
  CAST(CAST(retail.amount AS DECIMAL(18,6)) * 1000000 AS HUGEINT) * 1000000 AS units, name, CAST(age AS DOUBLE) AS age, gender, people.city AS customer_city,
  product_name, category, brand FROM retail LEFT JOIN people ON people.customer_id = retail.customer_id LEFT JOIN items ON items.product_id = retail.product_id)"""
PAYMENTS = f"WITH {q.SHOP}, {q.SHOP_PAID}, payments AS (SELECT * EXCLUDE (amount), {_EXACT} FROM paid)"
SHIPPING = f"WITH {q.SHOP}, {q.SHOP_SHIPPED}, shipping AS (SELECT *, DATE '{q.TODAY}' AS message_date FROM shipped)"


def _sql(name: str) -> str:
    if name in SALES_SQL:
        text = SALES_SQL[name]
        return f"{SALES} " + (text.replace("gender,", "gender, age,") if name == "top_customers" else text)
    given = OTHER_SQL[name]
    return given.replace(metrics.PAYMENTS, PAYMENTS).replace(metrics.SHIPPING, SHIPPING)


#: Entities whose rows a metric counts; the others are only looked up.
_COUNTED = {name: "payments" if sql.startswith(metrics.PAYMENTS) else "shipping" for name, sql in OTHER_SQL.items()}


for _name in (*SALES_SQL, *OTHER_SQL):
    _key = f"entity_{_name}" if f"entity_{_name}" not in REGISTRY else f"entity_{_name}_keyed"
    if _name != "daily_revenue":
        register(
            _key, lambda spark, sf, n=_name: metric(n, decoded_entities(spark, sf, True, (_COUNTED.get(n, "orders"),)), ordered=True), _sql(_name))


@query("entity_rfm_scores", rfm_sql(SALES) + " SELECT * FROM segments")
def _entity_rfm_scores(spark, sf):
    return rfm_segments(decoded_entities(spark, sf, True, ("orders",)), SNAPSHOT)


@query("entity_avg_delivery_time", f"""{SHIPPING}, timed AS (SELECT courier, date_diff('day', CAST(event_time AS DATE), message_date) AS days
  FROM shipping LEFT JOIN retail ON retail.order_id = shipping.order_id)
SELECT courier, CAST((20 * CAST(SUM(days) AS HUGEINT) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10 AS avg_days_to_process, COUNT(*) AS shipments
FROM timed WHERE days >= 0 GROUP BY 1""")
def _entity_avg_delivery_time(spark, sf):
    return avg_delivery_time(decoded_entities(spark, sf, True, ("orders", "shipping")))
