"""SQL text for the deterministic draws and the synthetic orders.

Written independently of the DataFrame side; only salts, shares and the fixed
value lists are shared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from basketry.contracts import (
    AGES, CITY_STATE, COUPON_SHARE, COUPON_VERSION_START, COUPONS, COURIERS, DELIVERY_OUTCOMES, DISCOUNTS, FAULT_SHARES,
    GENDERS, HOURS, ORDER_STATUSES, ORDER_WINDOW_DAYS, PAYMENT_METHODS, PAYMENT_OUTCOMES, PRODUCT_CATALOG, QUANTITIES,
    SAME_CITY_SHARE, SIGNUP_WINDOW_DAYS,
)

from basketry.plans.shop import DELIVERED, NATION_REGION, PAID as PAID_NAMES

TODAY = "2024-06-01"


def lit(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def text_key(salt: str, *key: str) -> str:
    parts = ", ".join([lit(salt), *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"concat_ws(':', {parts})"


def draw(salt: str, *key: str) -> str:
    return f"CAST('0x' || substr(md5({text_key(salt, *key)}), 1, 7) AS BIGINT)"


def below(count: int | str, salt: str, *key: str) -> str:
    return f"(({draw(salt, *key)} * {count}) >> 28)"


def between(low: int, high: int, salt: str, *key: str) -> str:
    return f"({below(high - low + 1, salt, *key)} + {low})"


def chosen(share: float, salt: str, *key: str) -> str:
    return f"({draw(salt, *key)} < {round(share * 268435456)})"


def pick(options: Sequence, salt: str, *key: str) -> str:
    listed = ", ".join(lit(o) for o in options)
    return f"([{listed}])[CAST({below(len(options), salt, *key)} + 1 AS INTEGER)]"


def weighted(weights: Mapping, drawn: str) -> str:
    total, reached, arms = sum(weights.values()), 0.0, []
    options = list(weights)
    for option in options[:-1]:
        reached += weights[option] / total
        arms.append(f"WHEN {drawn} < {round(reached * 268435456)} THEN {lit(option)}")
    return f"CASE {' '.join(arms)} ELSE {lit(options[-1])} END" if arms else lit(options[-1])


def outcome(given: str, table: Mapping, drawn: str) -> str:
    arms = " ".join(f"WHEN {lit(v)} THEN {weighted(w, drawn)}" for v, w in table.items() if v != "*")
    return f"CASE {given} {arms} ELSE {weighted(table['*'], drawn)} END"


def id_text(salt: str, *key: str) -> str:
    h = f"md5({text_key(salt, *key)})"
    return (
        f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), substr({h}, 17, 4), substr({h}, 21, 12))"
    )


def dictionary(table: Mapping[str, str], column: str, default: str) -> str:
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {default} END"


# ----- synthetic retail over the star keys ---------------------------------------

_CATALOG_ROWS = ", ".join(
    f"({i}, {lit(n)}, {lit(c)}, {lit(b)}, {lo}, {hi})" for i, (n, c, b, lo, hi) in enumerate(PRODUCT_CATALOG, start=1)
)
ITEMS = (
    "items AS (SELECT printf('PROD%04d', seq) AS product_id, product_name, category, brand,"
    " CAST(low + high AS DOUBLE) / 2 AS price, brand || ' ' || product_name || ' - ' || category || ' category product.' AS description, low, high"
    f" FROM (VALUES {_CATALOG_ROWS}) AS v(seq, product_name, category, brand, low, high))"
)

PEOPLE = f"""people AS (SELECT c_custkey AS person, printf('CUST%06d', c_custkey) AS customer_id,
  printf('Customer %06d', c_custkey) AS name, {between(*AGES, 'age', 'c_custkey')} AS age,
  {weighted(GENDERS, draw('gender', 'c_custkey'))} AS gender, {pick(list(CITY_STATE), 'city', 'c_custkey')} AS city,
  CAST(DATE '{TODAY}' - CAST({between(0, SIGNUP_WINDOW_DAYS, 'signup', 'c_custkey')} AS INTEGER) AS DATE) AS signup_date,
  printf('+91%010d', {below(1 << 33, 'phone', 'c_custkey')}) AS phone,
  printf('customer%06d@example.org', c_custkey) AS email FROM customer)"""

_K = "o_orderkey"
ORDERS = f"""{ITEMS}, {PEOPLE}, drawn AS (
  SELECT o_orderkey AS order_seq, {id_text('order', _K)} AS order_id, people.customer_id, items.product_id,
    {weighted(QUANTITIES, draw('quantity', _K))} AS quantity,
    low * 100 + (({draw('price', _K)} * ((high - low) * 100)) >> 28) AS price_cents,
    {weighted(DISCOUNTS, draw('discount', _K))} AS discount,
    {weighted(PAYMENT_METHODS, draw('payment-method', _K))} AS payment_method,
    {weighted(ORDER_STATUSES, draw('order-status', _K))} AS order_status,
    CASE WHEN {chosen(SAME_CITY_SHARE, 'stays', _K)} THEN people.city ELSE {pick(list(CITY_STATE), 'order-city', _K)} END AS city,
    CAST(DATE '{TODAY}' - CAST({between(0, ORDER_WINDOW_DAYS, 'day', _K)} AS INTEGER) AS TIMESTAMP)
      + to_seconds({weighted(HOURS, draw('hour', _K))} * 3600 + {between(0, 3599, 'second', _K)}) AS event_time,
    CASE WHEN o_orderkey >= {COUPON_VERSION_START} AND {chosen(COUPON_SHARE, 'coupon', _K)}
      THEN {pick(COUPONS, 'coupon-code', _K)} END AS coupon_code
  FROM orders
  JOIN items ON product_id = printf('PROD%04d', {below(len(PRODUCT_CATALOG), 'product', _K)} + 1)
  JOIN people ON person = o_custkey),
retail AS (
  SELECT order_seq, order_id, customer_id, product_id, quantity, CAST(price_cents AS DOUBLE) / 100 AS price, discount,
    payment_method, order_status, city, {dictionary(CITY_STATE, 'city', "'Delhi'")} AS state, 'India' AS country, event_time,
    CAST(ROUND(CAST(price_cents * quantity * (100 - discount) AS DECIMAL(14,0)) * 0.0001, 2) AS DOUBLE) AS amount_decimal,
    CAST((price_cents * quantity * (100 - discount) + 50) // 100 AS DOUBLE) / 100 AS amount, coupon_code
  FROM drawn)"""

PAID = f"""paid AS (SELECT order_seq, {id_text('payment', 'order_seq')} AS payment_id, order_id, payment_method,
  {outcome('order_status', PAYMENT_OUTCOMES, draw('payment-status', 'order_seq'))} AS payment_status, amount FROM retail)"""
SHIPPED = f"""shipped AS (SELECT order_seq, {id_text('shipment', 'order_seq')} AS shipment_id, order_id,
  {pick(COURIERS, 'courier', 'order_seq')} AS courier,
  {outcome('order_status', DELIVERY_OUTCOMES, draw('delivery-status', 'order_seq'))} AS delivery_status FROM retail)"""


# ----- the entities from columns of the star tables ------------------------------


def _named_sql(code: str, names: Mapping[str, str]) -> str:
    return f"CASE {code} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in names.items()) + " END"


SHOP = f"""items AS (SELECT printf('PROD%04d', p_partkey) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand, p_retailprice AS price,
  concat_ws(' ', p_brand, p_name, p_type) AS description FROM part),
people AS (SELECT printf('CUST%06d', c_custkey) AS customer_id, c_name AS name, c_nationkey + 18 AS age, c_mktsegment AS gender, n_name AS city,
  substr(c_name, 10) AS phone, lower(c_mktsegment) || substr(c_name, 10) || '@example.org' AS email FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey),
line_sums AS (SELECT l_orderkey, MIN(l_partkey) AS part, MIN(l_suppkey) AS supplier, CAST(SUM(CAST(l_quantity AS BIGINT)) AS INTEGER) AS quantity,
  MAX(l_extendedprice) AS price, MAX(CAST(round(l_discount * 100) AS INTEGER)) AS discount, MIN(l_linestatus) AS line_status, MIN(l_returnflag) AS flag
  FROM lineitem GROUP BY 1),
retail AS (SELECT o_orderkey AS order_seq, CAST(o_orderkey AS VARCHAR) AS order_id, printf('CUST%06d', o_custkey) AS customer_id,
  CASE WHEN part IS NOT NULL THEN printf('PROD%04d', part) END AS product_id, quantity, price, discount, o_orderpriority AS payment_method,
  o_orderstatus AS order_status, city, {_named_sql('city', NATION_REGION)} AS state, CAST(o_orderdate AS TIMESTAMP) AS event_time, o_totalprice AS amount,
  CASE WHEN o_orderkey >= {COUPON_VERSION_START} THEN line_status END AS coupon_code
  FROM orders LEFT JOIN line_sums ON l_orderkey = o_orderkey LEFT JOIN people ON people.customer_id = printf('CUST%06d', o_custkey))"""
SHOP_PAID = f"""paid AS (SELECT o_orderkey AS order_seq, 'PAY' || o_orderkey AS payment_id, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS payment_method,
  {_named_sql('o_orderstatus', PAID_NAMES)} AS payment_status, o_totalprice AS amount FROM orders)"""
SHOP_SHIPPED = f"""shipped AS (SELECT o_orderkey AS order_seq, 'SHIP' || o_orderkey AS shipment_id, CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN supplier IS NOT NULL THEN printf('SUPP%04d', supplier) END AS courier, {_named_sql('flag', DELIVERED)} AS delivery_status
  FROM orders LEFT JOIN line_sums ON l_orderkey = o_orderkey)"""


# ----- faults ------------------------------------------------------------------------


def copies(name: str, source: str, key: str, share: float = FAULT_SHARES["duplicate"], salt: str = "copy") -> str:
    return (
        f"{name} AS (SELECT *, 0 AS copy_no FROM {source} UNION ALL SELECT *, 1 FROM {source} WHERE {chosen(share, salt, key)})"
    )


def replaced(name: str, source: str, **columns: str) -> str:
    listed = ", ".join(f"{expr} AS {column}" for column, expr in columns.items())
    return f"{name} AS (SELECT * REPLACE ({listed}) FROM {source})"


def nulled(columns: Sequence[str], *key: str, share: float = FAULT_SHARES["null"]) -> dict[str, str]:
    return {c: f"CASE WHEN NOT {chosen(share, f'null-{c}', *key)} THEN {c} END" for c in columns}


def misspelt(column: str, spellings: Mapping[str, Sequence[str]], *key: str, share: float = FAULT_SHARES["spelling"]) -> str:
    arms = " ".join(
        f"WHEN {lit(canonical)} THEN {pick(variants, f'spelling-{column}-which', *key)}" for canonical, variants in spellings.items()
    )
    return f"CASE WHEN {chosen(share, f'spelling-{column}', *key)} THEN CASE {column} {arms} ELSE {column} END ELSE {column} END"


def ghosted(column: str, *key: str, share: float = FAULT_SHARES["ghost"]) -> str:
    ghost = f"'{column.upper()}_GHOST_' || substr(md5({text_key(f'ghost-{column}-id', *key)}), 1, 8)"
    return f"CASE WHEN {chosen(share, f'ghost-{column}', *key)} THEN {ghost} ELSE {column} END"


def spoiled(options: Sequence[tuple[str, str]], *key: str, share: float, salt: str) -> dict[str, str]:
    hit, kind = chosen(share, salt, *key), below(len(options), f"{salt}-kind", *key)
    return {
        column: f"CASE WHEN {hit} AND {kind} = {number} THEN {value} ELSE {column} END"
        for number, (column, value) in enumerate(options)
    }
