"""Retail roles over concrete tables.

A ``Fact`` is a table of measurable rows with the lookups that can widen it.
Lookups are joined only for columns a metric asks for, so the narrowest plan
is the default. ``Retail`` bundles the facts every metric is written against:

lines     one row per order line (or order event)
totals    lines added up per order, where that grain exists
payments  one row per payment
shipping  one row per shipment

Measure columns of sales facts: ``exact_amount`` and ``quantity`` (decimals), ``line_count``
(rows stood for) and ``priced`` (rows stood for that carry an amount).
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from basketry.contracts import PRIMARY_KEY
from basketry.functions.columns import discounted, exact, to_event_date
from basketry.operators.cleaning import dedupe_by_key
from basketry.operators.joins import Owner, left_lookup
from basketry.session import stage

EXACT_MEASURES = ("exact_amount", "quantity")
SALES_MEASURES = (*EXACT_MEASURES, "line_count", "priced")


@dataclass(frozen=True)
class Lookup:
    """Attributes of a key; the table is built when one is asked for.

    ``unique``: one row per key.
    """

    key: str
    columns: tuple[str, ...]
    load: Callable[[], DataFrame]
    unique: bool = True

    @property
    def table(self) -> DataFrame:
        return self.load()


@dataclass(frozen=True)
class Fact:
    df: DataFrame
    lookups: tuple[Lookup, ...] = ()
    order_unique: bool = False  # at most one row per order_id
    counted: tuple[str, ...] = ()  # distinct counts the rows carry, as ``<name>_count``: "orders", "products"
    owners: tuple[Owner, ...] = ()  # stored tables of the row-level keys, to look for hot ones in

    def has(self, column: str) -> bool:
        return column in self.df.columns or any(column in l.columns for l in self.lookups)

    def source_of(self, column: str) -> Lookup | None:
        """Lookup that supplies ``column``; None when the fact itself does."""
        if column in self.df.columns:
            return None
        for lookup in self.lookups:
            if column in lookup.columns:
                return lookup
        raise KeyError(column)

    def via(self, column: str) -> str | None:
        """Fact column through which ``column`` is reached."""
        lookup = self.source_of(column)
        if lookup is None:
            return None
        return self.via(lookup.key) or lookup.key

    def attach(self, needed: Iterable[str], unique_on: str | None = None) -> "Fact":
        """Join the lookups that supply ``needed`` columns, nothing else.

        Hot keys are looked for only in ``owners``, never in a plan. ``unique_on`` names a key the fact holds one row
        of, which cannot be hot.
        """
        needed = list(needed)
        wanted, missing = set(), {c for c in needed if c not in self.df.columns}
        while missing:
            wanted |= missing
            missing = {self.source_of(c).key for c in missing} - wanted - set(self.df.columns)
        df, rows = self.df, self.df.columns
        for lookup in self.lookups:
            columns = [c for c in lookup.columns if c in wanted and c not in df.columns]
            if columns:
                table = lookup.table.select(lookup.key, *columns)
                owner = next((o for o in self.owners if lookup.key in o), None)
                spot = [c for c in (lookup.key, "order_id", *needed) if c in rows]
                df = left_lookup(df, table, lookup.key, keys_from=owner, spread=owner is not None and lookup.key != unique_on, spot=sorted(set(spot)))
        return replace(self, df=df)


class Retail:
    """The roles; each is built when first asked for."""

    lines: Fact
    totals: Fact | None = None
    payments: Fact
    shipping: Fact
    customers: DataFrame
    products: DataFrame
    order_dates: DataFrame  # order_id, order_date: one row per order
    roll_ups: tuple[Callable[[list[str]], Fact | None], ...] = ()  # stored sales facts above orders; each names the keys it serves

    def rolled(self, keys: list[str], parts: Iterable[str]) -> Fact | None:
        """A stored roll-up that gives these parts of measures per ``keys``."""
        distinct = {"orders", "products"} & set(parts)
        found = (serve(keys) for serve in self.roll_ups)
        return next((fact for fact in found if fact is not None and distinct <= set(fact.counted)), None)

    def sales(self, keys: Iterable[str]) -> Fact:
        """Coarsest fact of orders or lines that can be grouped by ``keys``."""
        if self.totals is not None and all(self.totals.has(k) for k in keys):
            return self.totals
        return self.lines


def stored(retail: Retail) -> Retail:
    """The same roles with what many metrics read written once: the attributes, and the totals per order or else the lines.

    Where totals exist, sales are also stored per day, customer, product and category, each with its distinct orders.
    """
    kept = copy.copy(retail)
    kept.customers = stage(retail.customers, "customers")
    if retail.totals is None:
        kept.lines = replace(retail.lines, df=stage(retail.lines.df, "lines"))
        return kept
    kept.rebuilt()
    kept.roll_ups = _roll_ups(kept)
    return kept


def _roll_ups(kept: Retail) -> tuple[Callable[[list[str]], Fact | None], ...]:
    """Sales per day, customer, product and category; stores the totals per order on the way.

    An order has one day and one customer, so orders of these add up; a product's and a category's do not, so
    those are counted from the lines' keys, apart from the measures, and serve only keys that tell them apart. Lines are not
    stored: adding them up per order and product leaves nearly as many, at the price of a shuffle of all their measures.
    """
    sums = [F.sum(m).alias(m) for m in SALES_MEASURES]
    orders, distinct = F.count("order_id").alias("orders_count"), F.count_distinct("order_id").alias("orders_count")
    lines = kept.lines
    pairs = replace(lines, df=lines.df.select("order_id", "product_id"))
    sold, met = lines.df.groupBy("product_id").agg(*sums), pairs.df.groupBy("product_id").agg(distinct)
    with ThreadPoolExecutor() as pool:
        goods = pool.submit(stage, _side_by_side(sold, met, "product_id"), "goods")
        baskets = pool.submit(stage, pairs.attach(["category"]).df.groupBy("category").agg(distinct), "baskets")
        kept.totals = replace(kept.totals, df=stage(kept.totals.df, "totals"))
        totals = kept.totals
        days = pool.submit(stage, totals.df.groupBy("event_date").agg(*sums, orders), "days")
        buyers = pool.submit(stage, totals.df.groupBy("customer_id").agg(*sums, orders), "buyers")
    days, buyers = Fact(days.result(), counted=("orders",)), replace(totals, df=buyers.result(), counted=("orders",))
    goods = replace(lines, df=goods.result(), lookups=tuple(l for l in lines.lookups if l.key == "product_id"), counted=("orders",))
    early = goods.attach(["category"], "product_id").df.groupBy("category").agg(*sums, F.count("product_id").alias("products_count"))
    kinds = Fact(stage(_side_by_side(early, baskets.result(), "category"), "categories"), counted=("orders", "products"))
    return (
        lambda keys: days if all(k == "event_date" for k in keys) else None,
        lambda keys: buyers if all(buyers.has(k) for k in keys) else None,
        lambda keys: goods if "product_id" in keys and all(goods.has(k) for k in keys) else None,
        lambda keys: kinds if keys == ["category"] else None,
    )


def _side_by_side(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """Two tables of one row a key, the null key too, with the same keys: the columns of both."""
    rest = [two[c] for c in two.columns if c != key]
    return one.join(two, one[key].eqNullSafe(two[key])).select(*[one[c] for c in one.columns], *rest)


def _per_order(lines: DataFrame) -> DataFrame:
    """Lines added up per order; copies of a hot order combine before the shuffle."""
    return lines.groupBy("order_id").agg(*[F.sum(m).alias(m) for m in SALES_MEASURES])


# ----- star schema tables ------------------------------------------------------


STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A star table by its known schema, which spares a job that reads footers."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _one() -> Column:
    return F.lit(1).cast("bigint")


class StarRetail(Retail):
    """Roles on the star tables; their primary keys are unique by definition."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def _read(self, name: str, *columns: Column) -> DataFrame:
        return read_table(self._spark, self._folder, name).select(*columns)

    @cached_property
    def customers(self) -> DataFrame:
        nations = self._read("nation", col("n_nationkey").alias("nation_id"), col("n_name").alias("city"), col("n_regionkey"))
        regions = self._read("region", col("r_regionkey").alias("n_regionkey"), col("r_name").alias("state"))
        people = self._read(
            "customer", col("c_custkey").alias("customer_id"), col("c_name").alias("name"),
            col("c_mktsegment").alias("gender"), col("c_nationkey").alias("nation_id"),
        )
        return (
            people.join(nations.join(regions, "n_regionkey", "left"), "nation_id", "left")
            .select("customer_id", "name", "gender", col("city").alias("customer_city"), "city", "state")
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._read(
            "part", col("p_partkey").alias("product_id"), col("p_name").alias("product_name"),
            col("p_type").alias("category"), col("p_brand").alias("brand"), col("p_retailprice").alias("price"),
        )

    @cached_property
    def headers(self) -> DataFrame:
        return self._read(
            "orders", col("o_orderkey").alias("order_id"), col("o_custkey").alias("customer_id"),
            col("o_orderdate").cast("timestamp").alias("event_time"), col("o_orderdate").cast("date").alias("event_date"),
            col("o_orderstatus").alias("order_status"),
        )

    @cached_property
    def order_dates(self) -> DataFrame:
        return self._read("orders", col("o_orderkey").alias("order_id"), col("o_orderdate").cast("date").alias("order_date"))

    @cached_property
    def _lines(self) -> DataFrame:
        return self._read(
            "lineitem", col("l_orderkey").alias("order_id"), col("l_partkey").alias("product_id"),
            exact(col("l_quantity")).alias("quantity"), col("l_discount").alias("discount"),
            discounted(col("l_extendedprice"), col("l_discount")).alias("exact_amount"),
            _one().alias("line_count"), _one().alias("priced"),
        )

    def rebuilt(self) -> None:
        """Build the sales facts anew when they are next asked for, with the attributes as they are now."""
        for name in ("lines", "totals", "_to_customers"):
            self.__dict__.pop(name, None)

    @cached_property
    def _to_customers(self) -> Lookup:
        columns = ("name", "gender", "customer_city", "city", "state")
        return Lookup("customer_id", columns, lambda: self.customers)

    @cached_property
    def lines(self) -> Fact:
        to_headers = Lookup("order_id", ("customer_id", "event_time", "event_date", "order_status"), lambda: self.headers)
        to_products = Lookup("product_id", ("product_name", "category", "brand", "price"), lambda: self.products)
        return Fact(self._lines, (to_headers, self._to_customers, to_products), owners=self.owners)

    @cached_property
    def owners(self) -> tuple[Owner, ...]:
        """The tables that own the keys of rows."""
        lines = self._read("lineitem", col("l_orderkey").alias("order_id"), col("l_partkey").alias("product_id"), col("l_suppkey").alias("courier_id"))
        return Owner(lines), Owner(self._read("orders", col("o_custkey").alias("customer_id")))

    @cached_property
    def totals(self) -> Fact:
        # one row per order on both sides, so no key of this join is hot
        df = _per_order(self._lines).join(self.headers, "order_id", "left")
        return Fact(df, (self._to_customers,), order_unique=True, owners=self.owners[1:])

    @cached_property
    def payments(self) -> Fact:
        status = F.when(col("o_orderstatus") == "F", "Failed").when(col("o_orderstatus") == "O", "Success").otherwise("Pending")
        return Fact(self._read(
            "orders", col("o_orderkey").alias("payment_id"), col("o_orderkey").alias("order_id"),
            col("o_orderpriority").alias("payment_method"), status.alias("payment_status"),
            exact(col("o_totalprice")).alias("exact_amount"), _one().alias("line_count"), _one().alias("priced"),
        ))

    @cached_property
    def shipping(self) -> Fact:
        flag = col("l_returnflag")
        status = F.when(flag == "A", "Delivered").when(flag == "N", "Pending").when(flag == "R", "Failed")
        couriers = lambda: self._read("supplier", col("s_suppkey").alias("courier_id"), col("s_name").alias("courier"))
        return Fact(self._read(
            "lineitem", col("l_orderkey").alias("order_id"), col("l_suppkey").alias("courier_id"),
            status.alias("delivery_status"), col("l_shipdate").cast("date").alias("message_date"),
        ), (Lookup("courier_id", ("courier",), couriers),), owners=self.owners)


# ----- decoded entity tables ---------------------------------------------------


class EntityRetail(Retail):
    """Roles on decoded entity tables (see ``contracts``).

    ``unique`` keeps the latest row per primary key of every table; different
    rows that lack the key all stay. Without it re-delivered rows count again,
    as plain joins over raw tables would.
    """

    def __init__(self, tables: dict[str, DataFrame], *, unique: bool = True) -> None:
        self._tables, self._unique = tables, unique

    def table(self, name: str) -> DataFrame:
        df, key = self._tables[name], PRIMARY_KEY[name]
        if not self._unique or key not in df.columns:
            return df
        counted = name in ("orders", "payments", "shipping")  # rows without a key count, lookups never match them
        return dedupe_by_key(df, [key], ["kafka_timestamp"], keep_unkeyed=counted)

    @staticmethod
    def _measured(df: DataFrame) -> DataFrame:
        amount = exact(col("amount").cast("double"))
        priced = F.when(col("amount").isNotNull(), 1).otherwise(0).cast("bigint")
        return df.withColumns({"exact_amount": amount, "line_count": _one(), "priced": priced})

    @cached_property
    def customers(self) -> DataFrame:
        df = self.table("customers").withColumnRenamed("city", "customer_city")
        wanted = ("customer_id", "name", "age", "gender", "customer_city")
        return df.select([c for c in wanted if c in df.columns])

    @cached_property
    def products(self) -> DataFrame:
        return self.table("products").select("product_id", "product_name", "category", "brand")

    @cached_property
    def lines(self) -> Fact:
        orders = self.table("orders")
        dated = col("event_date") if "event_date" in orders.columns else to_event_date(orders)
        df = self._measured(orders).withColumns({"event_date": dated, "quantity": exact(col("quantity").cast("double"))})
        about = tuple(c for c in ("name", "age", "gender", "city") if c in self._tables["customers"].columns)
        about = tuple("customer_city" if c == "city" else c for c in about)
        lookups = (
            Lookup("customer_id", about, lambda: self.customers, self._unique),
            Lookup("product_id", ("product_name", "category", "brand"), lambda: self.products, self._unique),
        )
        return Fact(df, lookups, order_unique=self._unique)

    @cached_property
    def order_dates(self) -> DataFrame:
        return self.lines.df.groupBy("order_id").agg(F.min("event_date").alias("order_date"))

    @cached_property
    def payments(self) -> Fact:
        return Fact(self._measured(self.table("payments")))

    @cached_property
    def shipping(self) -> Fact:
        return Fact(self.table("shipping").withColumn("message_date", col("kafka_timestamp").cast("date")))
