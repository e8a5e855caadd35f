"""Deterministic fault injection for test data.

Whether a row is hit depends on a salt and the row's key, so a run can be
repeated by any engine and a retried task makes the same choice. Copies made
by ``add_copies`` carry a copy number that is part of the key of later steps:
copies are hit independently, as separately delivered messages are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.contracts import (
    BAD_AGES, BAD_DELIVERY_STATUSES, BAD_EMAILS, BAD_ORDER_STATUSES, BAD_PAYMENT_STATUSES, BAD_PHONES,
    CITY_SPELLINGS, FAULT_SHARES, ORDER_STATUS_SPELLINGS, OUTLIER_DISCOUNTS, PAYMENT_METHOD_SPELLINGS,
)
from basketry.functions.columns import chosen, draw, draw_below, draw_between, pick
from basketry.operators.ntile import digest_at

COPY = "copy_no"


def _key(df: DataFrame, key: str) -> list[Column]:
    return [F.col(key), F.col(COPY)] if COPY in df.columns else [F.col(key)]


def sample_share(df: DataFrame, key: str, share: float, salt: str) -> DataFrame:
    """About ``share`` of the rows."""
    return df.where(chosen(share, salt, *_key(df, key)))


def sample_exact(df: DataFrame, key: str, share: float, salt: str) -> DataFrame:
    """max(1, round(rows * share)) rows without replacement; none for an empty table or share.

    Takes the rows with the smallest salted digest. The digest at that rank is
    found by narrowing, so neither a sort nor a single-task limit is needed.
    ``key`` must be unique.
    """
    rows = df.count()
    if rows == 0 or share <= 0:
        return df.limit(0)
    digest = F.md5(F.concat_ws(":", F.lit(salt), F.col(key).cast("string")))
    size = min(rows, max(1, round(rows * share)))
    return df.where(digest <= digest_at(df, digest, size))


def set_nulls(df: DataFrame, key: str, columns: Sequence[str], share: float, salt: str = "null") -> DataFrame:
    """Null a share of each column, independently; unknown columns are skipped."""
    hit = {
        c: F.when(~chosen(share, f"{salt}-{c}", *_key(df, key)), F.col(c)) for c in columns if c in df.columns
    }
    return df.withColumns(hit) if hit else df


def add_copies(df: DataFrame, key: str, share: float, salt: str = "copy", scatter: bool = False) -> DataFrame:
    """Append a second copy of a share of the rows, numbered in ``copy_no``.

    One pass: hit rows are emitted twice instead of reading the table again.
    ``scatter`` moves copies away from their originals.
    """
    copies = F.when(chosen(share, salt, F.col(key)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = df.withColumn(COPY, F.explode(copies))
    return out.repartition(F.xxhash64(key, COPY)) if scatter else out


def misspell(df: DataFrame, key: str, column: str, spellings: Mapping[str, Sequence[str]], share: float, salt: str = "spelling") -> DataFrame:
    """Replace canonical values by one of their variants in a share of the rows."""
    at = [f"{salt}-{column}", *_key(df, key)]
    entries = [x for canonical, variants in spellings.items() for x in (F.lit(canonical), F.array(*[F.lit(v) for v in variants]))]
    variants = F.try_element_at(F.create_map(*entries), F.col(column))
    which = F.shiftright(draw(f"{salt}-{column}-which", *at[1:]) * F.size(variants), 28).cast("int") + 1
    hit = chosen(share, *at) & variants.isNotNull()
    return df.withColumn(column, F.when(hit, F.element_at(variants, which)).otherwise(F.col(column)))


def ghost_keys(df: DataFrame, key: str, column: str, share: float, salt: str = "ghost") -> DataFrame:
    """Point a share of a foreign key at ids that do not exist."""
    at = _key(df, key)
    text = F.concat_ws(":", F.lit(f"{salt}-{column}-id"), *[k.cast("string") for k in at])
    ghost = F.concat(F.lit(f"{column.upper()}_GHOST_"), F.substring(F.md5(text), 1, 8))
    return df.withColumn(column, F.when(chosen(share, f"{salt}-{column}", *at), ghost).otherwise(F.col(column)))


def ghost_numbers(df: DataFrame, key: str, column: str, share: float, salt: str = "ghost") -> DataFrame:
    """Point a share of a positive numeric foreign key at numbers that do not exist: below zero."""
    at = _key(df, key)
    return df.withColumn(column, F.when(chosen(share, f"{salt}-{column}", *at), -F.abs(F.col(column))).otherwise(F.col(column)))


def spoil(df: DataFrame, key: str, share: float, salt: str, options: Sequence[tuple[str, Column]]) -> DataFrame:
    """In a share of the rows replace one column, each option equally likely."""
    at = _key(df, key)
    hit, which = chosen(share, salt, *at), draw_below(len(options), f"{salt}-kind", *at)
    changed: dict[str, Column] = {}
    for number, (column, value) in enumerate(options):
        before = changed.get(column, F.col(column))
        changed[column] = F.when(hit & (which == number), value).otherwise(before)
    return df.withColumns(changed)


def invalid_customers(df: DataFrame, key: str, share: float, salt: str = "invalid") -> DataFrame:
    at = _key(df, key)
    return spoil(df, key, share, salt, [
        ("age", pick(BAD_AGES, f"{salt}-age", *at).cast(df.schema["age"].dataType)),
        ("email", pick(BAD_EMAILS, f"{salt}-email", *at)),
        ("phone", pick(BAD_PHONES, f"{salt}-phone", *at)),
    ])


def invalid_orders(df: DataFrame, key: str, now: Column, share: float, salt: str = "invalid") -> DataFrame:
    """Negative quantity, negative price, future event time or unknown status."""
    at = _key(df, key)
    future = now + F.make_dt_interval(days=draw_between(1, 60, f"{salt}-days", *at).cast("int"))
    return spoil(df, key, share, salt, [
        ("quantity", (-draw_between(1, 10, f"{salt}-quantity", *at)).cast(df.schema["quantity"].dataType)),
        ("price", -F.abs(F.col("price"))),
        ("event_time", future),
        ("order_status", pick(BAD_ORDER_STATUSES, f"{salt}-status", *at)),
    ])


def invalid_payments(df: DataFrame, key: str, share: float, salt: str = "invalid") -> DataFrame:
    at = _key(df, key)
    return spoil(df, key, share, salt, [
        ("payment_status", pick(BAD_PAYMENT_STATUSES, f"{salt}-status", *at)),
        ("amount", -F.abs(F.col("amount"))),
    ])


def invalid_shipping(df: DataFrame, key: str, share: float, salt: str = "invalid") -> DataFrame:
    at = _key(df, key)
    return spoil(df, key, share, salt, [("delivery_status", pick(BAD_DELIVERY_STATUSES, f"{salt}-status", *at))])


def outliers(df: DataFrame, key: str, share: float, salt: str = "outlier") -> DataFrame:
    """Huge amount, quantity or discount."""
    at = _key(df, key)
    return spoil(df, key, share, salt, [
        ("amount", draw_between(200_000_000, 5_000_000_000, f"{salt}-amount", *at) / 100),
        ("quantity", draw_between(1000, 9999, f"{salt}-quantity", *at).cast(df.schema["quantity"].dataType)),
        ("discount", pick(OUTLIER_DISCOUNTS, f"{salt}-discount", *at).cast(df.schema["discount"].dataType)),
    ])


def add_ingestion_time(df: DataFrame, key: str, event: str, share: float, salt: str = "late") -> DataFrame:
    """``ingestion_time`` 1 to 299 seconds after the event, 1 to 10 days for late rows, and the flag."""
    at = _key(df, key)
    late = chosen(share, salt, *at)
    seconds = F.make_dt_interval(secs=draw_between(1, 299, f"{salt}-seconds", *at).cast("int"))
    days = F.make_dt_interval(days=draw_between(1, 10, f"{salt}-days", *at).cast("int"))
    return df.withColumns({
        "ingestion_time": F.col(event) + F.when(late, days).otherwise(seconds),
        "is_late_arrival": late,
    })


# ----- all faults of an entity, in order ----------------------------------------------


ORDER_SPELLINGS = {"payment_method": PAYMENT_METHOD_SPELLINGS, "city": CITY_SPELLINGS, "order_status": ORDER_STATUS_SPELLINGS}


def messy_orders(
    df: DataFrame, key: str, now: Column, shares: Mapping[str, float] = FAULT_SHARES, spellings: Mapping[str, Mapping[str, Sequence[str]]] = ORDER_SPELLINGS,
) -> DataFrame:
    """Copies, ingestion time, nulls, invalid values, spellings, outliers, ghosts.

    The order matters: ingestion time must see the clean event time, and copies
    must exist before anything that tells them apart.
    """
    spoilt = (
        df.transform(add_copies, key, shares["duplicate"])
        .transform(add_ingestion_time, key, "event_time", shares["late"])
        .transform(set_nulls, key, ["discount", "payment_method", "event_time", "coupon_code"], shares["null"])
        .transform(invalid_orders, key, now, shares["invalid"])
    )
    for column, known in spellings.items():
        spoilt = spoilt.transform(misspell, key, column, known, shares["spelling"])
    return (
        spoilt.transform(outliers, key, shares["outlier"])
        .transform(ghost_keys, key, "customer_id", shares["ghost"])
        .transform(ghost_keys, key, "product_id", shares["ghost"])
    )


def messy_customers(
    df: DataFrame, key: str, shares: Mapping[str, float] = FAULT_SHARES, spellings: Mapping[str, Sequence[str]] = CITY_SPELLINGS,
) -> DataFrame:
    return (
        df.transform(add_copies, key, shares["duplicate"])
        .transform(set_nulls, key, ["phone", "email"], shares["null"])
        .transform(invalid_customers, key, shares["invalid"])
        .transform(misspell, key, "city", spellings, shares["spelling"])
    )


def messy_products(df: DataFrame, key: str, spellings: Mapping[str, Sequence[str]], shares: Mapping[str, float] = FAULT_SHARES) -> DataFrame:
    return (
        df.transform(set_nulls, key, ["description"], shares["null"])
        .transform(misspell, key, "category", spellings, shares["spelling"])
    )


def messy_payments(
    df: DataFrame, key: str, shares: Mapping[str, float] = FAULT_SHARES, spellings: Mapping[str, Sequence[str]] = PAYMENT_METHOD_SPELLINGS,
) -> DataFrame:
    return (
        df.transform(add_copies, key, shares["duplicate"])
        .transform(set_nulls, key, ["payment_method"], shares["null"])
        .transform(invalid_payments, key, shares["invalid"])
        .transform(misspell, key, "payment_method", spellings, shares["spelling"])
        .transform(ghost_keys, key, "order_id", shares["ghost"])
    )


def messy_shipping(df: DataFrame, key: str, shares: Mapping[str, float] = FAULT_SHARES) -> DataFrame:
    return (
        df.transform(set_nulls, key, ["courier"], shares["null"])
        .transform(invalid_shipping, key, shares["invalid"])
        .transform(ghost_keys, key, "order_id", shares["ghost"])
    )
