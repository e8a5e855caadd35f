"""Scalar building blocks. Every function returns a JVM-side Column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.contracts import NULL_TEXTS

# ----- text and dates -------------------------------------------------------


def real_null(text: Column) -> Column:
    """Texts that stand for a missing value become SQL NULL."""
    return F.when(~text.isin(*NULL_TEXTS), text)


def to_event_date(df: DataFrame, name: str = "event_time") -> Column:
    """Event date of a text, timestamp or date column; unreadable text is null."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(real_null(column))
    return column.cast("date")


def to_event_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(real_null(text))


def month_start(day: Column) -> Column:
    return F.date_trunc("month", day)


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_number(day: Column) -> Column:
    """1 is Sunday."""
    return F.dayofweek(day)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def number_or_null(column: Column, kind: str = "double") -> Column:
    return column.try_cast(kind)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` followed by at least ``width`` digits."""
    return F.when(number.isNotNull(), F.format_string(f"{prefix}%0{width}d", number.cast("bigint")))


# ----- money ----------------------------------------------------------------
# Sums run on decimals: exact and independent of the row order. Nothing is rounded
# before the result; of a DOUBLE six decimals are taken, which is noise beyond.

EXACT = "decimal(18,6)"


def exact(number: Column) -> Column:
    """A number as a decimal whose sums are exact."""
    return number.cast(EXACT)


def discounted(price: Column, share: Column) -> Column:
    """``price`` less a share of it (0.075 is 7.5 %), unrounded; returns and credits may be negative."""
    return exact(price) * (F.lit(1) - share.cast("decimal(8,6)"))


def money(total: Column) -> Column:
    """A sum as shown: two decimals, half away from zero."""
    return F.round(total, 2).cast("double")


def whole_cents(total: Column) -> Column:
    """A sum as shown, as a number of cents."""
    return (F.round(total, 2) * 100).cast("bigint")


def rounded_ratio(top: Column, bottom: Column, places: int) -> Column:
    """``round(top / bottom, places)`` half up, exact for whole numbers."""
    quotient = top.cast("decimal(20,0)") / F.when(bottom != 0, bottom).cast("decimal(18,0)")
    return F.round(quotient, places).cast("double")


def mean_money(total: Column, rows: Column, places: int = 2) -> Column:
    """Mean of an exact sum, rounded to ``places`` decimals."""
    return F.round(total / F.when(rows != 0, rows).cast("decimal(18,0)"), places).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """Share in percent, null when there is nothing to divide by."""
    return rounded_ratio(part * 100, whole, places)


def row_digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of some columns, nulls told apart from values; equal for equal rows."""
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in columns])
    values = [F.col(c) for c in columns]
    return [F.xxhash64(nulls, *values).alias("h1"), F.xxhash64(F.lit("second"), *values, nulls).alias("h2")]


# ----- deterministic draws ----------------------------------------------------
# Draws depend on a salt and the row's own key only, so a lost task that runs
# again makes the same choice and any SQL engine can repeat it.

DRAW_STEPS = 1 << 28


def draw(salt: str, *key: Column) -> Column:
    """Whole number in [0, 2**28) from the md5 of ``salt:key:key...``."""
    text = F.concat_ws(":", F.lit(salt), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def steps(share: float) -> int:
    """Number of draw values that make up ``share`` of all of them."""
    return round(share * DRAW_STEPS)


def chosen(share: float, salt: str, *key: Column) -> Column:
    return draw(salt, *key) < F.lit(steps(share))


def draw_below(count: int, salt: str, *key: Column) -> Column:
    """Even draw from 0 .. count-1."""
    return F.shiftright(draw(salt, *key) * F.lit(count), 28)


def draw_between(low: int, high: int, salt: str, *key: Column) -> Column:
    """Even draw from the closed range low .. high."""
    return draw_below(high - low + 1, salt, *key) + F.lit(low)


def id_text(salt: str, *key: Column) -> Column:
    """Id in the 8-4-4-4-12 form, the same for the same key."""
    digest = F.md5(F.concat_ws(":", F.lit(salt), *[k.cast("string") for k in key]))
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in spans])


def pick(options: Iterable, salt: str, *key: Column) -> Column:
    """One of ``options``, each equally likely."""
    options = list(options)
    table = F.array(*[F.lit(o) for o in options])
    return F.element_at(table, (draw_below(len(options), salt, *key) + 1).cast("int"))


def weighted(weights: Mapping, drawn: Column) -> Column:
    """Option whose cumulative weight band holds ``drawn``; weights are normalised."""
    total = sum(weights.values())
    options = list(weights)
    reached, chain = 0.0, None
    for option in options[:-1]:
        reached += weights[option] / total
        below = drawn < F.lit(steps(reached))
        chain = F.when(below, F.lit(option)) if chain is None else chain.when(below, F.lit(option))
    last = F.lit(options[-1])
    return last if chain is None else chain.otherwise(last)
