"""Purchase predicate and product-list revenue as column expressions.

``event_list`` is a comma-separated list of event codes; code ``1`` is a
purchase. ``product_list`` is ``category;name;qty;revenue;events`` per
product, products separated by ``,`` (no escaping: a comma inside a name
splits the product).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refyield.functions._memo import memo_columns

# Fixed value: the event code of a purchase.
PURCHASE_EVENT = "1"
# Blanks that may stand around a code.
_BLANKS = " \t\n\x0b\f\r"

# A plain decimal number (strict revenue mode); rejects NaN, Infinity, 290d.
_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@memo_columns
def is_purchase(event_list: Column | str = "event_list") -> Column:
    """True when event code 1 appears on its own (10, 11, ... do not count).

    Byte searches instead of a regexp: most lists hold no ``1`` at all, and in
    the others, without their blanks, the code stands between commas.
    """
    events = _col(event_list)
    codes = F.concat(F.lit(","), F.translate(events, _BLANKS, ""), F.lit(","))
    return events.contains(PURCHASE_EVENT) & codes.contains(f",{PURCHASE_EVENT},")


@memo_columns
def has_products(product_list: Column | str = "product_list") -> Column:
    """Product list present and not empty.

    Written as ``IS NOT NULL AND <> ''`` so both parts reach a Parquet scan
    as pushed filters.
    """
    pl = _col(product_list)
    return pl.isNotNull() & (pl != F.lit(""))


@memo_columns
def product_entries(product_list: Column | str = "product_list") -> Column:
    """Array of product entries (split on ``,``)."""
    return F.split(_col(product_list), ",")


@memo_columns
def product_revenue(entry: Column | str, *, strict: bool = False) -> Column:
    """Revenue of one product entry.

    Four or more ``;`` fields: the trimmed fourth field as a double, NULL
    when it is blank or not a number. Fewer fields: 0.0. ``strict=True``
    also turns NaN, infinities and suffixed numbers such as ``290d`` into
    NULL instead of accepting what a Java double parse accepts.
    """
    parts = F.split(_col(entry), ";")
    raw = F.trim(F.get(parts, 3))
    value = raw.try_cast("double")
    if strict:
        value = F.when(raw.rlike(_PLAIN_NUMBER), value)
        value = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return F.when(F.size(parts) > 3, value).otherwise(F.lit(0.0))


@memo_columns
def product_revenue_decimal(entry: Column | str) -> Column:
    """Exact-money variant: the same rule, as ``DECIMAL(18,2)``."""
    parts = F.split(_col(entry), ";")
    raw = F.trim(F.get(parts, 3))
    value = F.when(raw.rlike(_PLAIN_NUMBER), raw.try_cast("decimal(18,2)"))
    return F.when(F.size(parts) > 3, value).otherwise(F.lit(0).cast("decimal(18,2)"))


@memo_columns
def list_revenue(product_list: Column | str = "product_list", *, strict: bool = False, money: str = "double") -> Column:
    """Revenue of a whole product list: the sum over its entries, NULLs left
    out; NULL when no entry has one."""

    def entry(x: Column) -> Column:
        return product_revenue_decimal(x) if money == "decimal" else product_revenue(x, strict=strict)

    kind = "decimal(28,2)" if money == "decimal" else "double"
    return F.aggregate(
        F.transform(product_entries(product_list), entry),
        F.lit(None).cast(kind),
        lambda total, x: F.coalesce((total + x).cast(kind), total, x.cast(kind)),
    )
