"""Purchase hits, their attribution, product lines and revenue per hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refyield.functions.commerce import has_products, is_purchase, product_entries, product_revenue
from refyield.functions.sums import repeatable_sum
from refyield.operators import sessions as S
from refyield.operators.search import with_search_attributes


def purchase_hits(df: DataFrame) -> DataFrame:
    """Hits whose event list holds code 1 on its own and that list products."""
    return df.filter(is_purchase("event_list") & has_products("product_list"))


def attributed_purchases(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Purchase hits of sessions credited to a search engine, with the credit.

    Only purchase hits and search hits are shuffled: purchases INNER
    JOIN the per-session first touch (the inner join drops sessions without
    search). Each purchase keeps its own ``search_domain``/``search_keyword``.
    """
    keys = S.normalize_keys(keys)
    touch = S.first_touch(hits, keys, coupled=coupled, with_keys=not lookahead, strict=strict)
    buys = with_search_attributes(purchase_hits(hits), strict=strict)
    joined = S.join_touch(buys.select("*", *S.key_columns(keys)), touch, keys, "inner")
    domain, keyword = S.credited(lookahead)
    out = joined.select(*buys.columns, domain.alias(S.SESSION_DOMAIN), keyword.alias(S.SESSION_KEYWORD))
    return out if lookahead else out.filter(F.col(S.SESSION_DOMAIN).isNotNull())


def product_lines(purchases: DataFrame, *, strict: bool = False) -> DataFrame:
    """One row per product entry: ``product_index``, ``product_entry``, ``product_revenue``."""
    exploded = purchases.select("*", F.posexplode(product_entries("product_list")).alias("product_index", "product_entry"))
    return exploded.withColumn("product_revenue", product_revenue("product_entry", strict=strict))


def hit_revenue(
    attributed: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    strict: bool = False,
) -> DataFrame:
    """Revenue per (session, second, engine, keyword); purchases in one second merge."""
    keys = S.normalize_keys(keys)
    lines = product_lines(attributed, strict=strict)
    return lines.groupBy(*keys, S.TIME, S.SESSION_DOMAIN, S.SESSION_KEYWORD).agg(
        repeatable_sum("product_revenue").alias("hit_revenue")
    )
