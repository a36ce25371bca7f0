"""Revenue per search engine and keyword, and the figures derived from it.

``keyword_revenue`` is the whole job as one lazy plan:

    hits -> keep purchases and search hits only
         -> (engine, keyword) of each referrer, revenue of each product list
         -> per session: first touch + purchase revenue   (shuffle 1, map-side partial agg)
         -> per (engine, keyword): revenue                 (shuffle 2, map-side partial agg)

With look-ahead (the default) all purchases of a session share one credit,
so the first touch and the session's revenue are one aggregate over the
same key and the hit table is scanned once. Without look-ahead the credit
depends on each purchase's position, so purchases are joined to the first touch
instead and the hit table is scanned twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from refyield.functions import urls
from refyield.functions.commerce import has_products, is_purchase, list_revenue
from refyield.functions.sums import repeatable_sum
from refyield.operators import sessions as S
from refyield.operators.ranking import with_rank
from refyield.operators.search import search_hits, with_search_attributes

REVENUE = "revenue"

# Report column headings.
HEADINGS: tuple[tuple[str, str], ...] = (
    ("search_domain", "Search Engine Domain"),
    ("search_keyword", "Search Keyword"),
    ("revenue", "Revenue"),
)

_REV = "__rev"
_HITS = "__hits"


def total(column: str, money: str) -> Column:
    """Aggregate: the sum of revenues, the same in any order of the rows."""
    return F.sum(column) if money == "decimal" else repeatable_sum(column)


def rounded(c: Column, money: str) -> Column:
    return c.cast("decimal(28,2)") if money == "decimal" else F.round(c, 2)


def keyword_revenue(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
    strict_revenue: bool | None = None,
    money: str = "double",
    observation: Observation | None = None,
) -> DataFrame:
    """``search_domain, search_keyword, revenue`` (rounded to cents), unordered.

    ``strict`` is the strict host rule (only ``www.`` dropped), and strict revenue
    parsing too unless ``strict_revenue`` says otherwise. ``money="decimal"`` sums exact ``DECIMAL(18,2)``;
    doubles are summed so that the order of the rows does not matter.
    ``observation`` (optional) collects attributed purchase hits and
    sessions with no extra job.
    """
    keys = S.normalize_keys(keys)
    sessions = session_revenue(
        hits, keys, lookahead=lookahead, coupled=coupled, strict=strict, strict_revenue=strict_revenue, money=money
    )
    if observation is not None:
        sessions = sessions.observe(
            observation,
            F.count(F.lit(1)).alias("attributed_sessions"),
            F.sum(_HITS).alias("attributed_purchases"),
        )
    return sessions.groupBy(
        F.col("__domain").alias(S.DOMAIN), F.col("__keyword").alias(S.KEYWORD)
    ).agg(rounded(total(_REV, money), money).alias(REVENUE))


def session_revenue(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
    strict_revenue: bool | None = None,
    money: str = "double",
) -> DataFrame:
    """Credited purchases: ``__domain, __keyword, __rev, __hits`` (their number),
    a row for each session with look-ahead, else for each purchase hit."""
    keys = S.normalize_keys(keys)
    buy = is_purchase("event_list") & has_products("product_list")
    revenue = list_revenue("product_list", strict=strict if strict_revenue is None else strict_revenue, money=money)
    if lookahead:
        return _fused_sessions(hits, keys, buy, revenue, coupled=coupled, strict=strict, money=money)
    return _joined_purchases(hits, keys, buy, revenue, coupled=coupled, strict=strict)


def attributed_purchase_count(hits: DataFrame, keys: str | Sequence[str] = ("ip",), *, strict: bool = False) -> DataFrame:
    """One row: the number of purchase hits credited to a search (one scan)."""
    return session_revenue(hits, keys, strict=strict).agg(F.coalesce(F.sum(_HITS), F.lit(0)).alias("purchases"))


def _fused_sessions(hits, keys, buy, revenue, *, coupled, strict, money) -> DataFrame:
    needed = hits.select(*dict.fromkeys([*keys, S.TIME, "event_list", "product_list", "referrer"]))
    # the cheap test first: a purchase's referrer need not be searched
    wanted = needed.filter(buy | urls.is_search("referrer", strict=strict))
    parsed = with_search_attributes(wanted, strict=strict)
    rows = parsed.select(
        *S.key_columns(keys), S.TIME, S.DOMAIN, S.KEYWORD, F.when(buy, revenue).alias(_REV), buy.alias(_HITS)
    )
    per_session = rows.groupBy(*S.key_names(keys)).agg(
        *S.touch_aggregates(coupled=coupled), total(_REV, money).alias(_REV), F.count_if(_HITS).alias(_HITS)
    )
    return per_session.filter(F.col("__first_domain").isNotNull() & (F.col(_HITS) > 0)).select(
        F.col("__first_domain").alias("__domain"), F.col("__first_keyword").alias("__keyword"), _REV, _HITS
    )


def _joined_purchases(hits, keys, buy, revenue, *, coupled, strict) -> DataFrame:
    touch = S.first_touch(hits, keys, coupled=coupled, with_keys=True, strict=strict)
    needed = hits.select(*dict.fromkeys([*keys, S.TIME, "event_list", "product_list", "referrer"]))
    buys = with_search_attributes(needed.filter(buy), strict=strict).select(
        *S.key_columns(keys), S.TIME, S.order_key().alias("__hit_key"), revenue.alias(_REV)
    )
    domain, keyword = S.credited(False, "__hit_key")
    joined = S.join_touch(buys, touch, keys, "inner")
    credited = joined.select(domain.alias("__domain"), keyword.alias("__keyword"), _REV, F.lit(1).alias(_HITS))
    return credited.filter(F.col("__domain").isNotNull())


def rank_order() -> list[Column]:
    return [F.col(REVENUE).desc_nulls_last(), F.col(S.DOMAIN).asc_nulls_first(), F.col(S.KEYWORD).asc_nulls_first()]


def ranked(report: DataFrame, k: int | None = None) -> DataFrame:
    """Report by revenue descending (NULL last); ties by domain, then keyword.

    With ``k`` only the top ``k`` rows are kept (planned as a take-ordered
    top-k, no global sort).
    """
    out = report.orderBy(*rank_order())
    return out.limit(k) if k is not None else out


def with_ranks(report: DataFrame) -> DataFrame:
    """The report plus ``rank`` (1, 2, 3, ...) for every row, in the order of ``ranked``."""
    return with_rank(report, rank_order())


def with_headings(report: DataFrame) -> DataFrame:
    """Rename to the published headings: Search Engine Domain, Search Keyword, Revenue."""
    return report.select(*[F.col(src).alias(dst) for src, dst in HEADINGS])


def _grand_total(report: DataFrame) -> Column:
    return total(REVENUE, "double" if dict(report.dtypes)[REVENUE] == "double" else "decimal")


def totals(report: DataFrame) -> DataFrame:
    """One row: total attributed revenue and number of (engine, keyword) rows."""
    return report.agg(
        F.round(_grand_total(report), 2).alias("total_revenue"),
        F.count(F.lit(1)).alias("keywords"),
    )


def revenue_share(report: DataFrame) -> DataFrame:
    """Report plus ``share_pct``: percent of the total, rounded to 2 places.

    The total is a scalar subquery (one value computed by its own small job
    and inlined), not a window over the whole report, which would pull every
    row into one partition.
    """
    all_revenue = report.agg(F.round(_grand_total(report), 2).alias("t")).scalar()
    return report.select("*", F.round(F.col(REVENUE) * 100 / all_revenue, 2).alias("share_pct"))


def engine_count(hits: DataFrame, *, strict: bool = False) -> DataFrame:
    """One row: number of distinct search engines seen in referrers, and search hits."""
    parsed = with_search_attributes(search_hits(hits.select("referrer"), strict=strict), strict=strict)
    return parsed.agg(
        F.count_distinct(S.DOMAIN).alias("engines"),
        F.count(S.DOMAIN).alias("search_hits"),
    )
