"""Add the search engine and keyword of each hit's referrer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refyield.functions import urls

_URL = "__clean_referrer"


def with_search_attributes(
    df: DataFrame,
    url_col: str = "referrer",
    *,
    strict: bool = False,
    domain_col: str = "search_domain",
    keyword_col: str = "search_keyword",
) -> DataFrame:
    """``df`` plus ``search_domain`` and ``search_keyword`` (NULL if not a search).

    The URL is cleaned once and the engine computed once; the keyword
    expression reuses both (separate projections, so Catalyst does not
    inline the regexps into each other) and only parses the query string of
    rows that came from an engine.
    """
    cleaned = df.withColumn(_URL, urls.clean_url(url_col))
    with_domain = cleaned.withColumn(domain_col, urls.search_domain(_URL, strict=strict, cleaned=True))
    with_keyword = with_domain.withColumn(
        keyword_col,
        urls.search_keyword(_URL, domain=domain_col, cleaned=True),
    )
    return with_keyword.drop(_URL)


def search_hits(df: DataFrame, url_col: str = "referrer", *, strict: bool = False) -> DataFrame:
    """Rows whose referrer is a search engine (before parsing them).

    The filter reaches the scan; parse the survivors with
    ``with_search_attributes``, which then only runs on search hits.
    """
    return df.filter(urls.is_search(url_col, strict=strict))
