"""DuckDB statements giving the same answers as ``refyield.plans.catalog``.

Written independently in the window shape (``first_value ... IGNORE NULLS``
over the whole session), so they also check our aggregate/join rewrite.
The keyword parse here is the general list-based one; DuckDB's
``url_decode`` raises on malformed escapes, which the driver's data has none of.
"""

from __future__ import annotations

from refyield.sources.events import INTERNAL_REFERRER, NO_REFERRER_K, REFERRER_BY_K

# Fixed values shared with the Spark side (see refyield.functions.urls).
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_ENGINE = r"^(?:[^\[\]]*\.)?(google\.com|google\.co\.uk|google\.ca|bing\.com|msn\.com|yahoo\.com|ask\.com|aol\.com|duckduckgo\.com)$"
_QUERY = r"^[^#?]*\?([^#]*)"
_PURCHASE = r"(^|,)\s*1\s*(,|$)"


def _decode(x: str) -> str:
    return f"url_decode(replace({x}, '+', '%20'))"


def _param(query: str, name: str) -> str:
    """First non-empty decoded value of parameter ``name`` (SQL expression)."""
    pair_name = _decode("regexp_extract(p, '^([^=]*)=', 1)")
    pick = (
        f"list_filter(string_split({query}, '&'), lambda p: regexp_matches(p, '^[^=]*=.') "
        f"AND {pair_name} = {name})[1]"
    )
    return _decode(f"regexp_extract({pick}, '^[^=]*=(.*)$', 1)")


# The adapter's referrers (as values; the rules below are written anew).
_REFERRERS = " ".join(f"WHEN {k} THEN '{url}'" for k, url in REFERRER_BY_K)

HITS = f"""
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
hits AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN event_id - event_id % 2 END AS hit_time_gmt,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
         CASE WHEN event_id % 3 < 2 THEN 'agent ' || CAST(event_id % 3 AS VARCHAR) END AS user_agent,
         CASE WHEN user_id % 50 <> 7 THEN '10.0.0.' || CAST(user_id AS VARCHAR) END AS ip,
         CASE event_type WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN '1' ELSE '2, 1' END
              WHEN 'view' THEN '2' WHEN 'click' THEN '12' WHEN 'signup' THEN '11,10' END AS event_list,
         CAST(NULL AS VARCHAR) AS geo_city,
         CAST(NULL AS VARCHAR) AS geo_region,
         CAST(NULL AS VARCHAR) AS geo_country,
         event_type AS pagename,
         CAST(NULL AS VARCHAR) AS page_url,
         CASE WHEN k % 17 = 0 THEN NULL ELSE
           'Cat;P' || CAST(k AS VARCHAR) || ';1;' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ';' ||
           CASE WHEN k % 5 = 0 THEN ',Cat;Q;2; 1.25 ;' WHEN k % 11 = 0 THEN ',bad;entry'
                WHEN k % 13 = 0 THEN ',Cat;R;1;;' ELSE '' END END AS product_list,
         CASE k {_REFERRERS} WHEN {NO_REFERRER_K} THEN NULL ELSE '{INTERNAL_REFERRER}' END AS referrer
  FROM e)"""

def _parsed(host_prefix: str = r"^[w.]+") -> str:
    return f"""
c AS (
  SELECT * EXCLUDE (referrer), referrer, regexp_replace(regexp_replace(referrer, '[\\t\\r\\n]', '', 'g'), '^[\\x01-\\x20]+', '') AS url
  FROM hits),
d AS (
  SELECT * EXCLUDE (url), url, NULLIF(regexp_extract(regexp_replace(lower(regexp_extract(url, '{_NETLOC}', 1)),
                   '{host_prefix}', ''), '{_ENGINE}', 1), '') AS search_domain
  FROM c),
parsed AS (
  SELECT * EXCLUDE (url), CASE WHEN search_domain IS NOT NULL THEN
           {_param(f"regexp_extract(url, '{_QUERY}', 1)",
                   "CASE WHEN search_domain = 'yahoo.com' THEN 'p' ELSE 'q' END")} END AS search_keyword
  FROM d)"""


PARSED = _parsed()

_ORDER = "ORDER BY hit_time_gmt ASC NULLS FIRST, search_domain ASC NULLS FIRST, search_keyword ASC NULLS FIRST"


def _attributed(lookahead: bool = True, coupled: bool = False, keys: str = "ip", money: str = "DOUBLE") -> str:
    end = "UNBOUNDED FOLLOWING" if lookahead else "CURRENT ROW"
    w = f"(PARTITION BY {keys} {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"
    if coupled:
        first = (
            "first_value(CASE WHEN search_domain IS NOT NULL THEN "
            f"struct_pack(d := search_domain, k := search_keyword) END IGNORE NULLS) OVER {w}"
        )
        cols = f"({first}).d AS session_search_domain, ({first}).k AS session_search_keyword"
    else:
        cols = (
            f"first_value(search_domain IGNORE NULLS) OVER {w} AS session_search_domain, "
            f"first_value(search_keyword IGNORE NULLS) OVER {w} AS session_search_keyword"
        )
    return f"""
attributed AS (SELECT *, {cols} FROM parsed),
purchases AS (
  SELECT * FROM attributed
  WHERE regexp_matches(event_list, '{_PURCHASE}') AND product_list IS NOT NULL AND product_list <> ''
    AND session_search_domain IS NOT NULL),
exploded AS (
  SELECT *, unnest(range(len(string_split(product_list, ',')))) AS product_index,
            unnest(string_split(product_list, ',')) AS product_entry
  FROM purchases),
lines AS (
  SELECT * EXCLUDE (product_index), CAST(product_index AS INTEGER) AS product_index,
         CASE WHEN len(string_split(product_entry, ';')) > 3
              THEN TRY_CAST(trim(string_split(product_entry, ';')[4]) AS {money}) ELSE 0 END AS product_revenue
  FROM exploded),
report AS (
  SELECT session_search_domain AS search_domain, session_search_keyword AS search_keyword,
         ROUND(CAST(SUM(product_revenue) AS DOUBLE), 2) AS revenue
  FROM lines GROUP BY 1, 2)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


FULL = _with(HITS, PARSED, _attributed())

_PAGES_NETLOC = f"NULLIF(regexp_extract(url, '{_NETLOC}', 1), '')"
_PAGES_QUERY = f"regexp_extract(url, '{_QUERY}', 1)"
_RANKED = "ORDER BY revenue DESC NULLS LAST, search_domain ASC NULLS FIRST, search_keyword ASC NULLS FIRST"
_HEADINGS = 'search_domain AS "Search Engine Domain", search_keyword AS "Search Keyword", revenue AS "Revenue"'

ORACLE_SQL: dict[str, str] = {
    "keyword_revenue": FULL + "SELECT * FROM report",
    "ranked_report": FULL + f"SELECT * FROM report {_RANKED}",
    "top_keywords": FULL + f"SELECT row_number() OVER ({_RANKED}) AS rank, * FROM report {_RANKED} LIMIT 5",
    "report_headings": FULL + f"SELECT {_HEADINGS} FROM report {_RANKED}",
    "total_revenue": FULL + "SELECT ROUND(SUM(revenue), 2) AS total_revenue, COUNT(*) AS keywords FROM report",
    "revenue_share": FULL
    + "SELECT *, ROUND(revenue * 100 / (SELECT ROUND(SUM(revenue), 2) FROM report), 2) AS share_pct FROM report",
    "engine_count": _with(HITS, PARSED)
    + "SELECT COUNT(DISTINCT search_domain) AS engines, COUNT(search_domain) AS search_hits FROM parsed",
    "keyword_revenue_no_lookahead": _with(HITS, PARSED, _attributed(lookahead=False)) + "SELECT * FROM report",
    "keyword_revenue_coupled": _with(HITS, PARSED, _attributed(coupled=True)) + "SELECT * FROM report",
    "keyword_revenue_coupled_no_lookahead": _with(HITS, PARSED, _attributed(lookahead=False, coupled=True))
    + "SELECT * FROM report",
    "keyword_revenue_two_keys": _with(HITS, PARSED, _attributed(keys="ip, user_agent")) + "SELECT * FROM report",
    "keyword_revenue_decimal": _with(HITS, PARSED, _attributed(money="DECIMAL(18,2)")) + "SELECT * FROM report",
    "keyword_revenue_strict": _with(HITS, _parsed(r"^www\."), _attributed()) + "SELECT * FROM report",
    "referrer_netloc": f"SELECT page_id, {_PAGES_NETLOC} AS netloc FROM pages",
    "referrer_host": f"SELECT page_id, regexp_replace(lower({_PAGES_NETLOC}), '^[w.]+', '') AS host FROM pages",
    "query_param": "SELECT page_id, "
    + ", ".join(f"{_param(_PAGES_QUERY, repr(n))} AS {n}" for n in ("ref", "page", "utm_source"))
    + " FROM pages",
    "search_domain": _with(HITS, PARSED) + "SELECT hit_time_gmt, search_domain FROM parsed",
    "search_keyword": _with(HITS, PARSED) + "SELECT hit_time_gmt, search_keyword FROM parsed",
    "search_attributes": _with(HITS, PARSED)
    + "SELECT hit_time_gmt, ip, referrer, search_domain, search_keyword FROM parsed",
    "purchase_hits": _with(HITS)
    + "SELECT hit_time_gmt, ip, event_list, product_list FROM hits "
    + f"WHERE regexp_matches(event_list, '{_PURCHASE}') AND product_list IS NOT NULL AND product_list <> ''",
    "session_attribution": FULL
    + "SELECT hit_time_gmt, ip, session_search_domain, session_search_keyword FROM attributed",
    "session_pairs": FULL + "SELECT DISTINCT ip, session_search_domain, session_search_keyword FROM attributed",
    "attributed_purchases": FULL
    + "SELECT hit_time_gmt, ip, event_list, product_list, session_search_domain, session_search_keyword FROM purchases",
    "product_lines": FULL
    + "SELECT hit_time_gmt, ip, product_index, product_entry, product_revenue FROM lines",
    "hit_revenue": FULL
    + "SELECT ip, hit_time_gmt, session_search_domain, session_search_keyword, "
    + "ROUND(SUM(product_revenue), 2) AS hit_revenue FROM lines GROUP BY ALL",
    "purchase_count": FULL + "SELECT COUNT(*) AS purchases FROM purchases",
    "hits_scan": _with(HITS) + "SELECT * EXCLUDE (referrer), NULLIF(referrer, '') AS referrer FROM hits",
    "report_parquet": FULL + "SELECT *, '2024-03-05' AS run_date FROM report",
    "hits_by_date": _with(HITS)
    + "SELECT *, CAST(DATE '1970-01-01' + CAST(floor(hit_time_gmt / 86400) AS INTEGER) AS VARCHAR) AS hit_date FROM hits",
    "hits_scan_strict": _with(HITS) + "SELECT * EXCLUDE (referrer), NULLIF(referrer, '') AS referrer FROM hits",
    "hits_scan_lossless": _with(HITS) + "SELECT * FROM hits",
    "hits_by_session": _with(HITS) + "SELECT * FROM hits",
    "report_replace": FULL + f"SELECT {_HEADINGS} FROM report {_RANKED}",
    "report_ranks": FULL + f"SELECT row_number() OVER ({_RANKED}) AS rank, * FROM report",
    "keyword_revenue_by_days": FULL + "SELECT * FROM report",
    "keyword_revenue_by_days_no_lookahead": _with(HITS, PARSED, _attributed(lookahead=False)) + "SELECT * FROM report",
    "session_attribution_window": _with(HITS, PARSED, _attributed(lookahead=False))
    + "SELECT hit_time_gmt, ip, session_search_domain, session_search_keyword FROM attributed",
    "report_write": FULL + f"SELECT {_HEADINGS} FROM report {_RANKED}",
}
