"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (``events`` through the hit adapter,
or ``pages``) in full, so its work grows with the data. The DuckDB
statements computing the same answers live in ``refyield.plans.oracle``;
column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.functions import urls
from refyield.operators import report as R
from refyield.operators import revenue as V
from refyield.operators import sessions as S
from refyield.operators.days import SessionDays
from refyield.operators.search import with_search_attributes
from refyield.session import scratch_path
from refyield.sinks.hits import write_hits, write_hits_by_date, write_hits_by_session
from refyield.sinks.report import read_report, write_report
from refyield.sources.events import hits_from_events, pages
from refyield.sources.hits import read_hits, read_hits_by_session, read_hits_parquet

Query = Callable[[SparkSession, str], DataFrame]

PAGE_PARAMS = ("ref", "page", "utm_source")


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_from_events(spark, sf_dir)


# -- report family --------------------------------------------------------


def keyword_revenue(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir))


def ranked_report(spark, sf_dir):
    return R.ranked(keyword_revenue(spark, sf_dir))


def top_keywords(spark, sf_dir, k: int = 5):
    """The k best rows, with their rank (a window over those k alone)."""
    best = R.ranked(keyword_revenue(spark, sf_dir), k)
    return best.select(F.row_number().over(Window.orderBy(*R.rank_order())).alias("rank"), "*")


def report_ranks(spark, sf_dir):
    """The rank of every row of the report."""
    return R.with_ranks(keyword_revenue(spark, sf_dir))


def report_headings(spark, sf_dir):
    return R.with_headings(ranked_report(spark, sf_dir))


def total_revenue(spark, sf_dir):
    return R.totals(keyword_revenue(spark, sf_dir))


def revenue_share(spark, sf_dir):
    return R.revenue_share(keyword_revenue(spark, sf_dir))


def engine_count(spark, sf_dir):
    return R.engine_count(_hits(spark, sf_dir))


def keyword_revenue_no_lookahead(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir), lookahead=False)


def keyword_revenue_coupled(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir), coupled=True)


def keyword_revenue_coupled_no_lookahead(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir), lookahead=False, coupled=True)


def keyword_revenue_two_keys(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir), ("ip", "user_agent"))


def keyword_revenue_decimal(spark, sf_dir):
    """Summed as exact decimals, shown as doubles."""
    return R.keyword_revenue(_hits(spark, sf_dir), money="decimal").withColumn("revenue", F.col("revenue").cast("double"))


def keyword_revenue_strict(spark, sf_dir):
    return R.keyword_revenue(_hits(spark, sf_dir), strict=True)


# -- URL functions ---------------------------------------------------------


def referrer_netloc(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.netloc(F.col("url")).alias("netloc"))


def referrer_host(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.host(F.col("url")).alias("host"))


def query_param(spark, sf_dir):
    url = urls.clean_url(F.col("url"))
    p = pages(spark, sf_dir).select("page_id", url.alias("u"))
    return p.select("page_id", *[urls.query_param(F.col("u"), n, cleaned=True).alias(n) for n in PAGE_PARAMS])


def search_domain(spark, sf_dir):
    return _hits(spark, sf_dir).select(S.TIME, urls.search_domain(F.col("referrer")).alias("search_domain"))


def search_keyword(spark, sf_dir):
    return _hits(spark, sf_dir).select(S.TIME, urls.search_keyword(F.col("referrer")).alias("search_keyword"))


def search_attributes(spark, sf_dir):
    hits = _hits(spark, sf_dir).select(S.TIME, "ip", "referrer")
    return with_search_attributes(hits)


# -- stages ------------------------------------------------------------------


def purchase_hits(spark, sf_dir):
    return V.purchase_hits(_hits(spark, sf_dir)).select(S.TIME, "ip", "event_list", "product_list")


def session_attribution(spark, sf_dir):
    hits = _hits(spark, sf_dir).select(S.TIME, "ip", "referrer")
    return S.attribute(hits).select(S.TIME, "ip", S.SESSION_DOMAIN, S.SESSION_KEYWORD)


def session_pairs(spark, sf_dir):
    return S.session_pairs(_hits(spark, sf_dir))


def _attributed(spark, sf_dir) -> DataFrame:
    return V.attributed_purchases(_hits(spark, sf_dir))


def attributed_purchases(spark, sf_dir):
    return _attributed(spark, sf_dir).select(
        S.TIME, "ip", "event_list", "product_list", S.SESSION_DOMAIN, S.SESSION_KEYWORD
    )


def product_lines(spark, sf_dir):
    lines = V.product_lines(_attributed(spark, sf_dir))
    return lines.select(S.TIME, "ip", "product_index", "product_entry", "product_revenue")


def hit_revenue(spark, sf_dir):
    per_hit = V.hit_revenue(_attributed(spark, sf_dir))
    return per_hit.withColumn("hit_revenue", F.round("hit_revenue", 2))


def purchase_count(spark, sf_dir):
    return R.attributed_purchase_count(_hits(spark, sf_dir))


# -- source and sink round trips ---------------------------------------------


def hits_scan(spark, sf_dir):
    """Hits written as tab-separated text to the shared folder, read back."""
    path = scratch_path(spark, "hits-tsv")
    write_hits(_hits(spark, sf_dir), path)
    return read_hits(spark, path)


def report_write(spark, sf_dir):
    """Ranked report written with the published headings, read back."""
    out_dir = scratch_path(spark, "report")
    path = write_report(ranked_report(spark, sf_dir), out_dir, run_date="2024-03-05")
    return read_report(spark, path)


def report_parquet(spark, sf_dir):
    """Ranked report written as a dated Parquet partition, read back."""
    out_dir = scratch_path(spark, "report-parquet")
    write_report(ranked_report(spark, sf_dir), out_dir, run_date="2024-03-05", fmt="parquet")
    return spark.read.parquet(out_dir).withColumn("run_date", F.col("run_date").cast("string"))


def hits_by_date(spark, sf_dir):
    """Hits written by their UTC day (those without a time apart), read back."""
    path = write_hits_by_date(_hits(spark, sf_dir), scratch_path(spark, "hits-by-date"))
    return read_hits_parquet(spark, path).withColumn("hit_date", F.col("hit_date").cast("string"))


def hits_scan_lossless(spark, sf_dir):
    """The text scan with escapes: empty texts, NULL and line breaks come back."""
    path = write_hits(_hits(spark, sf_dir), scratch_path(spark, "hits-tsv"), escapes=True)
    return read_hits(spark, path, escapes=True)


def hits_by_session(spark, sf_dir):
    """Hits written in ranges of sessions, read back."""
    path = write_hits_by_session(_hits(spark, sf_dir), scratch_path(spark, "hits-by-session"), ("ip", "user_agent"))
    return read_hits_by_session(spark, path)


def report_replace(spark, sf_dir):
    """The report replaced whole, with escapes: first by its best rows, then by all."""
    out_dir, report = scratch_path(spark, "report-replace"), ranked_report(spark, sf_dir)
    for rows in (R.ranked(report, 1), report):
        path = write_report(rows, out_dir, run_date="2024-03-05", mode="replace", escapes=True)
    return read_report(spark, path, escapes=True)


def _by_days(spark, sf_dir, **rules) -> DataFrame:
    """Times half a minute apart instead of a second: the events then cover days."""
    hits = _hits(spark, sf_dir).withColumn(S.TIME, F.col(S.TIME) * 30)
    dated = read_hits_parquet(spark, write_hits_by_date(hits, scratch_path(spark, "hits-by-date")))
    state = SessionDays(spark, scratch_path(spark, "session-days"), **rules)
    state.add_days(dated, parts=2)  # in turn: sessions go on from one part to the next
    return state.report()


def keyword_revenue_by_days(spark, sf_dir):
    """The report from a state to which each day's hits are added once."""
    return _by_days(spark, sf_dir)


def keyword_revenue_by_days_no_lookahead(spark, sf_dir):
    return _by_days(spark, sf_dir, lookahead=False)


def session_attribution_window(spark, sf_dir):
    """The window form: a prefix scan over chunks of sessions."""
    hits = _hits(spark, sf_dir).select(S.TIME, "ip", "referrer")
    return S.attribute_window(hits, lookahead=False).select(S.TIME, "ip", S.SESSION_DOMAIN, S.SESSION_KEYWORD)


def hits_scan_strict(spark, sf_dir):
    """The text scan with every file's header checked against the schema."""
    path = write_hits(_hits(spark, sf_dir), scratch_path(spark, "hits-tsv"))
    return read_hits(spark, path, strict=True)


QUERIES: dict[str, Query] = {
    "keyword_revenue": keyword_revenue,
    "ranked_report": ranked_report,
    "top_keywords": top_keywords,
    "report_headings": report_headings,
    "total_revenue": total_revenue,
    "revenue_share": revenue_share,
    "engine_count": engine_count,
    "keyword_revenue_no_lookahead": keyword_revenue_no_lookahead,
    "keyword_revenue_coupled": keyword_revenue_coupled,
    "keyword_revenue_coupled_no_lookahead": keyword_revenue_coupled_no_lookahead,
    "keyword_revenue_two_keys": keyword_revenue_two_keys,
    "keyword_revenue_decimal": keyword_revenue_decimal,
    "keyword_revenue_strict": keyword_revenue_strict,
    "referrer_netloc": referrer_netloc,
    "referrer_host": referrer_host,
    "query_param": query_param,
    "search_domain": search_domain,
    "search_keyword": search_keyword,
    "search_attributes": search_attributes,
    "purchase_hits": purchase_hits,
    "session_attribution": session_attribution,
    "session_pairs": session_pairs,
    "attributed_purchases": attributed_purchases,
    "product_lines": product_lines,
    "hit_revenue": hit_revenue,
    "purchase_count": purchase_count,
    "hits_scan": hits_scan,
    "report_write": report_write,
    "report_parquet": report_parquet,
    "hits_by_date": hits_by_date,
    "hits_scan_strict": hits_scan_strict,
    "hits_scan_lossless": hits_scan_lossless,
    "hits_by_session": hits_by_session,
    "report_replace": report_replace,
    "report_ranks": report_ranks,
    "keyword_revenue_by_days": keyword_revenue_by_days,
    "keyword_revenue_by_days_no_lookahead": keyword_revenue_by_days_no_lookahead,
    "session_attribution_window": session_attribution_window,
}
