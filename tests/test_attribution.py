"""Session attribution, purchase filtering and the revenue report."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from samples import SAMPLE_REPORT, SHOP, hit, make_hits
from refyield.operators import report as R
from refyield.operators import revenue as V
from refyield.operators import sessions as S

GOOGLE_NO_KW = "http://www.google.com/search?hl=en"
BING_OAK = "http://www.bing.com/search?q=Oak+desk"


def _report(df, **kw):
    return {(r.search_domain, r.search_keyword): r.revenue for r in R.keyword_revenue(df, **kw).collect()}


def test_sample_report_best_first(sample):
    rows = R.ranked(R.keyword_revenue(sample)).collect()
    assert [(r.search_domain, r.search_keyword, r.revenue) for r in rows] == SAMPLE_REPORT


def test_headings_totals_share_engines(sample):
    report = R.keyword_revenue(sample)
    assert R.with_headings(R.ranked(report)).columns == ["Search Engine Domain", "Search Keyword", "Revenue"]
    total = R.totals(report).first()
    assert (total.total_revenue, total.keywords) == (143.74, 3)
    shares = {r.search_keyword: r.share_pct for r in R.revenue_share(report).collect()}
    assert shares == {"Lamp": 44.52, "garden hose": 41.57, "lamp": 13.91}
    counts = R.engine_count(sample).first()
    assert (counts.engines, counts.search_hits) == (4, 5)


def test_top_k(sample):
    rows = R.ranked(R.keyword_revenue(sample), 2).collect()
    assert [r.revenue for r in rows] == [64.0, 59.75]


def test_attributed_purchases_of_the_sample(sample):
    got = {(r.ip, r.hit_time_gmt, r.session_search_keyword) for r in V.attributed_purchases(sample).collect()}
    assert got == {
        ("10.20.0.4", 180, "garden hose"),
        ("10.20.0.4", 450, "garden hose"),
        ("172.18.9.30", 108, "Lamp"),
        ("192.168.77.9", 720, "lamp"),
    }
    assert R.attributed_purchase_count(sample).first().purchases == 4


@pytest.mark.parametrize("events,counts", [("1", True), (" 1 ,7", True), ("21,1", True), ("11", False), ("1x", False), ("0.1", False), ("", False), (None, False)])
def test_which_event_lists_buy(spark, events, counts):
    df = make_hits(spark, [hit(4, "h", events, "k;l;1;3;", "http://aol.com/?q=m")])
    assert R.keyword_revenue(df).count() == V.attributed_purchases(df).count() == int(counts)


def test_sessions_of_the_sample(sample):
    pairs = {r.ip: (r.session_search_domain, r.session_search_keyword) for r in S.session_pairs(sample).collect()}
    assert pairs == {
        "10.20.0.4": ("google.ca", "garden hose"),
        "172.18.9.30": ("bing.com", "Lamp"),
        "192.168.77.5": (None, None),
        "192.168.77.9": ("bing.com", "lamp"),
        "10.0.0.1": ("duckduckgo.com", "tea pot"),
        "10.0.0.2": (None, None),
    }
    credited = S.attribute(sample)
    for ip, pair in pairs.items():
        hits = S.session_lookup(credited, ip=ip).select(S.SESSION_DOMAIN, S.SESSION_KEYWORD)
        assert {tuple(r) for r in hits.collect()} == {pair}


def test_no_search_no_credit(spark):
    rows = [hit(t, "quiet", "1", "k;l;1;12;", SHOP) for t in (3, None)]
    df = make_hits(spark, rows)
    assert V.attributed_purchases(df).isEmpty() and R.keyword_revenue(df).isEmpty()
    assert R.attributed_purchase_count(df).first().purchases == 0


def test_lookahead_decoupled_and_options(spark):
    # t1 purchase (no search), t2 google without keyword, t3 bing with Oak desk.
    rows = [
        hit(1, "9.9.9.9", "1", "a;b;1;10;", SHOP),
        hit(2, "9.9.9.9", "1", "a;b;1;20;", GOOGLE_NO_KW),
        hit(3, "9.9.9.9", "1", "a;b;1;30;", BING_OAK),
    ]
    df = make_hits(spark, rows)
    assert _report(df) == {("google.com", "Oak desk"): 60.0}
    assert _report(df, coupled=True) == {("google.com", None): 60.0}
    assert _report(df, lookahead=False) == {("google.com", None): 20.0, ("google.com", "Oak desk"): 30.0}
    assert _report(df, lookahead=False, coupled=True) == {("google.com", None): 50.0}
    per_hit = {r.hit_time_gmt: (r.session_search_domain, r.session_search_keyword)
               for r in S.attribute(df, lookahead=False).collect()}
    assert per_hit == {1: (None, None), 2: ("google.com", None), 3: ("google.com", "Oak desk")}


def test_null_ip_is_one_session_and_null_time_first(spark):
    rows = [
        hit(None, None, "", "", BING_OAK),
        hit(5, None, "1", "a;b;1;7;", SHOP),
        hit(1, None, "", "", "http://www.google.com/?q=later"),
        hit(3, "", "1", "a;b;1;4;", SHOP),
        hit(2, "", "", "", "http://www.google.com/?q=empty"),
    ]
    df = make_hits(spark, rows)
    assert _report(df) == {("bing.com", "Oak desk"): 7.0, ("google.com", "empty"): 4.0}


def test_ties_in_time_take_lowest_domain_then_keyword(spark):
    rows = [
        hit(1, "a", "", "", "http://www.google.com/?q=b"),
        hit(1, "a", "", "", "http://www.bing.com/?q=z"),
        hit(1, "a", "", "", "http://www.bing.com/?q=y"),
        hit(2, "a", "1", "x;y;1;1;", SHOP),
    ]
    assert _report(make_hits(spark, rows)) == {("bing.com", "y"): 1.0}


def test_group_with_only_null_revenue_is_reported(spark):
    rows = [hit(1, "a", "", "", "http://www.google.com/?q=k"), hit(2, "a", "1", "x;y;1;;", SHOP)]
    assert _report(make_hits(spark, rows)) == {("google.com", "k"): None}


def test_composite_session_keys(spark):
    rows = [
        hit(1, "1.1.1.1", "", "", "http://www.google.com/?q=one", agent="A"),
        hit(1, "1.1.1.1", "", "", "http://www.bing.com/?q=two", agent="B"),
        hit(2, "1.1.1.1", "1", "x;y;1;3;", SHOP, agent="B"),
        hit(3, "1.1.1.1", "1", "x;y;1;5;", SHOP, agent=None),
    ]
    df = make_hits(spark, rows)
    assert _report(df) == {("bing.com", "two"): 8.0}
    assert _report(df, keys=("ip", "user_agent")) == {("bing.com", "two"): 3.0}


def test_observation_counts(sample):
    seen = Observation("t")
    R.keyword_revenue(sample, observation=seen).collect()
    assert seen.get == {"attributed_sessions": 3, "attributed_purchases": 4}


def test_hit_revenue_and_product_lines(sample):
    per_hit = {(r.ip, r.hit_time_gmt): r.hit_revenue for r in V.hit_revenue(V.attributed_purchases(sample)).collect()}
    assert per_hit == {("10.20.0.4", 180): 49.75, ("10.20.0.4", 450): 10.0, ("172.18.9.30", 108): 64.0, ("192.168.77.9", 720): 19.99}


def test_strict_rules_apart(spark):
    rows = [hit(1, "a", "", "", "http://wask.com/?q=x"), hit(2, "a", "1", "k;l;1;5d;", SHOP)]
    df = make_hits(spark, rows)
    assert _report(df) == {("ask.com", "x"): 5.0}
    assert _report(df, strict=True) == {}
    assert _report(df, strict_revenue=True) == {("ask.com", "x"): None}
    rows[0] = hit(1, "a", "", "", "http://ask.com/?q=x")
    assert _report(make_hits(spark, rows), strict=True, strict_revenue=False) == {("ask.com", "x"): 5.0}


def test_decimal_money_is_exact(spark):
    rows = [hit(1, "a", "", "", "http://ask.com/?q=x")] + [hit(2 + i, "a", "1", "k;l;1;0.1;,k;l;1;;", SHOP) for i in range(30)]
    got = R.keyword_revenue(make_hits(spark, rows), money="decimal").first()
    assert str(got.revenue) == "3.00"


# -- equivalence of the aggregate/join plan with the window definition ---------


def _random_sessions(seed: int, n: int = 400):
    rnd = random.Random(seed)
    refs = [SHOP, GOOGLE_NO_KW, BING_OAK, "http://www.google.com/?q=Kettle", "http://search.yahoo.com/?p=cd",
            "http://www.google.com/?q=ipod", "http://www.aol.com/?q=x+y"]
    rows = []
    for i in range(n):
        ip = rnd.choice([None, "", "a", "b", "c", "d", "e"])
        t = rnd.choice([None] + list(range(12)))
        events = rnd.choice(["", "1", "2", "1,12", "10", "2, 1"])
        products = rnd.choice(["", None, "x;y;1;2.5;", "x;y;1;;,x;y;2;1.25;", "x;y"])
        rows.append(hit(t, ip, events, products, rnd.choice(refs)))
    return rows


def _window_report(df, lookahead, coupled):
    attributed = S.attribute_window(df, lookahead=lookahead, coupled=coupled)
    lines = V.product_lines(V.purchase_hits(attributed).filter(F.col(S.SESSION_DOMAIN).isNotNull()))
    out = lines.groupBy(S.SESSION_DOMAIN, S.SESSION_KEYWORD).agg(F.round(F.sum("product_revenue"), 2).alias("r"))
    return Counter(tuple(r) for r in out.collect())


@pytest.mark.parametrize("lookahead,coupled", [(True, False), (False, False), (True, True), (False, True)])
def test_rewrite_equals_window(spark, lookahead, coupled):
    for seed in (1, 2):
        df = make_hits(spark, _random_sessions(seed))
        ours = Counter(tuple(r) for r in R.keyword_revenue(df, lookahead=lookahead, coupled=coupled).collect())
        assert ours == _window_report(df, lookahead, coupled)
        joined = Counter(
            tuple(r) for r in S.attribute(df, lookahead=lookahead, coupled=coupled)
            .select("ip", S.TIME, "referrer", S.SESSION_DOMAIN, S.SESSION_KEYWORD).collect()
        )
        window = Counter(
            tuple(r) for r in S.attribute_window(df, lookahead=lookahead, coupled=coupled)
            .select("ip", S.TIME, "referrer", S.SESSION_DOMAIN, S.SESSION_KEYWORD).collect()
        )
        assert joined == window
