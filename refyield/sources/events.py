"""Hits derived from the ``events`` table, plus the ``pages`` URL table.

The driver's tables hold no hit log, so the hit columns are derived from
``events`` by a fixed rule (one hit per event, the user as session key (NULL for
some), pairs of events at one time (NULL for some), event type as event code,
value as product revenue, a key ``k`` taken from ``props`` choosing the referrer:
several engines, odd keywords, malformed, empty and NULL ones). The same rule is written as DuckDB SQL in
``refyield.plans.oracle`` so both engines see the same hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refyield.sources.hits import HIT_COLUMNS

# The referrers the adapter assigns by key k; any other k
# gets the shop's own (internal) referrer, and ``NO_REFERRER_K`` none.
REFERRER_BY_K: tuple[tuple[int, str], ...] = (
    (3, "https://www.google.co.uk/search?source=hp&q=+lamp+"),
    (7, "http://www.bing.com/search?q=+"),
    (13, "https://duckduckgo.com/?t=h&q=desk%0Alamp"),
    (21, "http://uk.search.yahoo.com/search?fr=x&p=%22oak%22%09desk"),
    (34, "http://www.google.com/webhp?hl=de"),
    (41, "  http://aol.com/aol/search?q=Lamp"),
    (48, "http://www.msn.com/results.aspx?q=lamp#top"),
    (55, "http://wask.com/web?q=quirk"),
    (62, "http://[bad/?q=1"),
    (69, "no url at all"),
    (76, ""),
)
NO_REFERRER_K = 83
INTERNAL_REFERRER = "http://www.shop.example/cart/"

# Event type -> event list (purchase depends on k's parity).
EVENT_LIST_BY_TYPE: tuple[tuple[str, str], ...] = (
    ("view", "2"),
    ("click", "12"),
    ("signup", "11,10"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hits_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hit table (``HIT_SCHEMA`` columns) derived from ``events``."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract(F.col("props"), "([0-9]+)", 1).try_cast("int")
    e = ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))

    kc = F.col("k")
    event_list = F.when(
        F.col("event_type") == "purchase",
        F.when(kc % 2 == 0, F.lit("1")).otherwise(F.lit("2, 1")),
    )
    for etype, codes in EVENT_LIST_BY_TYPE:
        event_list = event_list.when(F.col("event_type") == etype, F.lit(codes))

    money = F.col("value").cast("decimal(12,2)").cast("string")
    extra = (
        F.when(kc % 5 == 0, F.lit(",Cat;Q;2; 1.25 ;"))
        .when(kc % 11 == 0, F.lit(",bad;entry"))
        .when(kc % 13 == 0, F.lit(",Cat;R;1;;"))
        .otherwise(F.lit(""))
    )
    product_list = F.when(kc % 17 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Cat;P"), kc.cast("string"), F.lit(";1;"), money, F.lit(";"), extra)
    )
    # One lookup per row (a CASE per key would repeat k's regexp wherever a
    # filter above inlines the referrer).
    by_k = F.create_map(*[F.lit(x) for pair in REFERRER_BY_K for x in pair])
    referrer = F.when(kc.isNull() | (kc != NO_REFERRER_K), F.coalesce(F.try_element_at(by_k, kc), F.lit(INTERNAL_REFERRER)))
    null = F.lit(None).cast("string")

    cols = {
        "hit_time_gmt": F.when(F.col("event_id") % 101 != 0, F.col("event_id") - F.col("event_id") % 2).cast("long"),
        "date_time": F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"),
        "user_agent": F.when(F.col("event_id") % 3 < 2, F.concat(F.lit("agent "), (F.col("event_id") % 3).cast("string"))),
        "ip": F.when(F.col("user_id") % 50 != 7, F.concat(F.lit("10.0.0."), F.col("user_id").cast("string"))),
        "event_list": event_list,
        "geo_city": null,
        "geo_region": null,
        "geo_country": null,
        "pagename": F.col("event_type"),
        "page_url": null,
        "product_list": product_list,
        "referrer": referrer,
    }
    return e.select(*[cols[c].alias(c) for c in HIT_COLUMNS])


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` pruned to the URL columns (the html body is never read)."""
    return table(spark, sf_dir, "pages").select("page_id", "url")
