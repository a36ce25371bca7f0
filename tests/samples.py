"""Hits that the tests share."""

from __future__ import annotations

from refyield.sources.hits import HIT_SCHEMA


def hit(t, ip, events, products, referrer, agent="Mozilla/5.0"):
    """A hit row in HIT_SCHEMA order; unused columns get plain values."""
    return (t, "2024-03-05 06:00:00", agent, ip, events, "City", "ST", "US", "Page", "http://shop.example/", products, referrer)


SHOP = "http://www.shop.example/"


def _visit(ip, start, referrer, steps, agent="Mozilla/5.0"):
    """A session: its first hit from ``referrer``, then (seconds, events,
    products, page) from the shop itself."""
    rows = [hit(start, ip, "", "", referrer, agent)]
    return rows + [hit(start + t, ip, e, p, SHOP + page, agent) for t, e, p, page in steps]


# Three sessions that buy after a search, one that only searches, one that buys
# without a search. Empty fields are "" as in memory.
SAMPLE_ROWS = [
    *_visit(
        "10.20.0.4",
        50,
        "https://www.google.ca/search?q=garden+hose&num=20",
        [
            (40, "2", "Garden;Hose 20m;1;;", "p/hose"),
            (95, "12", "", "basket"),
            (130, "1", "Garden;Hose 20m;1;42.5;,Garden;Nozzle;2;7.25;", "done"),
            (400, "2, 1", "Garden;Gloves;1;10;", "done"),
        ],
    ),
    hit(300, "10.20.0.4", "", "", "http://search.yahoo.com/search?p=gloves"),
    *_visit("172.18.9.30", 75, "http://www.bing.com/search?form=X&q=Lamp", [(9, "2", "Light;Lamp;1;;", "p/lamp"), (33, "1,12", "Light;Lamp;1;64;", "done")]),
    *_visit("192.168.77.5", 61, "http://www.bing.co/?q=none", [(5, "10", "Light;Lamp;1;64;", "p/lamp")]),
    *_visit("192.168.77.9", 20, "http://bing.com/search?q=lamp", [(700, "1", "Light;Lamp S;1; 19.99 ;", "done")], agent="Opera"),
    *_visit("10.0.0.1", 33, "https://duckduckgo.com/?q=tea+pot", [(8, "11", "", "basket")]),
    *_visit("10.0.0.2", 34, SHOP, [(8, "1", "Desk;Oak;1;500;", "done")]),
]

#: The sample's report, best first.
SAMPLE_REPORT = [("bing.com", "Lamp", 64.0), ("google.ca", "garden hose", 59.75), ("bing.com", "lamp", 19.99)]


def make_hits(spark, rows):
    return spark.createDataFrame(rows, schema=HIT_SCHEMA)
