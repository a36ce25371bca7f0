"""First-touch search attribution per session.

A session is every hit sharing the session key columns (``ip`` by default,
with no time limit; NULL keys form one session). Each session is credited
to its *first* search touch in the order (``hit_time_gmt`` with NULL first,
then engine domain, then keyword), and

* ``lookahead=True`` (default) credits every hit of the session, also hits
  before the first search touch; ``lookahead=False`` credits only hits at
  or after it;
* ``coupled=False`` (default) takes the engine from the first hit that has
  one and the keyword from the first hit that has one, independently, so
  they may come from different hits; ``coupled=True`` takes both from the
  first search hit.

Plan: the first touch of each session is an aggregate over search hits only
(a few percent of all hits), with map-side partial aggregation, so a hot
session key (a proxy IP holding a third of all hits) is combined inside
every map task before the shuffle. Session keys are made null-safe by
grouping on ``(key IS NULL, coalesce(key, ''))``. Forms that give every hit its
credit join the hits to the touches on the key (``join_touch``). A sketch of the
hits' keys finds the sessions that hold more hits than a task's share
(``hot_sessions``); their hits are dealt over as many tasks as their size asks
for, and only their touches are repeated for each. ``min_by`` over strings is
planned as a sort aggregate: the rows that reach it (search hits, and purchases
in the fused report) are sorted by session.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refyield.functions._memo import memo_columns
from refyield.operators.ranking import PLACE, RANGE, by_ranges
from refyield.operators.search import search_hits, with_search_attributes

TIME = "hit_time_gmt"
DOMAIN = "search_domain"
KEYWORD = "search_keyword"
SESSION_DOMAIN = "session_search_domain"
SESSION_KEYWORD = "session_search_keyword"

# NULL times sort first: coalesce them to the smallest long.
_TIME_FLOOR = -(2**63)

# A session is hot where it holds more hits than this and than a task's share;
# at most so many are told apart.
HOT_LEAST, HOT_MOST = 1_000, 1024
_SALT = "__salt"

_FIRST_DOMAIN = "__first_domain"
_FIRST_KEYWORD = "__first_keyword"
_DOMAIN_KEY = "__domain_key"
_KEYWORD_KEY = "__keyword_key"


def normalize_keys(keys: str | Sequence[str]) -> tuple[str, ...]:
    return (keys,) if isinstance(keys, str) else tuple(keys)


def key_names(keys: Sequence[str]) -> list[str]:
    names: list[str] = []
    for i in range(len(keys)):
        names += [f"__sk{i}_null", f"__sk{i}"]
    return names


@memo_columns
def key_columns(keys: tuple[str, ...]) -> tuple[Column, ...]:
    """Null-safe, join-ready session key columns (two per key)."""
    cols: list[Column] = []
    for i, k in enumerate(keys):
        c = F.col(k)
        cols.append(c.isNull().alias(f"__sk{i}_null"))
        cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(f"__sk{i}"))
    return tuple(cols)


def restore_keys(keys: Sequence[str], types: dict[str, str]) -> list[Column]:
    """Original session key columns from their null-safe form."""
    return [
        F.when(~F.col(f"__sk{i}_null"), F.col(f"__sk{i}")).cast(types.get(k, "string")).alias(k)
        for i, k in enumerate(keys)
    ]


@memo_columns
def order_key(time: Column | None = None, domain: Column | None = None, keyword: Column | None = None) -> Column:
    """Sort key of a hit within its session: time (NULL first), domain, keyword."""
    t = F.coalesce(time if time is not None else F.col(TIME), F.lit(_TIME_FLOOR).cast("long"))
    d = domain if domain is not None else F.col(DOMAIN)
    k = keyword if keyword is not None else F.col(KEYWORD)
    return F.struct(t.alias("t"), d.alias("d"), k.alias("k"))


@memo_columns
def touch_aggregates(*, coupled: bool = False, with_keys: bool = False) -> tuple[Column, ...]:
    """Aggregate columns giving a session's first touch (rows without a domain ignored).

    ``min_by`` ignores rows whose ordering is NULL, so non-search rows and,
    for the keyword, rows without a keyword simply drop out.
    """
    domain_ok = F.when(F.col(DOMAIN).isNotNull(), order_key())
    if coupled:
        first = F.min_by(F.struct(F.col(DOMAIN).alias("d"), F.col(KEYWORD).alias("k")), domain_ok)
        aggs = [first.getField("d").alias(_FIRST_DOMAIN), first.getField("k").alias(_FIRST_KEYWORD)]
        if with_keys:
            aggs += [F.min(domain_ok).alias(_DOMAIN_KEY), F.min(domain_ok).alias(_KEYWORD_KEY)]
        return tuple(aggs)
    keyword_ok = F.when(F.col(KEYWORD).isNotNull(), order_key())
    aggs = [
        F.min_by(F.col(DOMAIN), domain_ok).alias(_FIRST_DOMAIN),
        F.min_by(F.col(KEYWORD), keyword_ok).alias(_FIRST_KEYWORD),
    ]
    if with_keys:
        aggs += [F.min(domain_ok).alias(_DOMAIN_KEY), F.min(keyword_ok).alias(_KEYWORD_KEY)]
    return tuple(aggs)


def first_touch(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    coupled: bool = False,
    with_keys: bool = False,
    strict: bool = False,
) -> DataFrame:
    """One row per session that has a search hit: null-safe keys + first touch.

    Only search hits are parsed, shuffled and aggregated (the engine test
    reaches the scan).
    """
    keys = normalize_keys(keys)
    parsed = with_search_attributes(search_hits(hits.select(*keys, TIME, "referrer"), strict=strict), strict=strict)
    touch = parsed.select(*key_columns(keys), TIME, DOMAIN, KEYWORD).groupBy(*key_names(keys)).agg(
        *touch_aggregates(coupled=coupled, with_keys=with_keys)
    )
    return touch


@memo_columns
def credited(lookahead: bool, hit_key: str | None = None) -> tuple[Column, Column]:
    """(session domain, session keyword) of a hit joined to its session's first touch.

    ``hit_key``: name of a column holding the hit's ``order_key``; by default
    it is computed from the hit's own time, domain and keyword.
    """
    if lookahead:
        return F.col(_FIRST_DOMAIN), F.col(_FIRST_KEYWORD)
    hk = F.col(hit_key) if hit_key is not None else order_key()
    return (
        F.when(F.col(_DOMAIN_KEY) <= hk, F.col(_FIRST_DOMAIN)),
        F.when(F.col(_KEYWORD_KEY) <= hk, F.col(_FIRST_KEYWORD)),
    )


def hot_sessions(hits: DataFrame, keys: str | Sequence[str] = ("ip",), *, least: int = HOT_LEAST) -> tuple[list[int], int]:
    """(hashes of the hot sessions' keys, tasks to deal the largest of them over).

    One scan of the key columns feeds a sketch of the most frequent keys: a summary
    of fixed size that every task fills and Spark merges. What it finds changes
    how rows are dealt, never a result.
    """
    return _hot(hits.select(*key_columns(normalize_keys(keys))), least)


def _hot(keyed: DataFrame, least: int = HOT_LEAST) -> tuple[list[int], int]:
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(tasks, HOT_MOST)
    tracked = max(1024, 8 << most.bit_length())
    hashed = keyed.select(F.xxhash64(*keyed.columns).alias("h"))
    seen = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {most}, {tracked})").alias("top")).first()
    share = max(least, seen["n"] / tasks)
    hot = [(t["count"], t["item"]) for t in seen["top"] or [] if t["count"] > share]
    return [h for _, h in hot], max((min(tasks, math.ceil(n / share)) for n, _ in hot), default=1)


def join_touch(hits: DataFrame, touch: DataFrame, keys: Sequence[str], how: str, hot: tuple[list[int], int] | None = None) -> DataFrame:
    """Hits (with ``key_columns``) joined to their session's touch.

    ``hot``: what ``hot_sessions`` gives; by default these hits are asked. A hot
    session's hits, dealt by a hash of all their columns, meet copies of its
    touch in several tasks.
    """
    names = key_names(keys)
    hashes, salts = hot if hot is not None else _hot(hits.select(*names))
    if not hashes:
        return hits.join(touch, on=names, how=how)
    is_hot = F.xxhash64(*names).isin(hashes)
    salt = F.when(is_hot, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hits.columns]), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    return hits.withColumn(_SALT, salt).join(touch.withColumn(_SALT, copies), on=[*names, _SALT], how=how).drop(_SALT)


def attribute(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Every hit plus its own ``search_domain``/``search_keyword`` and the
    session's ``session_search_domain`` / ``session_search_keyword``.

    Join form: hits LEFT JOIN first touch on the null-safe session key. The hits
    are read twice, once for the touches, and their keys once for the sketch. The
    touch side is broadcast when its measured size is under the broadcast threshold.
    """
    keys = normalize_keys(keys)
    touch = first_touch(hits, keys, coupled=coupled, with_keys=not lookahead, strict=strict)
    parsed = with_search_attributes(hits, strict=strict)
    joined = join_touch(parsed.select("*", *key_columns(keys)), touch, keys, "left", hot_sessions(hits, keys))
    domain, keyword = credited(lookahead)
    return joined.select(*parsed.columns, domain.alias(SESSION_DOMAIN), keyword.alias(SESSION_KEYWORD))


def attribute_window(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Window form of ``attribute`` (same answers): a prefix scan in two levels.

    The hits, in the order of their sessions and times, are written in ``chunks``
    ranges of equal size (by default as many as shuffle partitions), so that a hot
    session is cut into several. A window runs over each session's part of a chunk;
    what the chunks before it know (with look-ahead: all of them) comes from a
    window over one row for each chunk of a session. Sessions in several chunks are
    those across a border, so that table has two rows a border at most.
    """
    keys = normalize_keys(keys)
    names = key_names(keys)
    parsed = with_search_attributes(hits, strict=strict)
    order = [F.col(c).asc_nulls_first() for c in (TIME, DOMAIN, KEYWORD)]
    rows = by_ranges(parsed.select("*", *key_columns(keys)), [*map(F.col, names), *order], chunks)

    touch = {
        _DOMAIN_KEY: F.when(F.col(DOMAIN).isNotNull(), order_key()),
        _KEYWORD_KEY: F.when(F.col(DOMAIN if coupled else KEYWORD).isNotNull(), order_key()),
    }
    of_chunk = rows.groupBy(RANGE, *names).agg(*[F.min(c).alias(k) for k, c in touch.items()])
    across = Window.partitionBy(*names)
    before = across.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing if lookahead else -1)
    carried = (
        of_chunk.withColumn("__chunks", F.count(F.lit(1)).over(across))
        .select(RANGE, *names, "__chunks", *[F.min(k).over(before).alias(f"{k}_carried") for k in touch])
        .filter("__chunks > 1")
        .drop("__chunks")
    )
    inside = Window.partitionBy(RANGE, *names).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing if lookahead else Window.currentRow)
    known = rows.select("*", *[F.first(c, ignorenulls=True).over(inside).alias(k) for k, c in touch.items()])
    joined = known.join(F.broadcast(carried), [RANGE, *names], "left")  # two rows a border
    first = {k: F.coalesce(f"{k}_carried", k) for k in touch}
    return joined.select(
        *[F.col(f"`{c}`") for c in parsed.columns], first[_DOMAIN_KEY]["d"].alias(SESSION_DOMAIN), first[_KEYWORD_KEY]["k"].alias(SESSION_KEYWORD)
    )


def session_pairs(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    coupled: bool = False,
    strict: bool = False,
) -> DataFrame:
    """One row per session: its keys and attributed (domain, keyword), NULL if none.

    All sessions are a hash aggregate over the key columns alone; only search hits
    are parsed and sorted by session. Both come in the same partitions, so the
    join moves nothing.
    """
    keys = normalize_keys(keys)
    types = dict(hits.select(*keys).dtypes)
    names = key_names(keys)
    sessions = hits.select(*key_columns(keys)).distinct()
    joined = sessions.join(first_touch(hits, keys, coupled=coupled, strict=strict), names, "left")
    return joined.select(
        *restore_keys(keys, types),
        F.col(_FIRST_DOMAIN).alias(SESSION_DOMAIN),
        F.col(_FIRST_KEYWORD).alias(SESSION_KEYWORD),
    )


def session_lookup(attributed: DataFrame, **key_values) -> DataFrame:
    """Hits of one session, e.g. ``session_lookup(df, ip="10.1.2.3")``."""
    cond = F.lit(True)
    for k, v in key_values.items():
        cond = cond & F.col(k).eqNullSafe(F.lit(v))
    return attributed.filter(cond)
