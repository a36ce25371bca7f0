"""The revenue report day by day: sessions that go on over midnight.

A day's hits are reduced to one row for each session: its first touches of the day
and the revenue of its purchases, not yet spent on an engine. Such rows merge, in
any grouping, to the row of the days together, so the report over all days comes
from states alone and no day is read twice:

* a first touch is the least ``order_key`` (time, engine, keyword) of the days;
* with look-ahead a session's revenue adds up and is spent, when the report is
  made, on the first touches of all days;
* without look-ahead a purchase is spent on what was known before it. Its day
  tells whether that was nothing, an engine, or an engine and a keyword; where
  an earlier day knows more, the revenue moves up when the two are merged.

States are kept in runs of days, in their order, like the digits of a counter: a new
run is merged, as it is written, with those before it that are no larger. A session's
row is thus written again about log2(days) times, and a report merges as many runs.
Many days come as one run (``add_days``): one job reduces and merges them all, so that
the number of jobs does not grow with the days. The list of runs is a manifest
(``refyield.sinks.versions``): a day counts once it is published, a failed day
leaves the state as it was, and a day that is already there is not added again.

Look-ahead and money are fixed when a state is made; without look-ahead days must
come in their order, hits without a time (which come first) as the day None.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.functions import urls
from refyield.functions.commerce import has_products, is_purchase, list_revenue
from refyield.operators import sessions as S
from refyield.operators.report import REVENUE, rounded, total
from refyield.operators.search import search_hits, with_search_attributes
from refyield.sinks.versions import new_folder, newest, publish, remove

_ENGINE_KEY, _KEYWORD_KEY = "engine_key", "keyword_key"
#: What a purchase's own days know before it: nothing, an engine, a keyword too.
_KNOWN = ("open", "engine", "keyword")
_RUN = "__run"


def _plus(a: Column, b: Column) -> Column:
    """Sum of two revenues; NULL where both are."""
    return F.coalesce(a + b, a, b)


def _summed(rows: DataFrame, names: Sequence[str], known: Column, revenue: Column, money: str, *touches: Column) -> DataFrame:
    """Revenue and number of purchases of each session by what was known."""
    split = rows.withColumns({f"{n}_revenue": F.when(known == n, revenue) for n in _KNOWN})
    amounts = [x for n in _KNOWN for x in (total(f"{n}_revenue", money).alias(f"{n}_revenue"), F.count_if(known == n).alias(f"{n}_hits"))]
    return split.groupBy(*names).agg(*touches, *amounts)


def day_state(
    hits: DataFrame,
    keys: str | Sequence[str] = ("ip",),
    *,
    lookahead: bool = True,
    coupled: bool = False,
    strict: bool = False,
    strict_revenue: bool | None = None,
    money: str = "double",
) -> DataFrame:
    """One row for each session of ``hits`` that searches or buys."""
    keys = S.normalize_keys(keys)
    names = S.key_names(keys)
    buy = is_purchase("event_list") & has_products("product_list")
    revenue = list_revenue("product_list", strict=strict if strict_revenue is None else strict_revenue, money=money)
    needed = hits.select(*dict.fromkeys([*keys, S.TIME, "event_list", "product_list", "referrer"]))
    searched = {
        _ENGINE_KEY: F.when(F.col(S.DOMAIN).isNotNull(), S.order_key()),
        _KEYWORD_KEY: F.when(F.col(S.DOMAIN if coupled else S.KEYWORD).isNotNull(), S.order_key()),
    }
    touches = [F.min(c).alias(c) for c in searched]
    if lookahead:
        parsed = with_search_attributes(needed.filter(buy | urls.is_search("referrer", strict=strict)), strict=strict)
        rows = parsed.select(*S.key_columns(keys), *[c.alias(n) for n, c in searched.items()], buy.alias("__buy"), F.when(buy, revenue).alias("__rev"))
        return _summed(rows, names, F.when(F.col("__buy"), F.lit("open")), F.col("__rev"), money, *touches)
    # apart, so that a search is told once for a hit and a purchase needs no such test
    searches = with_search_attributes(search_hits(needed, strict=strict), strict=strict)
    touch = searches.select(*S.key_columns(keys), *[c.alias(n) for n, c in searched.items()]).groupBy(*names).agg(*touches)
    purchases = with_search_attributes(needed.filter(buy), strict=strict)
    bought = purchases.select(*S.key_columns(keys), S.order_key().alias("__at"), revenue.alias("__rev"))
    credit = S.join_touch(bought, touch, keys, "left")
    known = (
        F.when(F.col(_KEYWORD_KEY) <= F.col("__at"), F.lit("keyword"))
        .when(F.col(_ENGINE_KEY) <= F.col("__at"), F.lit("engine"))
        .otherwise(F.lit("open"))
    )
    spent = _summed(credit, names, known, F.col("__rev"), money)
    return touch.join(spent, names, "full_outer").select(
        *names, _ENGINE_KEY, _KEYWORD_KEY, *[x for n in _KNOWN for x in (F.col(f"{n}_revenue"), F.coalesce(f"{n}_hits", F.lit(0)).alias(f"{n}_hits"))]
    )


def merge_states(states: Sequence[DataFrame], keys: str | Sequence[str] = ("ip",), *, lookahead: bool = True) -> DataFrame:
    """The state of all days of ``states``, which come in the order of their days."""
    if len(states) == 1:
        return states[0]
    runs = reduce(DataFrame.unionByName, [s.withColumn(_RUN, F.lit(i)) for i, s in enumerate(states)])
    return _merged(runs, S.key_names(S.normalize_keys(keys)), lookahead)


def days_state(hits: DataFrame, keys: str | Sequence[str] = ("ip",), column: str = "hit_date", **rules) -> DataFrame:
    """The state of several days of ``hits``, told apart by a date column (NULL: first).

    The day is one more session key, so that all days are reduced in one job, each to
    its own row for a session; these are then merged in the order of the days.
    """
    keys = S.normalize_keys(keys)
    *names, undated, day = S.key_names([*keys, column])
    runs = day_state(hits, (*keys, column), **rules).withColumnRenamed(day, _RUN).drop(undated)  # no date: ''
    return _merged(runs, names, rules.get("lookahead", True))


def _merged(runs: DataFrame, names: Sequence[str], lookahead: bool) -> DataFrame:
    """One row for each session of states that come in the order of ``_RUN``."""
    kinds = dict(runs.dtypes)
    money = "double" if kinds["open_revenue"] == "double" else "decimal"
    keys = (_ENGINE_KEY, _KEYWORD_KEY)
    amounts = [f"{n}_{what}" for n in _KNOWN for what in ("revenue", "hits")]
    if not lookahead:
        # a session has a row for each run: their number is bounded by the runs, not the hits
        session = Window.partitionBy(*names)
        first = {f"__first_{c}": F.min(F.when(F.col(c).isNotNull(), F.col(_RUN))).over(session) for c in keys}
        engine, keyword = (F.col(_RUN) > F.col(f"__first_{c}") for c in keys)
        earlier = F.when(keyword, F.lit(2)).when(engine, F.lit(1)).otherwise(F.lit(0))

        def spent(what: str, wanted: int) -> Column:
            """What the row's purchases known as ``wanted`` amount to, all runs taken."""
            return reduce(_plus, [F.when(F.greatest(F.lit(own), "__earlier") == wanted, F.col(f"{n}_{what}")) for own, n in enumerate(_KNOWN[: wanted + 1])])

        known = runs.withColumns(first).withColumn("__earlier", earlier)
        runs = known.withColumns({f"{n}_{what}": spent(what, i) for i, n in enumerate(_KNOWN) for what in ("revenue", "hits")})
    sums = [(total(a, money) if a.endswith("revenue") else F.coalesce(F.sum(a), F.lit(0))).alias(a) for a in amounts]
    return runs.groupBy(*names).agg(*[F.min(c).alias(c) for c in keys], *sums)


def state_report(state: DataFrame, *, lookahead: bool = True, money: str = "double") -> DataFrame:
    """``search_domain, search_keyword, revenue`` of all days of a state."""
    engine, keyword = F.col(_ENGINE_KEY)["d"], F.col(_KEYWORD_KEY)["k"]
    searched = state.filter(F.col(_ENGINE_KEY).isNotNull())
    credits = [(keyword, "open")] if lookahead else [(keyword, "keyword"), (F.lit(None).cast("string"), "engine")]
    rows = searched.select(F.explode(F.array(*[F.struct(engine.alias("d"), k.alias("k"), F.col(f"{n}_revenue").alias("r"), F.col(f"{n}_hits").alias("h")) for k, n in credits])).alias("x"))
    bought = rows.filter("x.h > 0").select(F.col("x.d").alias(S.DOMAIN), F.col("x.k").alias(S.KEYWORD), F.col("x.r").alias("__rev"))
    return bought.groupBy(S.DOMAIN, S.KEYWORD).agg(rounded(total("__rev", money), money).alias(REVENUE))


def _level(days: Sequence[str | None]) -> int:
    """The place of a run of so many days: log2, rounded down."""
    return len(days).bit_length() - 1


class SessionDays:
    """A state table below ``path`` to which days are added."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | Sequence[str] = ("ip",),
        *,
        lookahead: bool = True,
        coupled: bool = False,
        strict: bool = False,
        strict_revenue: bool | None = None,
        money: str = "double",
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = S.normalize_keys(keys)
        self.rules = {"lookahead": lookahead, "coupled": coupled, "strict": strict, "strict_revenue": strict_revenue, "money": money}

    def _newest(self) -> tuple[int, dict]:
        version, content = newest(self.spark, self.path)
        made = {"keys": list(self.keys), "rules": self.rules}
        if content is None:
            return version, made | {"runs": [], "superseded": []}
        if {k: content[k] for k in made} != made:
            raise ValueError(f"the state at {self.path} was made with {content['keys']}, {content['rules']}")
        return version, content

    def days(self) -> list[str | None]:
        """The days that count, in the order they were added."""
        return [d for run in self._newest()[1]["runs"] for d in run["days"]]

    def _read(self, run: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{run['folder']}")

    def _write(self, state: DataFrame, days: list[str | None], level: int) -> dict:
        folder = new_folder(self.path, "run")
        state.write.parquet(folder)
        return {"folder": folder.rsplit("/", 1)[1], "days": days, "level": level}

    def _append(self, version: int, content: dict, days: list[str | None], state: DataFrame) -> None:
        """Publish a run of days, merged with the runs before it that are no larger."""
        runs, merged = list(content["runs"]), []
        while runs and runs[-1]["level"] <= _level(days):
            merged.insert(0, runs.pop())
            days = merged[0]["days"] + days
        whole = merge_states([*map(self._read, merged), state], self.keys, lookahead=self.rules["lookahead"])
        runs.append(self._write(whole, days, _level(days)))
        publish(self.spark, self.path, content | {"runs": runs, "superseded": [r["folder"] for r in merged]}, after=version)
        for folder in content["superseded"]:  # those of the version before, which readers may still hold, stay
            remove(self.spark, f"{self.path}/{folder}")

    def _new(self, content: dict, days: Sequence[str | None]) -> list[str | None]:
        """Those of ``days`` that are not there, in their order."""
        known = [d for run in content["runs"] for d in run["days"]]
        new = sorted(set(days) - set(known), key=lambda d: d or "")
        if new and not self.rules["lookahead"] and any((d or "") > (new[0] or "") for d in known):
            raise ValueError(f"without look-ahead days come in order: {new[0]} after {known[-1]}")
        return new

    def add(self, day: str | None, hits: DataFrame) -> bool:
        """Add a day's hits; False if the day is already there.

        Without look-ahead days come in order, None (hits without a time) first.
        """
        version, content = self._newest()
        new = self._new(content, [day])
        if new:
            self._append(version, content, new, day_state(hits, self.keys, **self.rules))
        return bool(new)

    def add_days(self, hits: DataFrame, column: str = "hit_date", *, parts: int = 1) -> list[str | None]:
        """Add each day of ``hits``, told apart by a date column; the days added, in their order.

        As ``add`` for one day after another, but the number of jobs depends on
        ``parts``, not on the days: a part is a run of days that one job reduces and
        publishes. A load that failed goes on after the parts that it has published.
        """
        text = F.col(column).cast("string")
        new = self._new(self._newest()[1], [d for (d,) in hits.select(text).distinct().collect()])  # a row a day
        size = max(1, math.ceil(len(new) / parts))
        for part in (new[i : i + size] for i in range(0, len(new), size)):
            chosen = text.isin([d for d in part if d is not None])
            some = hits.filter(chosen | text.isNull() if None in part else chosen)
            self._append(*self._newest(), part, days_state(some, self.keys, column, **self.rules))
        return new

    def state(self) -> DataFrame:
        """One row for each session of all days."""
        runs = self._newest()[1]["runs"]
        if not runs:
            raise ValueError(f"no day has been added to {self.path}")
        return merge_states([self._read(r) for r in runs], self.keys, lookahead=self.rules["lookahead"])

    def report(self) -> DataFrame:
        """The report over all days added."""
        return state_report(self.state(), lookahead=self.rules["lookahead"], money=self.rules["money"])
