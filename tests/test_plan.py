"""Physical plan shape of the flagship report (what must hold at scale)."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from refyield.operators import report as R
from refyield.operators import revenue as V
from refyield.operators import sessions as S


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_is_one_scan_two_shuffles_no_python(spark, tmp_path, sample):
    path = str(tmp_path / "hits.parquet")
    sample.write.parquet(path)
    df = R.keyword_revenue(spark.read.parquet(path))
    plan = _plan(df)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
    # Exchange 1: session key (after map-side partial aggregation).
    # Exchange 2: (engine, keyword) (after map-side partial aggregation).
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert "partial_min_by" in plan and "partial_sum" in plan
    # Only the five needed columns are read.
    read = re.search(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()) or \
        re.search(r"ReadSchema: struct<([^>]*)>", plan)
    if read:
        cols = {c.split(":")[0] for c in read.group(1).split(",")}
        assert cols == {"hit_time_gmt", "ip", "event_list", "product_list", "referrer"}


def test_referrer_parsed_once_per_row(spark, sample):
    df = R.keyword_revenue(sample)
    optimized = _optimized(df)
    # One regexp for the netloc in the pushed filter, one in the projection
    # over surviving rows: never the nested CASE blow-up.
    # (the sums of doubles have a CASE for each part, in the aggregates)
    assert "\n".join(x for x in optimized.split("\n") if not x.lstrip(" +-").startswith("Aggregate")).count("CASE WHEN") < 20
    # The product list is parsed once, not once for each part of its sum.
    assert optimized.count("try_cast") <= 1
    assert optimized.count("//([^/?#") <= 3


def test_session_pairs_sort_only_search_hits(spark, tmp_path, sample):
    path = str(tmp_path / "hits.parquet")
    sample.write.parquet(path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(S.session_pairs(spark.read.parquet(path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # all hits: their keys alone, hash aggregates; search hits: their columns, sorted
    assert sorted(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == ["hit_time_gmt:bigint,ip:string,referrer:string", "ip:string"]
    sessions, touches = plan.split("SortMergeJoin")[1].split("ReadSchema: struct<ip:string>")[0], plan.split("ReadSchema: struct<ip:string>")[1]
    assert "SortAggregate" not in sessions and sessions.count("HashAggregate") == 2
    assert "SortAggregate" in touches and "regexp_extract" in touches
    # one exchange for each side, none for the join
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_credited_purchase_count_scans_once(spark, tmp_path, sample):
    path = str(tmp_path / "hits.parquet")
    sample.write.parquet(path)
    plan = _plan(R.attributed_purchase_count(spark.read.parquet(path)))
    assert plan.count("Scan parquet") == 1 and "Generate" not in plan


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """60,000 hits, two thirds of them of one session."""
    path = str(tmp_path_factory.mktemp("skew") / "hits.parquet")
    i = F.col("id")
    rows = spark.range(60_000).select(
        i.alias("hit_time_gmt"),
        F.when(i % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), (i % 500).cast("string"))).alias("ip"),
        F.when(i % 2 == 0, "1").otherwise("2").alias("event_list"),
        F.lit("a;b;1;1;").alias("product_list"),
        F.when(i % 50 == 0, "http://google.com/?q=x").otherwise("http://shop.example/").alias("referrer"),
    )
    rows.write.parquet(path)
    return path


@pytest.mark.parametrize(
    "form",
    [
        lambda hits: S.attribute(hits),
        lambda hits: V.attributed_purchases(hits),
        lambda hits: R.session_revenue(hits, lookahead=False),
    ],
    ids=["attribute", "attributed_purchases", "no_lookahead"],
)
def test_a_hot_session_is_dealt_over_tasks(spark, skewed, form):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = form(spark.read.parquet(skewed))
        assert "SortMergeJoin" in _plan(df) or "ShuffledHashJoin" in _plan(df)
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.2 * sum(sizes)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_sessions_are_found_and_no_others(spark, skewed):
    hits = spark.read.parquet(skewed)
    hashes, tasks = S.hot_sessions(hits, "ip")
    hot = hits.select(*S.key_columns(("ip",)), "ip").distinct().filter(F.xxhash64(*S.key_names(("ip",))).isin(hashes)).collect()
    assert [r.ip for r in hot] == ["hot"] and 2 <= tasks <= 4
    assert S.hot_sessions(hits, "ip", least=50_000) == ([], 1)
    assert S.hot_sessions(hits.limit(0), "ip") == ([], 1)
    assert S.hot_sessions(hits.limit(0), ("ip", "event_list")) == ([], 1)


def test_only_hot_touches_are_repeated(spark, skewed):
    """The touches that are shuffled: one a session, and a few of the hot one."""
    hits = spark.read.parquet(skewed).withColumn("referrer", F.lit("http://bing.com/?q=x"))
    hot = S.hot_sessions(hits, "ip")
    touch = S.first_touch(hits, "ip")
    joined = S.join_touch(hits.select("*", *S.key_columns(("ip",))), touch, ("ip",), "left", hot)
    assert "explode" in _optimized(joined) and joined.count() == 60_000
    sessions = touch.count()
    is_hot = F.xxhash64(*S.key_names(("ip",))).isin(hot[0])
    copies = touch.select(F.when(is_hot, hot[1]).otherwise(1).alias("n")).agg(F.sum("n")).first()[0]
    assert sessions > 50 and copies <= 1.1 * sessions
    # without a hot session nothing is salted, and the touches stay where they are
    plain = S.join_touch(hits.select("*", *S.key_columns(("ip",))), touch, ("ip",), "left", ([], 1))
    assert "explode" not in _optimized(plain)


@pytest.mark.parametrize("lookahead", [True, False])
@pytest.mark.parametrize("coupled", [True, False])
def test_window_form_cuts_a_hot_session(spark, skewed, lookahead, coupled):
    hits = spark.read.parquet(skewed)
    columns = ["ip", "hit_time_gmt", S.SESSION_DOMAIN, S.SESSION_KEYWORD]
    window = S.attribute_window(hits, lookahead=lookahead, coupled=coupled, chunks=16).select(*columns)
    plain = S.attribute(hits, lookahead=lookahead, coupled=coupled).select(*columns)
    assert window.exceptAll(plain).isEmpty() and plain.exceptAll(window).isEmpty()
    sizes = S.by_ranges(hits, [F.col("ip"), F.col("hit_time_gmt")], 16).groupBy(S.RANGE, "ip").count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 60_000 / 16


def test_a_hot_session_is_split_by_adaptive_execution(spark, skewed):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "32",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = S.attribute(spark.read.parquet(skewed))
        rows = df.collect()
        assert "skew=true" in _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 60_000
    searching = {r.ip for r in rows if r.search_domain}
    assert all((r.session_search_domain == "google.com") == (r.ip in searching) for r in rows)
