"""Files: escapes, sessions' ranges, days, replaced reports; ranks; repeatable sums."""

from __future__ import annotations

import glob
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from refyield.functions.escapes import escape, unescape
from refyield.functions.sums import repeatable_sum
from refyield.operators import report as R
from refyield.operators.ranking import with_rank
from refyield.sinks.hits import write_hits, write_hits_by_date, write_hits_by_session
from refyield.sinks.report import read_report, read_report_plain, write_report
from refyield.sinks.versions import current_folder
from refyield.sources.hits import read_hits, read_hits_by_session, session_hits
from samples import SAMPLE_ROWS, hit, make_hits

PIECES = ["\\", "\n", "\r", "n", "r", "e", "N", '"', "\t", " ", "a", "é", "\\n", "\\\\", "#", ",", "\x0b", " ", "﻿"]


def odd_texts(seed: int, n: int) -> list[str | None]:
    rng = random.Random(seed)
    return [None, "", " ", "\\N", "\\e", "\\", "\n"] + ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 9))) for _ in range(n)]


def test_escapes_are_reversible_and_on_one_line(spark):
    texts = odd_texts(1, 3000)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", "t", escape("t").alias("line"))
    rows = df.select("*", unescape("line").alias("back")).collect()
    assert all(r.back == r.t for r in rows)
    assert not any(set(r.line) & set("\r\n") or not r.line for r in rows)
    assert len({r.line for r in rows}) == len({r.t for r in rows})


def test_any_hit_round_trips_in_split_files(spark, tmp_path):
    texts = odd_texts(2, 400)
    rng = random.Random(3)
    pick = lambda: rng.choice(texts)
    rows = [(rng.choice([None, i]), *[pick() for _ in range(11)]) for i in range(900)] + [(None,) * 12] * 2
    path = write_hits(make_hits(spark, rows).coalesce(1), str(tmp_path / "hits"), escapes=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        back = read_hits(spark, path, escapes=True)
        assert back.rdd.getNumPartitions() > 4  # one file, many tasks
        assert sorted(map(str, back.collect())) == sorted(map(str, make_hits(spark, rows).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_any_keyword_round_trips_in_a_split_report(spark, tmp_path):
    texts = sorted(set(odd_texts(4, 500)), key=str)
    report = spark.createDataFrame([("bing.com" if i % 7 else None, t, i / 4) for i, t in enumerate(texts)], "search_domain string, search_keyword string, revenue double")
    path = write_report(report.coalesce(1), str(tmp_path), escapes=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        back = read_report_plain(spark, path, escapes=True)
        assert back.rdd.getNumPartitions() > 4
        assert back.exceptAll(report).isEmpty() and report.exceptAll(back).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_failed_run_leaves_the_report(spark, tmp_path, sample):
    report = R.keyword_revenue(sample)
    write = lambda df: write_report(df, str(tmp_path), run_date="2024-03-05", mode="replace")
    path = write(report)
    before = sorted(map(str, read_report(spark, path).collect()))
    assert len(before) == 3
    broken = report.withColumn("revenue", F.when(F.col("search_keyword") == "Lamp", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("revenue")))
    with pytest.raises(Exception, match="lost"):
        write(broken.repartition(3))
    assert sorted(map(str, read_report(spark, path).collect())) == before
    write(R.ranked(report, 1))
    assert read_report(spark, path).count() == 1


# -- hits by session ------------------------------------------------------------


@pytest.fixture(scope="module")
def by_session(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = [hit(rng.choice([None, rng.randrange(900)]), rng.choice([None, "", "hot", "hot", *[f"10.0.{i}.1" for i in range(60)]]), "2", "", "", agent=rng.choice(["A", None])) for _ in range(1500)]
    rows += [hit(i, "hot", "2", "", "") for i in range(700)]
    path = write_hits_by_session(make_hits(spark, rows).repartition(5), str(tmp_path_factory.mktemp("table")), rows_per_file=100)
    return path, rows


@pytest.mark.parametrize("ip", [None, "", "hot", "10.0.0.1", "10.0.59.1", "10.0.7.1", "absent", "0", "zzz"])
def test_session_lookup_finds_the_session(spark, by_session, ip):
    path, rows = by_session
    got = sorted(map(str, (tuple(r) for r in session_hits(spark, path, ip=ip).collect())))
    assert got == sorted(str(r) for r in rows if r[3] == ip)


def test_session_lookup_reads_matching_files_alone(spark, tmp_path, by_session):
    """Every file that the session is not in is overwritten with rubbish."""
    _, rows = by_session
    path = write_hits_by_session(make_hits(spark, rows), str(tmp_path / "table"), rows_per_file=100)
    folder = current_folder(spark, path)
    held = {ip: {r[0] for r in spark.read.parquet(f"{folder}/hits").filter(F.col("ip") == ip).select("range").distinct().collect()} for ip in ("10.0.20.1", "hot")}
    assert len(held["10.0.20.1"]) <= 2 and len(held["hot"]) > 5  # a hot session takes several files
    plan = session_hits(spark, path, ip="10.0.20.1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    files = glob.glob(f"{folder}/hits/range=*/*.parquet")
    assert len(files) == math.ceil(len(rows) / 100)
    for f in files:
        if int(f.split("range=")[1].split("/")[0]) not in held["10.0.20.1"]:
            size = os.path.getsize(f)
            with open(f, "r+b") as out:
                out.write(b"x" * size)
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    assert session_hits(spark, path, ip="10.0.20.1").count() == sum(r[3] == "10.0.20.1" for r in rows)
    with pytest.raises(Exception):
        session_hits(spark, path, ip="hot").collect()


def test_hits_by_session_round_trip_and_keys(spark, by_session, tmp_path):
    path, rows = by_session
    assert sorted(str(tuple(r)) for r in read_hits_by_session(spark, path).collect()) == sorted(map(str, rows))
    with pytest.raises(ValueError, match="1 session keys"):
        session_hits(spark, path, ip="a", user_agent="b")
    with pytest.raises(ValueError, match="no hits by session"):
        read_hits_by_session(spark, str(tmp_path / "nothing"))
    two = write_hits_by_session(make_hits(spark, rows), str(tmp_path / "two"), ("ip", "user_agent"), rows_per_file=200)
    for ip, agent in (("hot", None), (None, "A"), ("10.0.3.1", "A")):
        got = session_hits(spark, two, ip=ip, user_agent=agent)
        assert got.count() == sum(r[3] == ip and r[2] == agent for r in rows)
    empty = write_hits_by_session(make_hits(spark, []), str(tmp_path / "none"))
    assert read_hits_by_session(spark, empty).count() == 0 and session_hits(spark, empty, ip="a").count() == 0


def test_a_day_gets_files_by_its_size(spark, tmp_path):
    rows = [hit(i, f"10.0.0.{i % 9}", "2", "", "") for i in range(1200)] + [hit(86400 + i, "a", "2", "", "") for i in range(50)] + [hit(None, "b", "2", "", f"r{i}") for i in range(300)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are merged else
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        path = write_hits_by_date(make_hits(spark, rows).repartition(6), str(tmp_path / "days"), rows_per_file=100)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    files = {d: len(glob.glob(f"{path}/hit_date={d}/*.parquet")) for d in ("1970-01-01", "1970-01-02", "__HIVE_DEFAULT_PARTITION__")}
    assert files["1970-01-02"] == 1 and 1 < files["__HIVE_DEFAULT_PARTITION__"] <= 3 and files["1970-01-01"] <= 12
    assert spark.read.parquet(path).count() == len(rows)
    dealt = spark.read.parquet(path).filter("hit_date = '1970-01-01'").groupBy(F.input_file_name()).count()
    assert dealt.agg(F.max("count")).first()[0] < 400


# -- ranks and sums ---------------------------------------------------------------


def test_ranks_without_a_window_over_all_rows(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1.0, 1.0, 1.0, rng.random(), None]), f"k{i % 50}") for i in range(3000)]
    df = spark.createDataFrame(rows, "revenue double, search_keyword string").repartition(5)
    order = [F.col("revenue").desc_nulls_last(), F.col("search_keyword").asc()]
    ranked = with_rank(df, order, ranges=12)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    single = plan.count("Exchange SinglePartition")
    assert single == 1 and "count(1)" in plan.split("Exchange SinglePartition")[1]  # the ranges' counts alone
    got = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 3001))
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.revenue, r.search_keyword) for r in got] == want
    assert with_rank(df.limit(0), order).count() == 0


def test_report_ranks(sample):
    rows = R.with_ranks(R.keyword_revenue(sample)).orderBy("rank").collect()
    assert [(r["rank"], r.search_keyword) for r in rows] == [(1, "Lamp"), (2, "garden hose"), (3, "lamp")]


def _bits(x: float) -> str:
    return x.hex()


def test_sums_are_bit_equal_in_any_order(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-4, 16) for _ in range(2000)] + [0.1, 0.2, 0.3, None, -0.0, 2.0**60, -(2.0**60) + 0.5]
    seen, plain = set(), set()
    for seed in range(4):
        mixed = random.Random(seed).sample(values, len(values))
        df = spark.createDataFrame([(v,) for v in mixed], "x double").repartition(1 + 3 * seed)
        row = df.agg(repeatable_sum("x").alias("s"), F.sum("x").alias("p")).first()
        seen.add(_bits(row.s))
        plain.add(_bits(row.p))
    assert len(seen) == 1 and len(plain) > 1
    exact = math.fsum(v for v in values if v is not None)
    assert abs(float.fromhex(seen.pop()) - exact) <= 4 * math.ulp(exact)


@pytest.mark.parametrize(
    "values,want",
    [
        ([None, None], None),
        ([], None),
        ([0.1] * 10, 1.0),
        ([math.inf, 1.0], math.inf),
        ([math.inf, -math.inf, 1.0], math.nan),
        ([math.nan, None, 2.0], math.nan),
        ([1e300, 1.0], 1e300),
        ([2.0**85, 1.0, -(2.0**85)], 1.0),
        ([5e-324, 3.0], 3.0),
        ([None, 0.0], 0.0),
    ],
)
def test_sums_of_odd_values(spark, values, want):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(repeatable_sum("x").alias("s")).first().s
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_the_report_is_bit_equal_over_shuffled_hits(spark):
    rng = random.Random(8)
    rows = [hit(0, f"10.0.0.{i}", "", "", "http://bing.com/?q=x") for i in range(5)]
    rows += [hit(i, f"10.0.0.{rng.randrange(5)}", "1", f"a;b;1;{rng.uniform(0, 10.0 ** rng.randrange(9))!r};", "") for i in range(1, 400)]
    sums = set()
    for seed in range(3):
        hits = make_hits(spark, random.Random(seed).sample(rows, len(rows))).repartition(2 + seed)
        sums.add(_bits(R.session_revenue(hits).agg(repeatable_sum("__rev").alias("s")).first().s))
    assert len(sums) == 1
