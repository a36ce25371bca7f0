"""Tab-separated reader, report writer and the command-line job."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from samples import SAMPLE_REPORT, SAMPLE_ROWS, hit, make_hits
from refyield import job
from refyield.operators import report as R
from refyield.sinks.hits import write_hits
from refyield.sinks.report import read_report, read_report_plain, report_path, write_report
from refyield.sources.hits import HIT_COLUMNS, check_columns, read_hits, split_corrupt

HEADER = "\t".join(HIT_COLUMNS)


def _line(row) -> str:
    out = []
    for v in row:
        s = "" if v is None else str(v)
        if '"' in s or "\t" in s:
            s = '"' + s.replace('"', '""') + '"'
        out.append(s)
    return "\t".join(out)


def _write_tsv(path, rows, header=HEADER, eol="\r\n"):
    with open(path, "w", newline="") as f:
        f.write(header + eol)
        for r in rows:
            f.write((r if isinstance(r, str) else _line(r)) + eol)
    return str(path)


def test_read_sample_with_crlf_and_quotes(spark, tmp_path):
    rows = list(SAMPLE_ROWS)
    rows[0] = rows[0][:2] + ('Mozilla/5.0 (X; "quoted")',) + rows[0][3:]
    path = _write_tsv(tmp_path / "hits.tsv", rows)
    df = read_hits(spark, path)
    got = df.collect()
    assert len(got) == len(SAMPLE_ROWS)
    first = [r for r in got if r.hit_time_gmt == 50][0]
    assert first.user_agent == 'Mozilla/5.0 (X; "quoted")'
    assert first.event_list is None and first.product_list is None  # empty field -> NULL
    assert first.referrer.endswith("&num=20")  # no stray CR
    rows = R.ranked(R.keyword_revenue(df)).collect()
    assert [(r.search_domain, r.search_keyword, r.revenue) for r in rows] == SAMPLE_REPORT


def test_short_long_and_bad_rows(spark, tmp_path):
    path = _write_tsv(
        tmp_path / "bad.tsv",
        ["12\t2009\tua\t1.2.3.4", "notanumber\t\t\t5.6.7.8\t1\t\t\t\t\t\tx;y;1;2;\thttp://google.com/?q=a",
         "\t".join(["7"] * 14)],
    )
    rows = read_hits(spark, path).collect()
    assert rows[0].ip == "1.2.3.4" and rows[0].referrer is None
    assert rows[1].hit_time_gmt is None and rows[1].ip == "5.6.7.8"
    assert rows[2].referrer == "7"
    # All three rows are malformed for Spark; a well-formed fourth is kept.
    with open(path, "a", newline="") as f:
        f.write(_line(SAMPLE_ROWS[0]) + "\r\n")
    good, bad = split_corrupt(read_hits(spark, path, keep_corrupt=True))
    assert [r.hit_time_gmt for r in good.collect()] == [50]
    assert len(bad.collect()) == 3


def test_strict_header_check(spark, tmp_path):
    path = _write_tsv(tmp_path / "wrong.tsv", SAMPLE_ROWS[:2], header=HEADER.replace("referrer", "referer"))
    assert read_hits(spark, path).count() == 2
    with pytest.raises(Exception, match="(?i)header"):
        read_hits(spark, path, strict=True).collect()


def test_check_columns(spark):
    df = spark.createDataFrame([(1, "x")], "hit_time_gmt long, ip string")
    with pytest.raises(ValueError, match="lacks event_list, product_list, referrer"):
        check_columns(df)


def test_hits_round_trip(spark, tmp_path, sample):
    out = write_hits(sample, str(tmp_path / "hits"))
    back = read_hits(spark, out)
    # In memory "" is empty; written and read back it is NULL.
    expected = sample.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) if t == "string" else F.col(c)
                               for c, t in sample.dtypes])
    assert sorted(back.collect()) == sorted(expected.collect())


def test_report_tab_and_parquet(spark, tmp_path, sample):
    report = R.ranked(R.keyword_revenue(sample))
    path = write_report(report, str(tmp_path / "out"), run_date="2024-03-05", single_file=True)
    assert path == report_path(str(tmp_path / "out"), "2024-03-05")
    assert path.endswith("2024-03-05_SearchKeywordPerformance.tab")
    parts = glob.glob(os.path.join(path, "part-*"))
    assert len(parts) == 1
    lines = open(parts[0]).read().splitlines()
    assert lines[0] == "Search Engine Domain\tSearch Keyword\tRevenue"
    assert lines[1:] == ["\t".join(map(str, r)) for r in SAMPLE_REPORT]
    assert read_report(spark, path).count() == 3
    assert sorted(read_report_plain(spark, path).collect()) == sorted(R.keyword_revenue(sample).collect())

    pq = write_report(report, str(tmp_path / "pq"), run_date="2024-03-05", fmt="parquet")
    write_report(report.limit(1), str(tmp_path / "pq"), run_date="2024-03-06", fmt="parquet")
    both = spark.read.parquet(str(tmp_path / "pq"))
    assert pq.endswith("run_date=2024-03-05")
    assert both.filter(F.col("run_date") == "2024-03-05").count() == 3
    assert both.count() == 4


def test_job_end_to_end(spark, tmp_path):
    src = _write_tsv(tmp_path / "hits.tsv", SAMPLE_ROWS)
    out = str(tmp_path / "reports")
    args = job.parse_args(["--input", src, "--output", out, "--run-date", "2024-03-05", "--single-file"])
    path = job.run(spark, args)
    lines = open(glob.glob(os.path.join(path, "part-*"))[0]).read().splitlines()
    assert lines[0].split("\t") == ["Search Engine Domain", "Search Keyword", "Revenue"]
    assert len(lines) == 4


def test_job_exit_code_on_failure(tmp_path):
    assert job.main(["--input", str(tmp_path / "missing.tsv"), "--output", str(tmp_path / "o")]) == 1


def _job(spark, tmp_path, src, *more):
    out = str(tmp_path / f"out{len(os.listdir(tmp_path))}")
    path = job.run(spark, job.parse_args(["--input", src, "--output", out, "--run-date", "2020-02-03", *more]))
    return sorted(tuple(r) for r in read_report(spark, path).collect())


def test_quarantine_is_a_copy_and_dropping_is_asked_for(spark, tmp_path):
    short = "\t".join(str(v) for v in hit(500, "10.0.0.1", "1", "a;b;1;9;", "")[:11])  # no referrer field
    src = _write_tsv(tmp_path / "hits.tsv", [*SAMPLE_ROWS, short, "\t".join(["7"] * 14)])
    bad = str(tmp_path / "bad")
    with_short = sorted([*SAMPLE_REPORT, ("duckduckgo.com", "tea pot", 9.0)])
    assert _job(spark, tmp_path, src) == with_short
    assert _job(spark, tmp_path, src, "--quarantine", bad) == with_short
    assert spark.read.options(header="true", sep="\t", escape='"').csv(bad).count() == 2
    assert _job(spark, tmp_path, src, "--drop-malformed") == sorted(SAMPLE_REPORT)


@pytest.mark.parametrize("rows", [[], SAMPLE_ROWS[-2:], [hit(1, "a", "2", "", "http://ask.com/?q=x")]], ids=["header", "no search", "no purchase"])
def test_days_without_credit_succeed(spark, tmp_path, rows):
    src = _write_tsv(tmp_path / "hits.tsv", rows)
    out = str(tmp_path / "o")
    assert job.main(["--input", src, "--output", out, "--run-date", "2020-02-03", "--single-file"]) == 0
    assert read_report(spark, report_path(out, "2020-02-03")).count() == 0


def test_launcher_arguments_and_environment(monkeypatch):
    monkeypatch.setenv("OUTPUT_DIR", "somewhere/")
    monkeypatch.setenv("LOG_LEVEL", "warning")
    args = job.parse_args(["--input", "x", "--JOB_NAME", "j", "--TempDir", "t"])
    assert (args.output, args.log_level, args.strict_host) == ("somewhere/", "WARNING", False)


KEYWORDS = [" lamp ", " ", "  two  ", "a\nb", "a\r\nb", "\r", "a\tb", 'say "x"', '"', "\\", '\\"', "#", "é", None, "plain"]


@pytest.mark.parametrize("single", [False, True])
def test_any_keyword_survives_the_report_file(spark, tmp_path, single):
    rows = [("ask.com", k, float(i)) for i, k in enumerate(KEYWORDS)]
    df = spark.createDataFrame(rows, "search_domain string, search_keyword string, revenue double")
    path = write_report(R.ranked(df), str(tmp_path / "o"), run_date="2020-02-03", single_file=single)
    back = [tuple(r) for r in read_report(spark, path).collect()]
    assert sorted(back, key=str) == sorted(rows, key=str)
    if single:
        assert [r[2] for r in back] == sorted((r[2] for r in rows), reverse=True)


def test_hits_keep_blanks_and_lose_line_breaks(spark, tmp_path):
    rows = [hit(1, " a ", " 1", "x;y\n;1; 5 ;", " http://ask.com/?q=\r\nx ", agent='q"t\ta')]
    back = read_hits(spark, write_hits(make_hits(spark, rows), str(tmp_path / "h"))).first()
    assert (back.ip, back.event_list, back.product_list) == (" a ", " 1", "x;y ;1; 5 ;")
    assert (back.referrer, back.user_agent) == (" http://ask.com/?q=x ", 'q"t\ta')


def test_dated_hits(spark, tmp_path, sample):
    from refyield.sinks.hits import write_hits_by_date
    from refyield.sources.hits import read_hits_parquet

    n = len(SAMPLE_ROWS)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")  # a day ahead of UTC
    try:
        later = sample.withColumn("hit_time_gmt", F.col("hit_time_gmt") + 86400 * 3)
        before = make_hits(spark, [hit(-1, "a", "", "", ""), hit(None, "a", "", "", "")])
        path = write_hits_by_date(sample.unionByName(later).unionByName(before), str(tmp_path / "dated"), files_per_date=2)
        assert all(len(glob.glob(f"{d}/*.parquet")) <= 2 for d in glob.glob(f"{path}/hit_date=*"))
        one_day = read_hits_parquet(spark, path, dates=["1970-01-01"])
        plan = one_day._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(hit_date" in plan or "PartitionFilters: [hit_date" in plan
        assert one_day.count() == n
        assert read_hits_parquet(spark, path, dates=["1970-01-01"], undated=True).count() == n + 1
        assert read_hits_parquet(spark, path, dates=["1969-12-31"]).count() == 1
        assert read_hits_parquet(spark, path).count() == 2 * n + 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [tuple(r) for r in R.ranked(R.keyword_revenue(one_day)).collect()] == SAMPLE_REPORT


def test_scratch_needs_a_shared_folder_off_the_local_machine():
    from types import SimpleNamespace

    from refyield.session import checkpoint_dir

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: folder))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(session(master))
        assert checkpoint_dir(session(master, "hdfs://x/y")) == "hdfs://x/y"
    assert os.path.isdir(checkpoint_dir(session("local[3]")))


def test_job_adds_days_to_a_state(spark, tmp_path):
    """The report after each day is that of all hits so far; a day counts once."""
    days = {"2024-03-04": SAMPLE_ROWS[:6], "2024-03-05": SAMPLE_ROWS[6:]}
    for day, rows in days.items():
        src = _write_tsv(tmp_path / f"{day}.tsv", rows)
        args = ["--input", src, "--output", str(tmp_path / "out"), "--run-date", day, "--state", str(tmp_path / "state"), "--replace", "--escapes"]
        path = job.run(spark, job.parse_args(args))
    again = job.run(spark, job.parse_args(args))
    assert again == path == report_path(str(tmp_path / "out"), "2024-03-05")
    rows = R.ranked(read_report_plain(spark, path, escapes=True)).collect()
    assert [tuple(r) for r in rows] == SAMPLE_REPORT
