"""Purchase predicate and product revenue parsing."""

from __future__ import annotations

import math
import random
import re

from pyspark.sql import functions as F

from refyield.functions.commerce import is_purchase, product_revenue, product_revenue_decimal
from refyield.operators.revenue import product_lines


def test_purchase_event_lists(spark):
    passing = ["1", "2, 1", "1,12", "2, 1 ,12"]
    failing = ["10", "11,10", "12", "2", "", None]
    df = spark.createDataFrame([(v,) for v in passing + failing], "event_list string")
    got = [r[0] for r in df.select(is_purchase("event_list")).collect()]
    assert got[: len(passing)] == [True] * len(passing)
    assert [bool(x) for x in got[len(passing):]] == [False] * len(failing)


def test_purchase_event_lists_by_pattern(spark):
    rnd = random.Random(3)
    values = ["".join(rnd.choice("11,,, \t\n\x0b2x") for _ in range(rnd.randrange(8))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "event_list string")
    got = [r[0] for r in df.select(is_purchase("event_list")).collect()]
    assert got == [bool(re.search(r"(^|,)[ \t\n\x0b\f\r]*1[ \t\n\x0b\f\r]*(,|\Z)", v)) for v in values]


def _lines(spark, product_list, strict=False):
    df = spark.createDataFrame([(product_list,)], "product_list string")
    rows = product_lines(df, strict=strict).orderBy("product_index").collect()
    return [r["product_revenue"] for r in rows]


def test_product_lists(spark):
    assert _lines(spark, "x;y;1;5;,x;y;1;;") == [5.0, None]
    assert _lines(spark, "a;b;1") == [0.0]
    assert _lines(spark, "Cat;A, B;1;7;") == [0.0, None]
    assert _lines(spark, "x;y;2; 3.50 ;e1=2|e2=3;v1=a") == [3.5]


def test_java_number_rules_and_strict_mode(spark):
    df = spark.createDataFrame([(e,) for e in ["a;b;1;$5", "a;b;1;1e3", "a;b;1;290d", "a;b;1;NaN"]], "e string")
    loose = [r[0] for r in df.select(product_revenue("e")).collect()]
    strict = [r[0] for r in df.select(product_revenue("e", strict=True)).collect()]
    assert loose[0] is None and loose[1] == 1000.0 and loose[2] == 290.0 and math.isnan(loose[3])
    assert strict == [None, 1000.0, None, None]


def test_decimal_money(spark):
    df = spark.createDataFrame([("a;b;1;0.10",), ("a;b;1;0.20",), ("a;b",), ("a;b;1;x",)], "e string")
    rows = df.select(product_revenue_decimal("e").alias("v")).collect()
    assert [None if r.v is None else str(r.v) for r in rows] == ["0.10", "0.20", "0.00", None]
    total = df.select(product_revenue_decimal("e").alias("v")).agg(F.sum("v")).first()[0]
    assert str(total) == "0.30"
