import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first().out


def test_amount_buckets_at_their_limits(spark):
    cases = [
        ("24.99", "MICRO"),
        ("25", "SMALL"),
        ("199.99", "SMALL"),
        ("200", "MEDIUM"),
        ("999.99", "MEDIUM"),
        ("1000", "LARGE"),
        ("-1", "MICRO"),
        (None, "LARGE"),
    ]
    df = spark.createDataFrame([(a and Decimal(a), b) for a, b in cases], "amount decimal(12,2), expected string")
    got = df.select(C.amount_bucket(F.col("amount")).alias("bucket"), "expected").collect()
    assert [r.bucket for r in got] == [r.expected for r in got]


def test_late_night_and_weekend(spark):
    stamps = ["2024-01-06 00:10:00", "2024-01-07 05:59:59", "2024-01-08 06:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    got = df.select(*[c.alias(n) for n, c in C.time_features(F.col("ts")).items()]).collect()
    assert [r.day_of_week for r in got] == [6, 0, 1]
    assert [r.is_weekend for r in got] == [True, True, False]
    assert [r.is_late_night for r in got] == [True, True, False]


def test_outcome_flags_keep_null(spark):
    df = spark.createDataFrame([("FAILED",), ("SETTLED",), ("PENDING",), (None,)], "s string")
    got = df.select(*[c.alias(n) for n, c in C.outcome_flags(F.col("s")).items()]).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False), (None, None)]


def test_ratio_rounds_in_whole_numbers(spark):
    percent = lambda d, n: one(spark, C.ratio_percent(F.col("d"), F.col("n")), d=d, n=n)
    assert percent(1234499, 10000000) == 12.35  # six decimals first: 0.123450
    assert percent(1, 3) == 33.33
    assert percent(0, 5) == 0.0
    assert percent(0, 0) is None


def test_strict_cast_refuses_what_it_cannot_read(spark):
    money = lambda t: one(spark, C.cast_strict(F.col("t"), "decimal(12,2)", "amount"), t=t)
    assert money("1.235") == Decimal("1.24")
    for text in ("1,5", "abc", ""):
        with pytest.raises(Exception, match="cannot read amount"):
            money(text)


def test_lenient_cast_gives_null(spark):
    assert one(spark, C.cast_lenient(F.col("t"), "decimal(12,2)"), t="1,5") is None
    assert one(spark, C.cast_lenient(F.col("t"), "date"), t="2024-13-01") is None
    assert one(spark, C.cast_lenient(F.col("t"), "date"), t="2024-01-31") == dt.date(2024, 1, 31)


def test_days_between_counts_midnights(spark):
    late = F.lit("2024-01-02 00:01:00").cast("timestamp_ntz")
    early = F.lit("2024-01-01 23:59:00").cast("timestamp_ntz")
    assert one(spark, C.days_between(late, early)) == 1


def test_mean_and_count_over_nothing(spark):
    empty = spark.createDataFrame([], "a decimal(12,2), b boolean")
    got = empty.agg(C.mean_amount(F.col("a")).alias("m"), C.count_where(F.col("b")).alias("n")).first()
    assert got.m is None and got.n == 0


def test_html_text(spark):
    html = '<p>A &amp; <b>B</b></p><script>x("</p>")</script><!-- no --><style>p{}</style>\n C'
    assert one(spark, C.html_text(F.col("h")), h=html) == "A & B C"
