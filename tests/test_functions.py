"""Edge rows of the column expressions."""

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tripmart.functions import (
    WHITESPACE,
    blank_to_null,
    day_name,
    distance_km,
    elapsed_seconds,
    fold,
    is_weekend,
    mean_2dp,
    not_blank,
    ratio_2dp,
    round_2dp,
    safe_date,
    safe_double,
    safe_long,
    safe_timestamp,
    time_of_day,
    trim_ws,
)


def evaluate(spark, values, expression, ddl="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    out = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def test_trim_strips_all_white_space(spark):
    padded = [f"{w}a b{w}" for w in WHITESPACE] + [WHITESPACE, "", None, " \t x\n"]
    assert evaluate(spark, padded, trim_ws) == ["a b"] * len(WHITESPACE) + ["", "", None, "x"]
    assert evaluate(spark, [" ", "\t\n", " a ", None], blank_to_null) == [None, None, "a", None]
    texts = [w + "x" + w for w in WHITESPACE] + [WHITESPACE, "", None, " \n"]
    assert evaluate(spark, texts, not_blank) == [True] * len(WHITESPACE) + [False, False, None, False]
    assert evaluate(spark, [" MeMBer\t", None], fold) == ["member", None]


def test_safe_timestamp(spark):
    t = dt.datetime
    cases = {
        "": None,
        "2026": None,
        "2026-01": None,
        "10:00": None,
        "bad": None,
        "2024-13-01": None,
        "2024-02-30 00:00:00": None,
        "2024-01-01": t(2024, 1, 1),
        " 2024-1-2 3:4:5 ": t(2024, 1, 2, 3, 4, 5),
        "2024-01-01 10:00:00.25": t(2024, 1, 1, 10, 0, 0, 250000),
        "2024-01-01T10:00:00": t(2024, 1, 1, 10),
        "2024-01-01 10:00:00+02:00": t(2024, 1, 1, 8),
        "2024-01-01T10:00:00Z": t(2024, 1, 1, 10),
        None: None,
    }
    assert evaluate(spark, list(cases), safe_timestamp) == list(cases.values())


def test_safe_timestamp_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = evaluate(spark, ["2024-03-10 02:30:00", "2024-01-01 10:00:00+02:00"], safe_timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 1, 1, 8)]


def test_safe_numbers_and_dates(spark):
    values = ["", "1.5d", "0x1p3", " 1 ", "-.5", "1e3", "5.", "x"]
    assert evaluate(spark, values, safe_double) == [None, None, None, 1.0, -0.5, 1000.0, 5.0, None]
    assert math.isnan(evaluate(spark, ["nan"], safe_double)[0])
    assert evaluate(spark, ["12", " -3 ", "1.5", "", "9" * 30], safe_long) == [12, -3, None, None, None]
    dates = ["2024-01-01", " 2024-1-1", "2024", "2024-01-01 10:00", "2024-02-30"]
    day = dt.date(2024, 1, 1)
    assert evaluate(spark, dates, safe_date) == [day, day, None, None, None]


def test_elapsed_seconds_cuts_fractions(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:00:02.1' b"
    ).select(elapsed_seconds(F.col("a"), F.col("b")), elapsed_seconds(F.col("b"), F.col("a")))
    assert tuple(df.first()) == (1, -1)


def test_calendar(spark):
    days = [dt.datetime(2024, 1, d) for d in range(5, 9)] + [None]  # Friday to Monday
    assert evaluate(spark, days, day_name, "timestamp_ntz") == ["Friday", "Saturday", "Sunday", "Monday", None]
    assert evaluate(spark, days, is_weekend, "timestamp_ntz") == [False, True, True, False, None]
    hours = [4, 5, 11, 12, 16, 17, 20, 21, None]
    assert evaluate(spark, hours, time_of_day, "int") == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night",
    ]


@pytest.mark.parametrize(
    "point, expected",
    [
        ((40.7, -74.0, 40.7, -74.0), 0.0),
        ((91.0, -74.0, 40.7, -74.0), None),
        ((40.7, -181.0, 40.7, -74.0), None),
        ((40.7, -74.0, None, -74.0), None),
        ((float("nan"), 0.0, 0.0, 0.0), None),
        ((0.0, 0.0, 0.0, 180.0), round(math.pi * 6371.01, 2)),
        ((0.0, 0.0, 1.0, 0.0), round(math.pi * 6371.01 / 180, 2)),
    ],
)
def test_distance(spark, point, expected):
    df = spark.createDataFrame([point], "a double, b double, c double, d double")
    assert df.select(distance_km(*[F.col(c) for c in "abcd"])).first()[0] == expected


def test_rounding(spark):
    pairs = spark.createDataFrame([(82, 80, 1), (1, 800, 2), (3, 2, 3), (1, 0, 4)], "a long, b long, i int")
    got = pairs.orderBy("i").select(
        ratio_2dp(F.col("a"), F.col("b")), ratio_2dp(F.col("a"), F.col("b"), 100), mean_2dp(F.col("a"), F.col("b"))
    )
    assert [tuple(r) for r in got.collect()] == [
        (1.03, 102.5, 0.01),
        (0.0, 0.13, 0.0),
        (1.5, 150.0, 0.02),
        (None, None, None),
    ]
    assert evaluate(spark, [1.005, 2.0 / 3, 0.125], round_2dp, "double") == [1.0, 0.67, 0.13]


def test_ratios_equal_decimal_arithmetic(spark):
    rng = random.Random(11)
    pairs = [(rng.randrange(10 ** rng.randrange(1, 12)), rng.randrange(1, 10 ** rng.randrange(1, 12))) for _ in range(500)]
    cents = Decimal("0.01")
    exact = [float((Decimal(a) / Decimal(b)).quantize(cents, ROUND_HALF_UP)) for a, b in pairs]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    got = df.orderBy("i").select(ratio_2dp(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == exact
