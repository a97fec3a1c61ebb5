"""Generic operators against plain Python, with keys that hold most of the rows."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmart.operators import (
    append_new,
    count_distinct_multi,
    count_where,
    dedupe_first,
    drop_anomaly,
    full_outer_on,
    latest_per_key,
    left_lookup,
    peak_bucket,
    share_of_total,
    stack_sides,
    top_k,
    total_order,
    with_previous,
)

START = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def history(n, seed):
    """(key, ts, value): one key holds about half the rows, timestamps are unique per key."""
    rng = random.Random(seed)
    seconds = rng.sample(range(n * 40), n)
    return [
        (rng.choice(["hot", "hot", "hot", "a", "b", "c"]), START + dt.timedelta(seconds=s), rng.choice([None, 1, 60]))
        for s in seconds
    ]


def lagged(rows):
    last, out = {}, []
    for key, ts, value in sorted(rows, key=lambda r: (r[0], r[1])):
        previous = last.get(key, (None, None))
        out.append((key, ts, value, previous[0], previous[1]))
        last[key] = (value, ts)
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
@pytest.mark.parametrize("seed", [1, 2])
def test_with_previous_equals_lag(spark, unit, seed):
    rows = history(600, seed)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int").repartition(3)
    got = with_previous(df, ["k"], ["ts"], ["v", "ts"], slice_by=F.date_trunc(unit, "ts"))
    assert rows_of(got) == lagged(rows)


def test_with_previous_on_two_order_columns(spark):
    df = spark.createDataFrame([("a", 1, 2, "y"), ("a", 1, 1, "x"), ("a", 2, 0, "z")], "k string, t int, s int, v string")
    got = with_previous(df, ["k"], ["t", "s"], ["v"], slice_by=F.col("t"))
    assert rows_of(got.select("v", "previous_v")) == [("x", None), ("y", "x"), ("z", "y")]


def test_with_previous_rejects_null_keys(spark):
    df = spark.createDataFrame([(None, 1)], "k string, t int")
    with pytest.raises(PySparkException, match="NULL in key column k"):
        with_previous(df, ["k"], ["t"], ["t"], slice_by=F.col("t")).collect()


def test_drop_anomaly(spark):
    # gap and drop: 60 s / 50, 61 s / 50, 60 s / 49, a rise; the first row of a key is normal
    steps = [(0, 200), (60, 150), (121, 100), (181, 51), (182, 300)]
    rows = [("s", START + dt.timedelta(seconds=s), v) for s, v in steps]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    compared = with_previous(df, ["k"], ["ts"], ["v", "ts"], slice_by=F.date_trunc("minute", "ts"))
    got = drop_anomaly(compared, "v", "ts").orderBy("ts").select("time_diff_seconds", "value_drop", "anomaly_status")
    assert [tuple(r) for r in got.collect()] == [
        (None, None, "NORMAL"),
        (60, 50, "ANOMALY"),
        (61, 50, "NORMAL"),
        (60, 49, "NORMAL"),
        (1, -249, "NORMAL"),
    ]


def test_dedupe_and_latest(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", None, "a"]), rng.randrange(50), rng.randrange(4)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(4)
    order = total_order(df, [F.col("t").asc()], skip=["k", "t"])
    first = {k: min((t, v) for kk, t, v in rows if kk == k) for k in {r[0] for r in rows}}
    once = dedupe_first(df, ["k"], order)
    assert {r.k: (r.t, r.v) for r in once.collect()} == first
    assert rows_of(dedupe_first(once, ["k"], order)) == rows_of(once)
    newest = {k: max((t, v) for kk, t, v in rows if kk == k) for k in {r[0] for r in rows}}
    assert {r.k: (r.t, r.v) for r in latest_per_key(df, ["k"], "t").collect()} == newest


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe_first(df, ["k"], [F.col("id")])._jdf.queryExecution().toString()
    # Printed from the top down, so the limit below the exchange comes last.
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange hashpartitioning")


def test_peak_bucket_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("b", 9)], "k string, h int")
    assert rows_of(peak_bucket(df, ["k"], "h")) == [("a", 1, 2), ("b", 9, 1)]


@pytest.mark.parametrize("few", [True, False])
def test_share_of_total(spark, few):
    df = spark.createDataFrame([("a", 1), ("b", 799)], "k string, n long")
    assert rows_of(share_of_total(df, "n", "pct", few_groups=few)) == [("a", 1, 0.13), ("b", 799, 99.88)]


def test_counts_and_top(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("a", 2, "y"), ("b", None, None)], "k string, n int, s string")
    assert rows_of(count_distinct_multi(df, ["k"], {"ns": "n", "ss": "s"})) == [("a", 2, 2), ("b", 0, 0)]
    assert rows_of(count_where(df, ["k"], {"ones": F.col("n") == 1})) == [("a", 2), ("b", 0)]
    assert [tuple(r) for r in top_k(df.select("k", "n").distinct(), "n", ["k"], 2).collect()] == [("a", 2), ("a", 1)]


def test_stack_sides(spark):
    df = spark.createDataFrame([(1, "p", "q")], "i int, a string, b string")
    got = stack_sides(df, {"START": {"s": F.col("a")}, "END": {"s": F.col("b")}}, keep=["i"])
    assert rows_of(got) == [(1, "END", "q"), (1, "START", "p")]


def test_append_new(spark):
    stored = spark.createDataFrame([("a", "old")], "k string, v string")
    incoming = spark.createDataFrame(
        [("a", "new", 1), ("b", "late", 3), ("b", "early", 2), ("c", "x", 4)], "k string, v string, pos int"
    )
    once = append_new(stored, incoming, "k", ["pos"])
    assert rows_of(once) == [("a", "old"), ("b", "early"), ("c", "x")]
    assert rows_of(append_new(once, incoming, "k", ["pos"])) == rows_of(once)
    with pytest.raises(PySparkException, match="NULL in key column k"):
        append_new(stored, spark.createDataFrame([(None, "x")], "k string, v string"), "k").collect()


def test_full_outer_fans_out_and_never_matches_null(spark):
    left = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "only left")], "l int, n string")
    right = spark.createDataFrame([(7, "x"), (8, None), (9, "only right")], "r int, m string")
    got = full_outer_on(left, right, F.col("n"), F.col("m")).select("l", "r")
    native = left.join(right, F.col("n") == F.col("m"), "full_outer").select("l", "r")
    assert rows_of(got) == rows_of(native)
    assert len(rows_of(got)) == 6


def test_left_lookup_last_wins(spark):
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    info = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "sid string, name string, pos int")
    got = left_lookup(df, info, "id", "sid", {"station_name": "name"}, [F.col("pos").desc()])
    assert rows_of(got) == [("1", "new"), ("2", None)]
