"""What a row costs: expressions are computed once, and generated methods stay small enough for the JVM to compile."""

import contextlib
import io
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripmart.functions import WHITESPACE, safe_timestamp, trim_ws
from tripmart.plans.trips import valid_trips
from tripmart.showcase.inputs import staging_trips
from tripmart.sources.files import write_daily
from tripmart.sources.schemas import RAW_TRIP

SF_DIR = "/root/testdata/sf0.001"
# The JVM does not compile a method of more bytes.
LARGEST_COMPILED = 8000


def raw_from_text(staging):
    kinds = {"timestamp_ntz": safe_timestamp, "double": lambda c: c.try_cast("double")}
    return staging.select(
        *[kinds.get(f.dataType.simpleString(), lambda c: c)(F.col(f.name)).alias(f.name) for f in RAW_TRIP]
    )


def written_plan(df, monkeypatch, tmp_path):
    """What ``write_daily`` hands to the writer."""
    seen = []
    cls = type(df)
    monkeypatch.setattr(cls, "hint", lambda self, *a, real=cls.hint: seen.append(self) or real(self, *a))
    write_daily(df, str(tmp_path / "landing"))
    return seen[0]


def test_the_start_is_computed_once_for_the_day_folders(spark, monkeypatch, tmp_path):
    stamped = written_plan(raw_from_text(staging_trips(spark, SF_DIR)), monkeypatch, tmp_path)
    plan = stamped._jdf.queryExecution().optimizedPlan().toString()
    # One for the start and one for the end.
    assert plan.count("convert_timezone(") == 2, plan
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        stamped.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < LARGEST_COMPILED


def test_the_limits_of_a_ride_count_whole_seconds(spark):
    start = datetime(2024, 3, 10, 1, 59, 59, 500_000)
    rides = {
        "none": None,
        "backwards": timedelta(seconds=-5),
        "too short": timedelta(microseconds=999_999),
        "shortest": timedelta(seconds=1),
        "longest": timedelta(seconds=86_400, microseconds=999_999),
        "too long": timedelta(seconds=86_401),
    }
    rows = [(k, "a", "b", "member", start, None if d is None else start + d) for k, d in rides.items()]
    df = spark.createDataFrame(
        rows,
        "ride_id string, start_station_id string, end_station_id string, member_casual string, "
        "started_at timestamp_ntz, ended_at timestamp_ntz",
    )
    valid = valid_trips(df)
    assert {r.ride_id for r in valid.collect()} == {"shortest", "longest"}
    assert "timestampdiff" not in valid._jdf.queryExecution().optimizedPlan().toString()


def test_trimming_visible_texts_needs_no_set(spark):
    inner = ["", "a", "a b", "\u00e9", "a\u00e9", "\u00e9a", "a\x7f", "\x7fa", "\x00", "~", "!", "\u200b", "\U0001f6b2 x"]
    sides = ["", " ", "  ", *WHITESPACE, " \t ", "\u3000 "]
    texts = [None, *[f"{a}{t}{b}" for t in inner for a in sides for b in sides]]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1)
    got = [(r.t, r.s) for r in df.select("t", trim_ws(F.col("t")).alias("s")).collect()]
    assert got == [(t, None if t is None else t.strip(WHITESPACE)) for t in texts]
    plan = df.select(trim_ws(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan
