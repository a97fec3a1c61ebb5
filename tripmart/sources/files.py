"""Trip files: the raw CSV drop, and the landing zone with one folder per day."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import RAW_TRIP, STAGING_TRIP

# Position of a row in the drop: file, split of the file, row number inside the split.
ARRIVAL = ("__file", "__split", "__row")

# Cell texts that a raw file may use for a missing value (besides the empty cell).
MISSING = (
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Quotes are doubled inside quoted cells, as most CSV writers do; Spark's default is a backslash.
_CSV = {"header": True, "quote": '"', "escape": '"'}
_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_DAY_COLUMNS = ("year", "month", "day")
#: Files whose first line is read at a time.
_READERS = 16


def _cell(field: T.StructField) -> Column:
    """A text cell as its declared type; missing-value texts, unreadable cells and NaN become NULL."""
    text = F.col(field.name)
    value = F.when(~text.isin(*MISSING), text).try_cast(field.dataType)
    if field.dataType == T.DoubleType():
        value = F.when(~F.isnan(value), value)
    return value.alias(field.name)


def read_raw_trips(
    spark: SparkSession, path: str, pattern: str = "*.csv", with_arrival: bool = False
) -> DataFrame:
    """Every CSV file of a folder whose name matches ``pattern``, as typed raw trips.

    Columns are found by header name in each file, so files may differ in the order of columns and in further
    ones; a file without one of the columns is an error that names it. Files of equal header are read together.
    ``with_arrival`` adds the columns of :data:`ARRIVAL` for a first-come order over files and rows.
    """
    files = [r.path for r in list_files(spark, path, pattern).orderBy("path").collect()]
    if not files:
        raise ValueError(f"no file {pattern} in {path}")
    return read_raw_files(spark, files, with_arrival)


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``path``, ``length`` and ``modified`` of the files of a folder that hold something; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_raw_files(spark: SparkSession, files: Sequence[str], with_arrival: bool = False) -> DataFrame:
    """The same for the files that are named, each of which has a header."""
    cells = [_cell(f) for f in RAW_TRIP]
    arrival = [
        F.col("_metadata.file_path").alias(ARRIVAL[0]),
        F.col("_metadata.file_block_start").alias(ARRIVAL[1]),
        F.monotonically_increasing_id().alias(ARRIVAL[2]),
    ]
    parts = []
    for names, own in _headers(spark, files).items():
        if missing := [f.name for f in RAW_TRIP if f.name not in names]:
            raise ValueError(f"no column {', '.join(missing)} in {own[0]}")
        layout = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = spark.read.options(**_CSV).schema(layout).option("enforceSchema", False).csv(own)
        parts.append(df.select(*cells, *(arrival if with_arrival else [])))
    if not parts:
        raise ValueError(f"no file with a header among {files}")
    return reduce(DataFrame.unionAll, parts)


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files that have them, in order. Spark reads the first line of each file for it, no more."""

    def names(file: str) -> tuple[str, ...]:
        # Without the header option, so that a name that occurs twice stays as it is.
        first = spark.read.options(**{**_CSV, "header": False}).csv(file).limit(1).collect()
        return tuple((c or "").removeprefix("\ufeff") for c in first[0]) if first else ()

    with ThreadPoolExecutor(_READERS) as readers:
        found = list(readers.map(names, files))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for header, file in zip(found, files, strict=True):
        if header:
            layouts.setdefault(header, []).append(file)
    return layouts


def stamp_daily(trips: DataFrame) -> DataFrame:
    """Raw trips that have a start, with ``trip_date`` and the columns of the day folders.

    The rows go through a generator, behind which a column is computed once: otherwise whatever makes ``started_at``
    is repeated in the filter and in every column derived from it, and the generated method may grow past the 8000
    bytes up to which the JVM compiles one.
    """
    day = F.to_date("started_at")
    rows = trips.select(F.inline(F.array(F.struct(*[f.name for f in RAW_TRIP]))))
    return rows.withColumns(
        {
            "trip_date": day,
            "year": F.year(day).cast("string"),
            "month": F.lpad(F.month(day).cast("string"), 2, "0"),
            "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
        }
    ).filter(F.col("started_at").isNotNull())


def write_daily(trips: DataFrame, path: str) -> None:
    """Stamp ``trip_date`` and write CSV under ``year=Y/month=MM/day=DD``; a rerun replaces its days.

    One job writes all days. The rebalance gathers a day's rows into few files and, through AQE, splits
    a day that is much larger than the others over several tasks.
    """
    (
        stamp_daily(trips)
        .hint("rebalance", *_DAY_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**_CSV)
        .option("timestampNTZFormat", _TIMESTAMP)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(*_DAY_COLUMNS)
        .csv(path)
    )


def read_staging_trips(spark: SparkSession, path: str) -> DataFrame:
    """All days of the landing zone; every cell is text and an empty cell is ``''``, not NULL.

    Cells are matched to the fixed header by position: a short row is padded and extra cells are cut.
    """
    names = [f.name for f in STAGING_TRIP]
    df = spark.read.options(**_CSV).schema(STAGING_TRIP).csv(path)
    return df.select(*[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names])
