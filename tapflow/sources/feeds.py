"""Readers of the raw feeds: text columns, named by position.

`fmt` may name any Spark file format that holds the same columns in the same order (`csv` is what the
feeds come in; at scale, converting them to parquet once lets every job read only the columns it
uses).
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tapflow.schemas import BUS_SITES_RAW, GATES_KEPT, GATES_RAW, GPS_RAW, TAPS_RAW, VEHICLES_RAW


def _read(spark: SparkSession, path, names: list[str], fmt: str, **options) -> DataFrame:
    raw = spark.read.format(fmt).options(**options).load(path)
    if len(raw.columns) != len(names):
        raise ValueError(f"{path}: expected {len(names)} columns, found {len(raw.columns)}")
    return raw.toDF(*names)


def read_bus_taps(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, TAPS_RAW, fmt, header=True, sep="\t")


def read_rail_gates(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, GATES_RAW, fmt, header=True).select(*GATES_KEPT)


def read_gps(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, GPS_RAW, fmt, header=True)


def read_bus_sites(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, BUS_SITES_RAW, fmt, header=True)


def read_rail_sites(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    """The station file has no header; the code, name and position columns are used."""
    raw = spark.read.format(fmt).options(header=False).load(path)
    return raw.select("_c1", "_c3", "_c5", "_c6")


def read_vehicles(spark: SparkSession, path, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, VEHICLES_RAW, fmt, header=True)


# Readers that keep what they can't read --------------------------------------------------------

#: Column of a line whose number of fields isn't the feed's; Spark's CSV reader puts the whole line there.
REJECTED = "_rejected_line"

#: Per feed: its columns in file order, the columns kept, and the options of its files (fixed by the feeds).
FEEDS = {
    "taps": (TAPS_RAW, TAPS_RAW, {"header": True, "sep": "\t"}),
    "gates": (GATES_RAW, GATES_KEPT, {"header": True, "sep": ","}),
    "gps": (GPS_RAW, GPS_RAW, {"header": True, "sep": ","}),
    "bus_sites": (BUS_SITES_RAW, BUS_SITES_RAW, {"header": True, "sep": ","}),
    "vehicles": (VEHICLES_RAW, VEHICLES_RAW, {"header": True, "sep": ","}),
}


class Checked(NamedTuple):
    """Lines of a feed with the feed's number of fields, as text columns; the others with their file and text."""

    rows: DataFrame
    rejects: DataFrame


def read_lines(spark: SparkSession, path, feed: str, fmt: str = "csv", **extra_options) -> DataFrame:
    """Every line of a feed in one scan, with an explicit all-text schema: the kept columns, `line` and `file`.

    A line with too few or too many fields has its text in `line` and nulls in the columns; good lines have `line` null.
    """
    names, kept, options = FEEDS[feed]
    extra = dict(extra_options)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, REJECTED]])
    raw = (
        spark.read.format(fmt).schema(schema)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, **(dict(options) | extra)).load(path)
    )
    bad = F.col(REJECTED).isNotNull()
    # A line's fields are counted only where all its columns are parsed, and Spark refuses a scan that needs nothing but
    # the rejected text: an empty piece of all fields keeps every column needed.
    line = F.concat(F.col(REJECTED), F.substring(F.concat_ws("", *[F.col(n) for n in names]), 1, 0))
    return raw.select(
        *[F.when(~bad, F.col(c)).alias(c) for c in kept], line.alias("line"),
        F.col("_metadata.file_path").alias("file"),
    )


def read_checked(spark: SparkSession, path, feed: str, fmt: str = "csv") -> Checked:
    """The feed's good rows (its kept columns) and its rejected lines (`file`, `line`)."""
    lines = read_lines(spark, path, feed, fmt)
    names = FEEDS[feed][1]
    return Checked(lines.filter(F.col("line").isNull()).select(*names), lines.filter(F.col("line").isNotNull()).select("file", "line"))


#: A day in a file's path: a folder named by it (`2024-01-31`, `day=2024-01-31`, or `2019-11-1` as some feeds name it).
PATH_DAY = r"/(?:[a-z_]+=)?([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})/[^/]*$"


def day_of_file(file: str = "file") -> str:
    """SQL: the service day that the folder of a line's file names (`file` is `_metadata.file_path`)."""
    return f"to_date(nullif(regexp_extract({file}, '{PATH_DAY}', 1), ''), 'yyyy-M-d')"


def read_day_folders(spark: SparkSession, path, feed: str, fmt: str = "csv") -> DataFrame:
    """All day folders below `path` in one read (`recursiveFileLookup`, so folder names aren't taken as columns); each
    line has `file`, from which `day_of_file` gives its day."""
    return read_lines(spark, path, feed, fmt, recursiveFileLookup=True)
