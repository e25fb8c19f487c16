"""Derived tables kept between runs, and the results."""

import json
import time
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tapflow.functions import compact_from_ms
from tapflow.operators.journeys import JOURNEYS
from tapflow.operators.transfers import PAIR
from tapflow.schemas import LEGS


def _exists(spark: SparkSession, path: str, fmt: str, **options) -> bool:
    try:
        spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet"
) -> DataFrame:
    """The table at `path`; if there is none, it is built, written and read back."""
    if not _exists(spark, path, fmt):
        build().write.format(fmt).mode("overwrite").save(path)
    return spark.read.format(fmt).load(path)


# Results ----------------------------------------------------------------------------------------


def _with_text_times(df: DataFrame, times: list[str], columns: list[str]) -> DataFrame:
    """`*_ms` columns become `*_time` text; the day stays as the partition column."""
    return df.selectExpr(
        "service_date",
        *[
            f"{compact_from_ms(c)} AS {c.replace('_ms', '_time')}" if c in times else c
            for c in columns
        ],
    )


def legs_output(legs: DataFrame) -> DataFrame:
    columns = [c for c in LEGS if c not in ("service_date", "person")]
    return _with_text_times(legs, ["on_ms", "off_ms"], columns)


def transfers_output(pairs: DataFrame) -> DataFrame:
    columns = ["card", *[f"{side}_{c}" for side in ("pre", "curr") for c in PAIR]]
    times = [f"{side}_{c}_ms" for side in ("pre", "curr") for c in ("on", "off")]
    return _with_text_times(pairs, times, columns)


def journeys_output(journeys: DataFrame) -> DataFrame:
    columns = [c for c in JOURNEYS if c not in ("service_date", "person")]
    return _with_text_times(journeys, ["on_ms", "off_ms"], columns)


def _day_files(spark: SparkSession, path: str, days: list[date]) -> dict[date, tuple]:
    """Folder and names of its files, for each of the days that has a folder."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for day in days:
        folder = jvm.org.apache.hadoop.fs.Path(top, f"service_date={day}")
        if system.exists(folder):
            found[day] = (system, folder, {str(f.getPath().getName()) for f in system.listStatus(folder)})
    return found


def write_days(df: DataFrame, path: str, fmt: str = "parquet", days: list[date] | None = None) -> None:
    """Overwrites the days found in `df` and leaves other days under `path` alone.

    `days` are the days that a run covers: those of them that have no rows now lose what an earlier run wrote.
    Files have names of their own in each write, so a day whose files are still the same is such a day.

    Rows are rebalanced by day first, so that a day ends up in well-sized files whatever the number
    of tasks that computed it, and a large day in many.
    """
    before = _day_files(df.sparkSession, path, days or [])
    writer = df.hint("rebalance", "service_date").write.format(fmt).mode("overwrite")
    writer = writer.partitionBy("service_date").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    for day, (system, folder, names) in _day_files(df.sparkSession, path, days or []).items():
        if day in before and names == before[day][2]:
            system.delete(folder, True)


# Alighting history --------------------------------------------------------------------------------


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of the saved history, or None if none was saved yet."""
    if not _exists(spark, path, "parquet"):
        return None
    saved = spark.read.parquet(path)
    newest = saved.agg(F.max("version")).first()[0]
    return saved.filter(F.col("version") == newest).drop("version")


def write_history(weights: DataFrame, path: str) -> None:
    """Saves weights per service_date, route and site as a new version beside the earlier ones, so the version being read is never overwritten.

    Files of a version appear only when its job commits, so a failed write is never the newest one.
    """
    spark = weights.sparkSession
    newest = 0
    if _exists(spark, path, "parquet"):
        newest = spark.read.parquet(path).agg(F.max("version")).first()[0]
    weights.write.mode("errorifexists").parquet(f"{path}/version={newest + 1}")


# Results published together -----------------------------------------------------------------------

MANIFESTS = "_manifests"


def _system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), top


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Versions and paths of the manifests under `path`, oldest first."""
    jvm, system, top = _system(spark, path)
    folder = jvm.org.apache.hadoop.fs.Path(top, MANIFESTS)
    if not system.exists(folder):
        return []
    found = []
    for status in system.listStatus(folder):
        name = str(status.getPath().getName())
        if name.startswith("v") and name.endswith(".json"):
            found.append((int(name[1:-5]), str(status.getPath())))
    return sorted(found)


def _read_text(spark: SparkSession, file: str) -> str:
    jvm, system, target = _system(spark, file)
    stream = system.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: `version` and, per result, its format, schema and the run whose files hold each day."""
    found = _manifests(spark, path)
    return json.loads(_read_text(spark, found[-1][1])) if found else {"version": 0, "results": {}}


def read_published(spark: SparkSession, path: str, result: str) -> DataFrame | None:
    """The published days of `result`, as the newest manifest names them; None if it names none of it.

    Files of a run that isn't published yet, or that failed, are never read.
    """
    entry = manifest(spark, path)["results"].get(result)
    if entry is None:
        return None
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    folders = [f"{path}/{result}/service_date={day}/run={run}" for day, run in sorted(entry["days"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(entry["format"]).option("basePath", f"{path}/{result}")
    if entry["format"] == "csv":
        reader = reader.option("header", True)
    return reader.load(folders).drop("run")


class Publication:
    """Results of one run, staged beside the published ones, that become visible together by one new manifest.

    `stage` writes a result's days into folders of this run (`<result>/service_date=<day>/run=<run>`), which no reader
    follows yet; `commit` creates manifest version n + 1, in which the days of this run (and, among `days`, those left
    without rows) replace what version n said. A manifest is created, never overwritten: if another run published in
    between, commit fails and nothing changes. Folders that no kept manifest names are removed by `retire`.
    """

    def __init__(self, spark: SparkSession, path: str, days: list[date] | None = None):
        self.spark, self.path, self.days = spark, path, [str(d) for d in days or []]
        self.base = manifest(spark, path)
        self.run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.staged: dict[str, dict] = {}

    def stage(self, df: DataFrame, result: str, fmt: str = "parquet") -> DataFrame:
        """Writes `df` (with `service_date`) as this run's days of `result`, and returns them read back."""
        out = f"{self.path}/{result}"
        writer = df.withColumn("run", F.lit(self.run)).hint("rebalance", "service_date").write.format(fmt).mode("append")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.partitionBy("service_date", "run").save(out)
        jvm, system, top = _system(self.spark, out)
        days = []
        if system.exists(top):
            for status in system.listStatus(top):
                name = str(status.getPath().getName())
                if name.startswith("service_date=") and system.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), f"run={self.run}")):
                    days.append(name.split("=", 1)[1])
        self.staged[result] = {"format": fmt, "schema": df.schema.json(), "days": sorted(days)}
        folders = [f"{out}/service_date={day}/run={self.run}" for day in sorted(days)]
        if not folders:
            return self.spark.createDataFrame([], df.schema)
        reader = self.spark.read.format(fmt).option("basePath", out)
        if fmt == "csv":
            reader = reader.option("header", True)
        return reader.load(folders).drop("run")

    def commit(self) -> int:
        """Publishes all staged results at once; returns the new manifest's version."""
        results = {name: dict(entry) for name, entry in self.base["results"].items()}
        for name, staged in self.staged.items():
            days = {d: r for d, r in results.get(name, {}).get("days", {}).items() if d not in self.days}
            days |= {d: self.run for d in staged["days"]}
            results[name] = {"format": staged["format"], "schema": staged["schema"], "days": days}
        version = self.base["version"] + 1
        text = json.dumps({"version": version, "run": self.run, "results": results}, sort_keys=True)
        jvm, system, top = _system(self.spark, self.path)
        target = jvm.org.apache.hadoop.fs.Path(top, f"{MANIFESTS}/v{version:09d}.json")
        stream = system.create(target, False)  # fails if another run took this version
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return version


def retire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Removes manifests older than the newest `keep`, and run folders that none of those names and that are older than
    the oldest kept run (younger ones may belong to a run in progress). Returns the removed folders."""
    found = _manifests(spark, path)
    if not found:
        return []
    kept = [json.loads(_read_text(spark, file)) for _, file in found[-keep:]]
    named = {(name, day, run) for m in kept for name, entry in m["results"].items() for day, run in entry["days"].items()}
    oldest = min(m.get("run", "") for m in kept)
    jvm, system, top = _system(spark, path)
    removed = []
    for name in {name for m in kept for name in m["results"]}:
        result = jvm.org.apache.hadoop.fs.Path(top, name)
        if not system.exists(result):
            continue
        for day_status in system.listStatus(result):
            day_name = str(day_status.getPath().getName())
            if not day_name.startswith("service_date="):
                continue
            for run_status in system.listStatus(day_status.getPath()):
                run = str(run_status.getPath().getName()).removeprefix("run=")
                if (name, day_name.split("=", 1)[1], run) not in named and run < oldest:
                    system.delete(run_status.getPath(), True)
                    removed.append(str(run_status.getPath()))
    for _, file in found[:-keep]:
        system.delete(jvm.org.apache.hadoop.fs.Path(file), False)
    return removed


# Alighting history as a log -----------------------------------------------------------------------

EMPTY_DAY = "_EMPTY"


def _runs_by_day(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Run folders of each day of a log, oldest first, by listing folders (no data is read)."""
    jvm, system, top = _system(spark, path)
    found: dict[str, list[str]] = {}
    if not system.exists(top):
        return found
    for day in system.listStatus(top):
        name = str(day.getPath().getName())
        if name.startswith("service_date="):
            runs = [str(r.getPath().getName()).removeprefix("run=") for r in system.listStatus(day.getPath())]
            found[name.split("=", 1)[1]] = sorted(r for r in runs if not r.startswith("_"))
    return found


def write_history_log(weights: DataFrame, path: str, days: list[date] | None = None) -> str:
    """Appends one run's weights: a folder `service_date=<day>/run=<run>` per day it has rows for, and an empty marked
    folder for each of `days` that has none. Nothing written before is read or rewritten, so what a run writes grows
    with its own days only. Returns the run's name (ordered by time)."""
    spark = weights.sparkSession
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    weights.withColumn("run", F.lit(run)).hint("rebalance", "service_date").write.mode("append") \
        .partitionBy("service_date", "run").parquet(path)
    written = {day for day, runs in _runs_by_day(spark, path).items() if run in runs}
    jvm, system, top = _system(spark, path)
    for day in {str(d) for d in days or []} - written:
        marker = jvm.org.apache.hadoop.fs.Path(top, f"service_date={day}/run={run}/{EMPTY_DAY}")
        system.create(marker, False).close()
    return run


def read_history_log(spark: SparkSession, path: str) -> DataFrame | None:
    """For each day, the weights of the newest run that wrote it; None if the log has no rows."""
    jvm, system, top = _system(spark, path)
    folders = []
    for day, runs in sorted(_runs_by_day(spark, path).items()):
        if runs:
            folder = f"{path}/service_date={day}/run={runs[-1]}"
            if not system.exists(jvm.org.apache.hadoop.fs.Path(folder, EMPTY_DAY)):
                folders.append(folder)
    if not folders:
        return None
    return spark.read.option("basePath", path).parquet(*folders).drop("run")


def compact_history_log(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Removes all but the newest `keep` runs of each day (the newest alone is read); returns what was removed."""
    jvm, system, top = _system(spark, path)
    removed = []
    for day, runs in _runs_by_day(spark, path).items():
        for run in runs[:-keep]:
            folder = jvm.org.apache.hadoop.fs.Path(top, f"service_date={day}/run={run}")
            system.delete(folder, True)
            removed.append(str(folder))
    return removed
