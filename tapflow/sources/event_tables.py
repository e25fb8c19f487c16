"""Raw feeds derived from general-purpose tables: `events` (who did what when) and `part`.

The tables hold no transit data; this maps every event and every part to a feed row (FIXTURES.md,
section 3), as the raw text the readers would return, so that cleaning is exercised too.

Events of about a month are squeezed into one half-day by default, which makes the ten-minute and
one-hour rules bite; `squeeze=1` keeps the real days.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.functions.keys import UP_TEXT
from tapflow import functions as fn
from tapflow.operators import cleaning
from tapflow.sources.feeds import FEEDS
from tapflow.schemas import BUS_SITES_RAW, GATES_KEPT, GPS_RAW, TAPS_RAW, VEHICLES_RAW

START_MS = 1_704_067_200_000
SQUEEZE = 60


def _wide(number: str, width: int) -> str:
    return f"lpad({number}, {width}, '0')"


@dataclass
class EventTables:
    spark: SparkSession
    folder: str
    squeeze: int = SQUEEZE

    def __post_init__(self):
        # Text times are read and written in the session's zone; the tables are in UTC.
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")

    @cached_property
    def _all_events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/events.parquet")

    @cached_property
    def _parts(self) -> DataFrame:
        parts = self.spark.read.parquet(f"{self.folder}/part.parquet")
        return parts.selectExpr("p_partkey AS p", "p_partkey div 20 AS r", "p_partkey % 20 AS n")

    def _events(self, *kinds: str) -> DataFrame:
        wanted = "', '".join(kinds)
        ms = "unix_millis(cast(ts AS timestamp))"
        return self._all_events.filter(f"event_type IN ('{wanted}')").selectExpr(
            "user_id", "event_type", "value", "cast(get_json_object(props, '$.k') AS bigint) AS k",
            f"{START_MS}L + ({ms} - {START_MS}L) div {self.squeeze}L AS t",
        )

    def _fill(self, rows: DataFrame, names: list[str], values: dict[str, str]) -> DataFrame:
        return rows.selectExpr(*[f"cast({values.get(c, 'NULL')} AS string) AS {c}" for c in names])

    @cached_property
    def taps_raw(self) -> DataFrame:
        return self._fill(self._events("purchase"), TAPS_RAW, {
            "tap_time": "date_format(timestamp_millis(t), 'yyyy-MM-dd HH:mm:ss.SSS')",
            "card": _wide("user_id", 16),
            "card_type": "k % 16",
            "fare_due": "floor(value * 100)",
            "fare_paid": "floor(value * 100)",
            "change_type": "'0'",
            "vehicle": "k % 10",
            "route": "1 + k % 5",
            "site": "'0'",
        })

    @cached_property
    def gates_raw(self) -> DataFrame:
        return self._fill(self._events("signup", "error"), GATES_KEPT, {
            "card": f"concat('8600', {_wide('user_id', 16)})",
            "card_type": "'1'",
            "date": "date_format(timestamp_millis(t), 'yyyyMMdd')",
            "time": "date_format(timestamp_millis(t), 'HHmmss')",
            "station": f"concat({_wide('91 + k div 20', 2)}, {_wide('1 + k % 20', 2)})",
            "in_out": "IF(event_type = 'signup', '21', '22')",
            "txn_amt": "floor(value * 100)",
            "reward_amt": "k",
        })

    @cached_property
    def gps_raw(self) -> DataFrame:
        return self._fill(self._events("view", "click"), GPS_RAW, {
            "vehicle": "user_id % 10",
            "gps_time": "date_format(timestamp_millis(t), 'yyyy-MM-dd HH:mm:ss')",
            "site": "greatest(0, 1 + (t div 180000) % 20 - IF(k % 10 = 0, 2, 0))",
        })

    @cached_property
    def bus_sites_raw(self) -> DataFrame:
        return self._fill(self._parts, BUS_SITES_RAW, {
            "route_id": _wide("1 + r", 16),
            "route": "1 + r",
            "site_id": _wide("100 * (1 + r) + 1 + n", 16),
            "site_name": "concat('S', (p div 120) * 40 + p % 40)",
            "up_down": f"IF(r < 5 OR r % 2 = 0, '{UP_TEXT}', '下行')",
            "site": "1 + n",
            "lon": "cast(106500 + 6 * n + 200 * (r div 500) AS double) / 1000",
            "lat": "cast(29500 + 4 * (r % 500) AS double) / 1000",
        })

    @cached_property
    def rail_sites_raw(self) -> DataFrame:
        """A hundred stations, the most the gate records name, out of all parts."""
        rows = self._parts.selectExpr("p % 100 AS p").distinct()
        return self._fill(rows, ["_c1", "_c3", "_c5", "_c6"], {
            "_c1": f"concat({_wide('91 + p div 20', 2)}, {_wide('1 + p % 20', 2)})",
            "_c3": "concat('S', p % 40, 'R')",
            "_c5": "cast(106500 + 6 * (p % 20) AS double) / 1000",
            "_c6": "cast(29501 + 4 * (p div 20) AS double) / 1000",
        })

    @cached_property
    def vehicles_raw(self) -> DataFrame:
        rows = self._events("purchase").selectExpr("k % 10 AS v", "1 + k % 5 AS r").distinct()
        return self._fill(rows, VEHICLES_RAW, {
            "vehicle": "v", "route": "r", "route_id": _wide("r", 16),
        })

    @cached_property
    def taps(self) -> DataFrame:
        return cleaning.clean_taps(self.taps_raw)

    @cached_property
    def gates(self) -> DataFrame:
        return cleaning.clean_gates(self.gates_raw)

    @cached_property
    def gps_fixes(self) -> DataFrame:
        return cleaning.clean_gps(self.gps_raw)

    @cached_property
    def bus_sites(self) -> DataFrame:
        return cleaning.clean_bus_sites(self.bus_sites_raw)

    @cached_property
    def rail_sites(self) -> DataFrame:
        return cleaning.clean_rail_sites(self.rail_sites_raw)


#: Fields that a damaged line of each feed keeps (fewer than the feed has), and its time and card columns.
CUT = {"taps": 5, "gates": 20, "gps": 3}
TIME = {"taps": "tap_time", "gates": "time", "gps": "gps_time"}
CARD = {"taps": "card", "gates": "card", "gps": "card"}


def feed_text(rows: DataFrame, feed: str, damage: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows of a raw feed as the lines of its file (`value`), some damaged by the first hex digit of the line's md5:
    0 cuts the line after `CUT[feed]` fields, 1 makes its time `not a time`, 2 empties its card."""
    names, _, options = FEEDS[feed]
    fields = [F.coalesce(F.col(c) if c in rows.columns else F.lit(None).cast("string"), F.lit("")) for c in names]
    line = F.concat_ws(options["sep"], *fields)
    digit = F.substring(F.md5(line), 1, 1)
    damaged = [
        F.when(digit == "1", F.lit("not a time")).otherwise(f) if c == TIME[feed]
        else F.when(digit == "2", F.lit("")).otherwise(f) if c == CARD[feed] else f
        for c, f in zip(names, fields)
    ]
    text = F.when(digit == "0", F.concat_ws(options["sep"], *fields[: CUT[feed]])).otherwise(F.concat_ws(options["sep"], *damaged))
    return rows.select(*carry, (text if damage else line).alias("value"))


def write_feed_files(rows: DataFrame, feed: str, path: str) -> None:
    """Lines of `feed_text` written as text files with a header line each, as the feeds come."""
    feed_text(rows, feed).write.mode("overwrite").options(header=True, sep="\u0001", quote="", escape="").csv(path)


#: Hour at which a file's service day begins: records before it belong to the file of the day before.
DAY_STARTS = 3
#: Epoch ms of each feed's raw record, as SQL over its text columns.
RECORD_MS = {
    "taps": fn.ms_from_text("tap_time"), "gps": fn.ms_from_text("gps_time"),
    "gates": fn.ms_from_compact("concat(date, time)"),
}


def write_day_files(rows: DataFrame, feed: str, path: str) -> None:
    """The feed's lines (undamaged) in one folder per service day, `path/day=<yyyy-MM-dd>/`, as a day's files arrive:
    a day runs from `DAY_STARTS` o'clock to the same hour of the next, so rides after midnight are in the day before."""
    day = F.expr(f"to_date(timestamp_millis({RECORD_MS[feed]} - {DAY_STARTS * 3_600_000}L))")
    lines = feed_text(rows.withColumn("day", day), feed, damage=False, carry=("day",))
    lines.write.mode("overwrite").partitionBy("day").options(header=True, sep="\u0001", quote="", escape="").csv(path)
