from tests.frames import DAY_MS

from tapflow import functions as fn
from tapflow.operators import cleaning
from tapflow.schemas import GATES_KEPT, GPS_RAW, TAPS_RAW


def raw(spark, names, *rows):
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def tap(kind, **more):
    return {
        "tap_time": "2024-01-01 00:00:01.080000000", "card": "1234567890123456", "card_type": kind,
        "fare_due": "200", "fare_paid": "180", "vehicle": "7", "route": "118", "site": "3",
    } | more


def test_free_types_are_compared_as_written(spark):
    taps = cleaning.clean_taps(raw(spark, TAPS_RAW, tap("3"), tap("1"), tap("03"), tap("14"), tap("15")))
    got = [(r.card_type, r.fare_due, r.fare_paid) for r in taps.collect()]
    assert got == [("03", 0, 0), ("01", 200, 180), ("03", 200, 180), ("14", 0, 0), ("15", 0, 0)]


def test_tap_keys_and_time(spark):
    row = cleaning.clean_taps(raw(spark, TAPS_RAW, tap("1"))).first()
    assert (row.vehicle, row.route, row.site) == ("00000007", "00000118", "000003")
    assert (row.ts_ms, row.person, str(row.service_date)) == (DAY_MS + 1000, "90123456", "2024-01-01")


def test_service_date_of_the_file_wins(spark):
    row = cleaning.clean_taps(raw(spark, TAPS_RAW, tap("1")), service_date="2023-12-31").first()
    assert str(row.service_date) == "2023-12-31"


def test_unreadable_taps_are_counted_not_fatal(spark):
    feed = raw(spark, TAPS_RAW, tap("1"), tap("1", tap_time="soon"), tap("1", fare_due="x"))
    assert cleaning.clean_taps(feed).count() == 2
    assert tuple(cleaning.tap_rejects(feed).first()) == (1, 1, 0, 3)


def test_gates(spark):
    feed = raw(spark, GATES_KEPT, {
        "card": "86001234567890123456", "card_type": "1", "date": "20240101", "time": "000002",
        "station": "0102", "in_out": "21", "txn_amt": "300", "reward_amt": "30",
    })
    row = cleaning.clean_gates(feed).first()
    assert (row.card, row.person, row.ts_ms) == ("1234567890123456", "90123456", DAY_MS + 2000)
    assert (row.card_type, row.fare_due, row.fare_paid) == ("01", 330, 300)
    assert tuple(cleaning.gate_rejects(feed).first()) == (0, 0, 1)


def test_gps_between_stops_is_dropped_before_padding(spark):
    feed = raw(
        spark, GPS_RAW,
        {"vehicle": "1", "gps_time": "2024-01-01 00:00:03", "site": "0"},
        {"vehicle": "1", "gps_time": "2024-01-01 00:00:04", "site": "4"},
    )
    assert [(r.ts_ms, r.site) for r in cleaning.clean_gps(feed).collect()] == [(DAY_MS + 4000, "000004")]


def value(spark, text):
    return spark.sql(f"SELECT {text} AS v").first().v


def test_distance(spark):
    def km(*coordinates):
        return value(spark, fn.site_distance(*[f"'{c}'" for c in coordinates]))

    assert km(106.5, 29.5, 106.506, 29.5) == 0.58
    assert km(106.5, 29.5, 106.5, 29.509) == 1.0
    assert km(106.5, 29.5, 106.511, 29.5) == 1.07
    assert km(0, 29.5, 106.5, 29.5) == km("x", 29.5, 106.5, 29.5) == 100.0
    assert value(spark, fn.site_distance("NULL", "1", "1", "1")) == 100.0


def test_times(spark):
    assert value(spark, fn.ms_from_text("'1970-01-01 00:00:01.999'")) == 1000
    assert value(spark, fn.ms_from_compact("'19700101000001'")) == 1000
    assert value(spark, fn.compact_from_ms("1000L")) == "19700101000001"
    assert value(spark, fn.compact_from_ms("-1L")) == "0" * 14
    assert value(spark, fn.month_from_ms("1000L")) == "197001"


def test_keys(spark):
    assert value(spark, fn.station_route_id("'0102'")) == "0" * 14 + "01"
    assert value(spark, fn.station_route("'0102'")) == "0" * 6 + "01"
    assert value(spark, fn.station_site("'0102'")) == "0" * 4 + "02"
    assert value(spark, fn.station_site_id("'0102'")) == "0" * 12 + "0102"
    assert [value(spark, fn.bus_direction(t)) for t in ("'上行'", "'下行'", "NULL")] == ["0", "1", "1"]
    assert value(spark, fn.person_key("'123'")) == "00000123"
    texts = ("'abcdefghijklmnopqrst'", "'short'", "CAST(NULL AS STRING)")
    assert [value(spark, fn.reserved_field(t)) for t in texts] == ["qr", "00", "00"]
    assert value(spark, fn.rail_card("'9123'")) == "0" * 12 + "9123"


def test_times_with_one_digit_and_wide_keys_are_kept(spark):
    feed = raw(spark, TAPS_RAW, tap("1", tap_time="2024-1-1 0:0:1.5"), tap("1", vehicle="123456789"), tap("1", vehicle="123456780"))
    rows = cleaning.clean_taps(feed).collect()
    assert [r.ts_ms for r in rows] == [DAY_MS + 1000] * 3
    assert sorted(r.vehicle for r in rows) == ["00000007", "123456780", "123456789"]


def test_records_without_a_card_are_counted(spark):
    taps = raw(spark, TAPS_RAW, tap("1"), tap("1", card=None), tap("1", card=" "), tap("1", tap_time="soon"), tap("1", route="123456789"))
    gps = raw(spark, GPS_RAW, {"vehicle": "1", "gps_time": "2024-01-01 0:00:03", "site": "4"}, {"vehicle": "1", "gps_time": "", "site": "4"})
    assert cleaning.clean_taps(taps).count() == 2
    found = {r.feed: tuple(r)[1:] for r in cleaning.feed_rejects(taps, gps).collect()}
    assert found == {"taps": (5, 0, 1, 2, 0, 1, 0), "gps": (2, 0, 1, 0, 0, 0, 0)}  # rows, rejected lines (none without `line`), ...


def test_day_of_each_file(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        rows = raw(spark, TAPS_RAW, tap("1", tap_time=f"{day} 23:50:00"), tap("1", tap_time="2024-01-03 00:20:00"))
        rows.coalesce(1).write.option("header", True).option("sep", "\t").csv(f"{tmp_path}/{day}")
    feed = spark.read.option("header", True).option("sep", "\t").csv([f"{tmp_path}/2024-01-01", f"{tmp_path}/2024-01-02"])
    taps = cleaning.clean_taps(feed, day="regexp_extract(_metadata.file_path, '[0-9]{4}-[0-9]{2}-[0-9]{2}', 0)")
    assert sorted(str(r.service_date) for r in taps.collect()) == ["2024-01-01"] * 2 + ["2024-01-02"] * 2
