"""Small literal tables."""

from datetime import date

from tapflow.schemas import BOARDED, LEGS

DAY = date(2024, 1, 1)
DAY_MS = 1_704_067_200_000
KINDS = {
    "service_date": "date", "ts_ms": "bigint", "on_ms": "bigint", "off_ms": "bigint",
    "next_ms": "bigint", "lon": "double", "lat": "double", "on_lon": "double", "on_lat": "double",
    "off_lon": "double", "off_lat": "double", "fare_due": "int", "fare_paid": "int", "run": "int",
    "lon2": "double", "lat2": "double", "distance": "double", "weight": "bigint",
    "shared_tap": "boolean",
}


def frame(spark, columns, rows):
    schema = ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def site(n):
    return f"{n:06d}"


def fixes(spark, rows, vehicle="00000001"):
    """rows: (ms, stop)"""
    return frame(
        spark, ["service_date", "vehicle", "ts_ms", "site"],
        [{"service_date": DAY, "vehicle": vehicle, "ts_ms": t, "site": site(s)} for t, s in rows],
    )


def boarding(ts, route, stop, direction="0", person="00000001", **more):
    row = {
        "service_date": DAY, "card": "00000000" + person, "person": person, "card_type": "01",
        "ts_ms": ts, "vehicle": "00000001", "route_id": route, "route": route,
        "site_id": f"{route}{stop}", "site": stop, "site_name": f"name {route} {stop}",
        "direction": direction, "lon": 106.5, "lat": 29.5, "change_type": "", "fare_due": 200,
        "fare_paid": 200, "run": 0,
    }
    return row | more


def boardings(spark, rows):
    return frame(spark, BOARDED, rows)


def leg(on, off, on_stop, off_stop=None, direction="0", person="00000001", fare=0, **more):
    off_stop = off_stop or on_stop
    row = {
        "service_date": DAY, "person": person, "card": "00000000" + person, "on_ms": on,
        "vehicle": "00000001", "on_route_id": "r", "on_route": "r", "on_site_id": on_stop,
        "on_site": on_stop, "on_site_name": on_stop, "direction": direction, "on_lon": 1.0,
        "on_lat": 2.0, "off_ms": off, "off_route_id": "r", "off_route": "r",
        "off_site_id": off_stop, "off_site": off_stop, "off_site_name": off_stop, "off_lon": 3.0,
        "off_lat": 4.0, "change_type": "", "fare_due": fare, "fare_paid": fare,
    }
    return row | more


def legs(spark, rows):
    return frame(spark, LEGS, rows)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
