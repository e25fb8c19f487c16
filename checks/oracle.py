"""The queries of `__spark_entry__` once more, as SQL for DuckDB over the same tables.

Each step is a named block; `sql(...)` puts the blocks a query needs in front of its SELECT. The blocks
start from `events` and `part` and do not pass through text times, so that parsing is checked as well.
"""

from __future__ import annotations

START = 1704067200000


def _events(squeeze: int) -> str:
    return f"""
    SELECT user_id, event_type, value, json_extract_string(props, '$.k')::BIGINT AS k,
           {START} + (epoch_us(ts) // 1000 - {START}) // {squeeze} AS t
    FROM events"""


def _pad(text: str, width: int) -> str:
    return f"lpad(({text})::VARCHAR, {width}, '0')"


def _time(ms: str, pattern: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '{pattern}')"


def _day(ms: str) -> str:
    return f"make_timestamp(({ms}) * 1000)::DATE::VARCHAR"


# Same formula as the engine's: 2 R sin(sqrt(haversine)), two places, 100 where a coordinate is 0.
def _km(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return f"""CASE WHEN {lon1} <> 0 AND {lat1} <> 0 AND {lon2} <> 0 AND {lat2} <> 0 THEN
        round(2 * 6378.137::DOUBLE * sin(sqrt(pow(sin((radians({lat1}) - radians({lat2})) / 2), 2)
          + cos(radians({lat1})) * cos(radians({lat2}))
            * pow(sin((radians({lon1}) - radians({lon2})) / 2), 2))), 2)
        ELSE 100.0::DOUBLE END"""


SITE = ["route_id", "route", "site_id", "site", "site_name", "direction", "lon", "lat"]
PLACE = ["route_id", "route", "site_id", "site", "site_name"]
BOARDED = (
    "service_date, card, person, card_type, ts_ms, vehicle, route_id, route, site_id, site, "
    "site_name, direction, lon, lat, change_type, fare_due, fare_paid, run"
)
LEG = (
    "service_date, person, card, on_ms, vehicle, on_route_id, on_route, on_site_id, on_site, "
    "on_site_name, direction, on_lon, on_lat, off_ms, off_route_id, off_route, off_site_id, "
    "off_site, off_site_name, off_lon, off_lat, change_type, fare_due, fare_paid"
)
BOARDING_ORDER = (
    "ts_ms NULLS FIRST, card NULLS FIRST, route NULLS FIRST, site NULLS FIRST, "
    "direction NULLS FIRST, vehicle NULLS FIRST, site_id NULLS FIRST, fare_due NULLS FIRST, "
    "fare_paid NULLS FIRST"
)
LEG_ORDER = (
    "on_ms NULLS FIRST, card NULLS FIRST, on_route NULLS FIRST, on_site NULLS FIRST, "
    "direction NULLS FIRST, vehicle NULLS FIRST, on_site_id NULLS FIRST, off_ms NULLS FIRST, "
    "off_site_id NULLS FIRST, fare_due NULLS FIRST, fare_paid NULLS FIRST"
)
PAIR = [
    "on_ms", "off_ms", "vehicle", "on_route_id", "off_route_id", "on_site_id", "off_site_id",
    "direction", "on_site_name", "off_site_name",
]


#: The feeds as written by `event_tables.write_feed_files`: view, columns in file order, kept columns, separator
#: (code point), fields of a cut line, time column, card column.
def _feed_files() -> dict[str, tuple]:
    from tapflow.schemas import GATES_KEPT, GATES_RAW, GPS_RAW, TAPS_RAW

    return {
        "taps": ("taps_raw", TAPS_RAW, TAPS_RAW, 9, 5, "tap_time", "card"),
        "gates": ("gates_raw", GATES_RAW, GATES_KEPT, 44, 20, "time", "card"),
        "gps": ("gps_raw", GPS_RAW, GPS_RAW, 44, 3, "gps_time", "card"),
    }


FEED_FILES = _feed_files()


def raw_columns(view: str) -> set[str]:
    """Columns of the raw feed views below."""
    from tapflow.schemas import GATES_KEPT, GPS_RAW, TAPS_RAW

    return set({"taps_raw": TAPS_RAW, "gates_raw": GATES_KEPT, "gps_raw": GPS_RAW}[view])


def feed_rejects_sql() -> str:
    """Counts of the read feeds: rejected lines, and among the others unreadable times, missing cards, wide keys."""
    from tapflow.functions.keys import ROUTE, SITE, VEHICLE

    def part(feed: str, time: str, card: str, wide: tuple[str, str, str]) -> str:
        return f"""SELECT '{feed}' AS feed, count(*) AS rows, count_if(line IS NOT NULL) AS rejected,
                  count_if(line IS NULL AND {time}) AS bad_time, count_if(line IS NULL AND {card}) AS bad_card,
                  {wide[0]} AS wide_vehicle, {wide[1]} AS wide_route, {wide[2]} AS wide_site FROM {feed}_read"""

    def wide(column: str, width: int) -> str:
        return f"count_if(line IS NULL AND length({column}) > {width})"

    zero = "0::BIGINT"
    return " UNION ALL ".join([
        part("taps", "tap_time = 'not a time'", "coalesce(trim(card), '') = ''",
             (wide("vehicle", VEHICLE), wide("route", ROUTE), wide("site", SITE))),
        part("gps", "gps_time = 'not a time'", "false", (wide("vehicle", VEHICLE), zero, wide("site", SITE))),
        part("gates", "time = 'not a time'", "coalesce(trim(card), '') = ''", (zero, zero, zero)),
    ])


def blocks(squeeze: int = 60, rail: bool = True, day_starts_ms: int = 0) -> dict[str, str]:
    """All named blocks in dependency order."""
    b: dict[str, str] = {}
    b["ev"] = _events(squeeze)

    # Raw feeds, as text.
    b["taps_raw"] = f"""
    SELECT {_time('t', '%Y-%m-%d %H:%M:%S')} || '.' || {_pad('t % 1000', 3)} AS tap_time,
           NULL::VARCHAR AS x1, {_pad('user_id', 16)} AS card, (k % 16)::VARCHAR AS card_type,
           floor(value * 100)::BIGINT::VARCHAR AS fare_due,
           floor(value * 100)::BIGINT::VARCHAR AS fare_paid, '0' AS change_type,
           NULL::VARCHAR AS x5, NULL::VARCHAR AS x6, (k % 10)::VARCHAR AS vehicle,
           (1 + k % 5)::VARCHAR AS route, '0' AS site, t
    FROM ev WHERE event_type = 'purchase'"""
    b["gates_raw"] = f"""
    SELECT '8600' || {_pad('user_id', 16)} AS card, '1' AS card_type,
           {_time('t', '%Y%m%d')} AS date, {_time('t', '%H%M%S')} AS time,
           {_pad('91 + k // 20', 2)} || {_pad('1 + k % 20', 2)} AS station,
           NULL::VARCHAR AS last_station,
           CASE event_type WHEN 'signup' THEN '21' ELSE '22' END AS in_out,
           NULL::VARCHAR AS rsv_buf, floor(value * 100)::BIGINT::VARCHAR AS txn_amt,
           k::VARCHAR AS reward_amt, t
    FROM ev WHERE event_type IN ('signup', 'error')"""
    b["gps_raw"] = f"""
    SELECT NULL::VARCHAR AS card, (user_id % 10)::VARCHAR AS vehicle,
           {_time('t', '%Y-%m-%d %H:%M:%S')} AS gps_time, NULL::VARCHAR AS x4, NULL::VARCHAR AS x5,
           NULL::VARCHAR AS x6,
           greatest(0, 1 + (t // 180000) % 20 - CASE WHEN k % 10 = 0 THEN 2 ELSE 0 END)::VARCHAR
             AS site, t
    FROM ev WHERE event_type IN ('view', 'click')"""
    for feed, (raw, names, kept, sep, cut, time, card) in FEED_FILES.items():
        fields = [f"coalesce({c}, '')" if c in raw_columns(raw) else "''" for c in names]
        joined = lambda xs: f"concat_ws(chr({sep}), {', '.join(xs)})"
        b[f"{feed}_lines"] = f"""
        SELECT *, substr(md5(line_text), 1, 1) AS digit, {joined(fields[:cut])} AS cut_text
        FROM (SELECT *, {joined(fields)} AS line_text FROM {raw})"""
        b[f"{feed}_read"] = f"""
        SELECT {', '.join(
            f"CASE WHEN digit = '0' THEN NULL WHEN digit = '1' THEN 'not a time' ELSE {c} END AS {c}" if c == time else
            f"CASE WHEN digit IN ('0', '2') THEN NULL ELSE {c} END AS {c}" if c == card else
            f"CASE WHEN digit = '0' THEN NULL ELSE {c} END AS {c}" if c in raw_columns(raw) else f"NULL::VARCHAR AS {c}"
            for c in kept)}, CASE WHEN digit = '0' THEN cut_text END AS line
        FROM {feed}_lines"""
    b["parts"] = "SELECT p_partkey AS p, p_partkey // 20 AS r, p_partkey % 20 AS n FROM part"
    b["bus_sites"] = f"""
    SELECT {_pad('1 + r', 16)} AS route_id, {_pad('1 + r', 8)} AS route,
           {_pad('100 * (1 + r) + 1 + n', 16)} AS site_id, {_pad('1 + n', 6)} AS site,
           'S' || ((p // 120) * 40 + p % 40) AS site_name,
           CASE WHEN r < 5 OR r % 2 = 0 THEN '0' ELSE '1' END AS direction,
           (106500 + 6 * n + 200 * (r // 500))::DOUBLE / 1000 AS lon,
           (29500 + 4 * (r % 500))::DOUBLE / 1000 AS lat
    FROM parts"""
    b["stations"] = "SELECT DISTINCT p % 100 AS p FROM parts"
    b["rail_sites"] = f"""
    SELECT {_pad('91 + p // 20', 16)} AS route_id, {_pad('91 + p // 20', 8)} AS route,
           {_pad('100 * (91 + p // 20) + 1 + p % 20', 16)} AS site_id,
           {_pad('1 + p % 20', 6)} AS site, 'S' || (p % 40) || 'R' AS site_name,
           '2' AS direction, (106500 + 6 * (p % 20))::DOUBLE / 1000 AS lon,
           (29501 + 4 * (p // 20))::DOUBLE / 1000 AS lat
    FROM stations"""
    b["all_sites"] = "SELECT * FROM bus_sites UNION ALL SELECT * FROM rail_sites"

    # Cleaned feeds.
    b["taps"] = f"""
    SELECT {_day(f't - {day_starts_ms}')} AS service_date, card, substr(card, 9, 8) AS person,
           {_pad('card_type', 2)} AS card_type, t // 1000 * 1000 AS ts_ms,
           {_pad('vehicle', 8)} AS vehicle, {_pad('route', 8)} AS route, {_pad('site', 6)} AS site,
           change_type,
           CASE WHEN card_type IN ('3', '14', '15') THEN 0 ELSE fare_due::BIGINT END AS fare_due,
           CASE WHEN card_type IN ('3', '14', '15') THEN 0 ELSE fare_paid::BIGINT END AS fare_paid
    FROM taps_raw"""
    b["gates"] = f"""
    SELECT {_day(f't - {day_starts_ms}')} AS service_date, right(card, 16) AS card,
           substr(right(card, 16), 9, 8) AS person, '01' AS card_type, t // 1000 * 1000 AS ts_ms,
           station, in_out, txn_amt::BIGINT + reward_amt::BIGINT AS fare_due,
           txn_amt::BIGINT AS fare_paid
    FROM gates_raw"""
    b["gps"] = f"""
    SELECT {_day(f't - {day_starts_ms}')} AS service_date, {_pad('vehicle', 8)} AS vehicle, t // 1000 * 1000 AS ts_ms,
           {_pad('site', 6)} AS site
    FROM gps_raw WHERE site <> '0'"""

    # Vehicle traces.
    b["gaps"] = """
    SELECT DISTINCT ON (service_date, vehicle, site, ts_ms) *,
           ts_ms - lag(ts_ms) OVER (PARTITION BY service_date, vehicle, site ORDER BY ts_ms) AS gap
    FROM (SELECT DISTINCT * FROM gps)"""
    b["dwell"] = """
    SELECT service_date, vehicle, ts_ms, site FROM gaps WHERE gap IS NULL OR gap > 600000"""
    b["steps"] = """
    SELECT *, lag(site) OVER w AS before, lead(site) OVER w AS after, row_number() OVER w AS i,
           count(*) OVER (PARTITION BY service_date, vehicle) AS n
    FROM dwell WINDOW w AS (PARTITION BY service_date, vehicle ORDER BY ts_ms, site)"""
    b["runs"] = """
    SELECT service_date, vehicle, ts_ms, site,
           (sum(CASE WHEN before IS NULL OR before < site THEN 0
                     WHEN i - 1 < n - 2 AND before::BIGINT + 1 = after::BIGINT THEN 0
                     ELSE 1 END)
             OVER (PARTITION BY service_date, vehicle ORDER BY ts_ms, site
                   ROWS UNBOUNDED PRECEDING))::BIGINT AS run
    FROM steps"""

    # Boarding.
    b["tap_fix"] = """
    SELECT t.*, r.ts_ms AS fix_ms, r.site AS fix_site, r.run
    FROM taps t ASOF JOIN runs r
      ON t.service_date = r.service_date AND t.vehicle = r.vehicle AND t.ts_ms > r.ts_ms"""
    b["last_fix"] = """
    SELECT service_date, card, person, card_type, ts_ms, vehicle, route, fix_site AS site,
           change_type, fare_due, fare_paid, fix_ms, run
    FROM tap_fix
    QUALIFY row_number() OVER (
      PARTITION BY service_date, card, ts_ms
      ORDER BY fix_ms DESC, fix_site DESC, run DESC, person DESC, card_type DESC, vehicle DESC,
               route DESC, change_type DESC, fare_due DESC, fare_paid DESC) = 1"""
    b["boarded"] = f"""
    SELECT {BOARDED} FROM last_fix LEFT JOIN bus_sites USING (route, site)"""

    # Rail.
    b["located"] = """
    SELECT g.*, s.site_name, s.lon, s.lat
    FROM gates g JOIN rail_sites s ON g.station = substr(s.site_id, 13, 4)"""
    fields = ["card", "ts_ms", "in_out", "station", "site_name", "lon", "lat", "fare_due", "fare_paid"]
    leads = ", ".join(f"lead({c}) OVER w AS {c}_next" for c in fields)
    b["gate_pairs"] = f"""
    SELECT *, {leads} FROM located
    WINDOW w AS (PARTITION BY service_date, person ORDER BY ts_ms, card, in_out, station, card_type,
                 fare_due, fare_paid, site_name, lon, lat)"""
    b["rail_legs"] = """
    SELECT service_date, person, greatest(card, card_next) AS card, ts_ms AS on_ms,
           '00000000' AS vehicle, lpad(station[1:2], 16, '0') AS on_route_id,
           lpad(station[1:2], 8, '0') AS on_route, lpad(station, 16, '0') AS on_site_id,
           lpad(station[3:4], 6, '0') AS on_site, site_name AS on_site_name, '2' AS direction,
           lon AS on_lon, lat AS on_lat, ts_ms_next AS off_ms,
           lpad(station_next[1:2], 16, '0') AS off_route_id,
           lpad(station_next[1:2], 8, '0') AS off_route,
           lpad(station_next, 16, '0') AS off_site_id, lpad(station_next[3:4], 6, '0') AS off_site,
           site_name_next AS off_site_name, lon_next AS off_lon, lat_next AS off_lat,
           '' AS change_type, fare_due_next AS fare_due, fare_paid_next AS fare_paid, card_type
    FROM gate_pairs WHERE in_out = '21' AND in_out_next = '22'"""

    # Chain.
    rail_boardings = """
    UNION ALL
    SELECT service_date, card, person, card_type, on_ms, vehicle, on_route_id, on_route, on_site_id,
           on_site, on_site_name, direction, on_lon, on_lat, change_type, fare_due, fare_paid, NULL
    FROM rail_legs""" if rail else ""
    b["boardings"] = f"SELECT {BOARDED} FROM boarded {rail_boardings}"
    b["links"] = f"""
    SELECT *, lead(route) OVER w AS route_next, lead(site) OVER w AS site_next,
           lead(ts_ms) OVER w AS ts_next, first_value(route) OVER w AS route_first,
           first_value(site) OVER w AS site_first,
           row_number() OVER w = count(*) OVER (PARTITION BY service_date, person) AS is_last
    FROM boardings
    WINDOW w AS (PARTITION BY service_date, person ORDER BY {BOARDING_ORDER})"""
    b["chain"] = f"""
    SELECT {BOARDED}, CASE WHEN is_last THEN route_first ELSE route_next END AS target_route,
           CASE WHEN is_last THEN site_first ELSE site_next END AS target_site,
           CASE WHEN is_last THEN 5000000000000 ELSE ts_next END AS next_ms,
           count(*) OVER (PARTITION BY service_date, person, ts_ms) > 1 AS shared_row
    FROM links WHERE direction IS DISTINCT FROM '2'"""

    # Near stops, by comparing every stop with the stops of the bands of latitude around it.
    left = ", ".join(f"a.{c}" for c in SITE)
    right = ", ".join(f"b.{c} AS {c}2" for c in SITE)
    source = "all_sites" if rail else "bus_sites"
    b["site_pairs"] = f"""
    SELECT {left}, {right}
    FROM (SELECT DISTINCT *, unnest([floor(lat * 50) - 1, floor(lat * 50), floor(lat * 50) + 1])
            AS band FROM {source}) a
    JOIN (SELECT DISTINCT *, floor(lat * 50) AS band FROM bus_sites) b
      ON a.band = b.band AND abs(a.lon - b.lon) < 0.05
    UNION
    SELECT {left}, {right}
    FROM (SELECT DISTINCT * FROM {source}) a JOIN (SELECT DISTINCT * FROM bus_sites) b
      ON a.site_name = b.site_name"""
    b["near"] = f"""
    SELECT * FROM (SELECT *, {_km('lon', 'lat', 'lon2', 'lat2')} AS distance FROM site_pairs)
    WHERE (distance <= 1.0 AND distance <> 0) OR site_name = site_name2"""

    # Alighting.
    b["cand"] = """
    SELECT c.*, n.site AS near_site, n.route_id2, n.route2, n.site_id2, n.site2, n.site_name2,
           n.lon2, n.lat2, coalesce(n.distance, 0) AS distance
    FROM chain c LEFT JOIN near n
      ON c.target_route = n.route AND c.target_site >= n.site AND c.route = n.route2
     AND c.direction = n.direction2 AND c.site < n.site2"""
    b["hits"] = """
    SELECT c.*, f.ts_ms AS off_ms, f.site AS off_site
    FROM cand c JOIN runs f
      ON c.service_date = f.service_date AND c.vehicle = f.vehicle AND c.run = f.run
     AND f.ts_ms < c.next_ms AND f.site <= c.site2
    WHERE c.site_id2 IS NOT NULL AND c.site_id <= c.site_id2"""
    b["resolved"] = """
    SELECT service_date, card, person, card_type, ts_ms, vehicle, route_id, route, site_id, site,
           site_name, direction, lon, lat, change_type, fare_due, fare_paid, off_site, off_ms,
           distance, NULL::BIGINT AS weight
    FROM hits
    QUALIFY row_number() OVER (
      PARTITION BY service_date, person, ts_ms
      ORDER BY distance, site2, near_site, site_id2, card, route, site, direction, vehicle, site_id,
               fare_due, fare_paid, off_ms DESC, off_site DESC) = 1"""
    b["weights"] = """
    SELECT service_date, route, off_site AS site, count(*) AS weight FROM resolved GROUP BY ALL"""
    b["open_taps"] = """
    SELECT c.* FROM chain c ANTI JOIN resolved r USING (service_date, person, ts_ms)
    QUALIFY row_number() OVER (
      PARTITION BY service_date, person, ts_ms
      ORDER BY card, route, site, direction NULLS FIRST, vehicle, site_id NULLS FIRST, fare_due,
               fare_paid) = 1"""
    b["downstream"] = """
    SELECT o.service_date, o.person, o.ts_ms, w.site AS w_site, w.weight,
           (SELECT max(f.ts_ms) FROM runs f
            WHERE f.service_date = o.service_date AND f.vehicle = o.vehicle AND f.run = o.run
              AND f.ts_ms < o.next_ms AND f.site = w.site) AS w_ms
    FROM open_taps o JOIN weights w
      ON o.service_date = w.service_date AND o.route = w.route AND o.site < w.site"""
    b["draws"] = """
    SELECT *, (sum(weight) OVER (PARTITION BY service_date, person, ts_ms ORDER BY w_site))::DOUBLE
                / (sum(weight) OVER (PARTITION BY service_date, person, ts_ms))::DOUBLE AS share,
           ('0x' || substr(md5(person || ts_ms::VARCHAR), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE
             AS draw
    FROM downstream WHERE w_ms IS NOT NULL"""
    b["picks"] = """
    SELECT service_date, person, ts_ms, w_site, w_ms, weight FROM draws WHERE share > draw
    QUALIFY row_number() OVER (PARTITION BY service_date, person, ts_ms ORDER BY w_site) = 1"""
    b["beyond"] = """
    SELECT o.service_date, o.person, o.ts_ms, max(f.ts_ms) AS b_ms, arg_max(f.site, f.ts_ms) AS b_site
    FROM open_taps o JOIN runs f
      ON f.service_date = o.service_date AND f.vehicle = o.vehicle AND f.run = o.run
     AND f.ts_ms < o.next_ms AND f.site > o.site
    GROUP BY ALL"""
    b["fallback"] = """
    SELECT o.service_date, o.card, o.person, o.card_type, o.ts_ms, o.vehicle, o.route_id, o.route,
           o.site_id, o.site, o.site_name, o.direction, o.lon, o.lat, o.change_type, o.fare_due,
           o.fare_paid, coalesce(p.w_site, y.b_site, '000000') AS off_site,
           coalesce(p.w_ms, y.b_ms, 2222222222222) AS off_ms, NULL::DOUBLE AS distance, p.weight
    FROM open_taps o
    SEMI JOIN downstream d USING (service_date, person, ts_ms)
    LEFT JOIN picks p USING (service_date, person, ts_ms)
    LEFT JOIN beyond y USING (service_date, person, ts_ms)"""
    b["rides"] = "SELECT * FROM resolved UNION ALL SELECT * FROM fallback"

    # Legs.
    def enriched(join: str) -> str:
        on = ", ".join(f"r.{c} AS on_{c}" for c in PLACE)
        return f"""
    SELECT r.service_date, r.person, r.card, r.ts_ms AS on_ms, r.vehicle, {on}, r.direction,
           r.lon AS on_lon, r.lat AS on_lat, r.off_ms, s.route_id AS off_route_id,
           r.route AS off_route, s.site_id AS off_site_id, r.off_site, s.site_name AS off_site_name,
           s.lon AS off_lon, s.lat AS off_lat, r.change_type, r.fare_due, r.fare_paid
    FROM rides r {join} bus_sites s ON r.route = s.route AND r.off_site = s.site"""

    b["enrich_inner"] = enriched("JOIN")
    b["enrich_left"] = enriched("LEFT JOIN")
    with_rail = f"UNION ALL SELECT {LEG} FROM rail_legs" if rail else ""
    b["legs"] = f"SELECT {LEG} FROM enrich_inner {with_rail}"
    befores = ", ".join(f"lag({c}) OVER w AS pre_{c}" for c in ["card", *PAIR])
    b["leg_pairs"] = f"""
    SELECT *, row_number() OVER w AS i, {befores} FROM legs
    WINDOW w AS (PARTITION BY service_date, person ORDER BY {LEG_ORDER})"""
    b["leg_moves"] = """
    SELECT *, i > 1 AND on_ms - pre_on_ms <= 3600000
              AND on_site_id IS DISTINCT FROM pre_on_site_id AS moves,
           coalesce(direction IN ('0', '1'), false) AS bus,
           coalesce(pre_direction IN ('0', '1'), false) AS pre_bus
    FROM leg_pairs"""
    b["labelled"] = f"""
    SELECT * EXCLUDE (moves, bus, pre_bus) REPLACE (
      CASE WHEN NOT moves THEN '0' WHEN pre_bus AND bus THEN '3' WHEN pre_bus THEN '1'
           WHEN bus THEN '2' ELSE '4' END AS change_type)
    FROM (SELECT {LEG}, moves, bus, pre_bus FROM leg_moves)"""
    pres = ", ".join(f"pre_{c}" for c in PAIR)
    currs = ", ".join(f"{c} AS curr_{c}" for c in PAIR)
    b["transfers"] = f"""
    SELECT service_date, person, CASE WHEN pre_bus AND NOT bus THEN card ELSE pre_card END AS card,
           {pres}, {currs}
    FROM leg_moves WHERE moves AND on_ms > pre_off_ms"""
    b["walk"] = """
    SELECT service_date, person, i, on_ms AS h_ms, on_site_id AS h_site, i AS head
    FROM leg_pairs WHERE i = 1
    UNION ALL
    SELECT l.service_date, l.person, l.i,
           CASE WHEN l.on_ms - w.h_ms <= 3600000 AND l.on_site_id IS DISTINCT FROM w.h_site
                THEN w.h_ms ELSE l.on_ms END,
           CASE WHEN l.on_ms - w.h_ms <= 3600000 AND l.on_site_id IS DISTINCT FROM w.h_site
                THEN w.h_site ELSE l.on_site_id END,
           CASE WHEN l.on_ms - w.h_ms <= 3600000 AND l.on_site_id IS DISTINCT FROM w.h_site
                THEN w.head ELSE l.i END
    FROM walk w JOIN leg_pairs l
      ON l.service_date = w.service_date AND l.person = w.person AND l.i = w.i + 1"""
    b["spans"] = """
    SELECT service_date, person, head, max(i) AS tail FROM walk GROUP BY ALL"""
    ons = ", ".join(f"h.on_{c}" for c in ["ms", *PLACE, "lon", "lat"])
    offs = ", ".join(f"l.off_{c}" for c in ["ms", *PLACE, "lon", "lat"])
    b["journeys"] = f"""
    SELECT s.service_date, s.person, h.card, {ons}, {offs},
           (h.fare_due + CASE WHEN tail > head THEN l.fare_due ELSE 0 END)::BIGINT AS fare_due,
           (h.fare_paid + CASE WHEN tail > head THEN l.fare_paid ELSE 0 END)::BIGINT AS fare_paid
    FROM spans s
    JOIN leg_pairs h ON h.service_date = s.service_date AND h.person = s.person AND h.i = s.head
    JOIN leg_pairs l ON l.service_date = s.service_date AND l.person = s.person AND l.i = s.tail"""
    return b


RECURSIVE = {"walk"}


def _needed(all_blocks: dict[str, str], text: str) -> list[str]:
    """Blocks that `text` names, directly or through others, in their order of definition."""
    import re

    words = set(re.findall(r"[a-z_0-9]+", text))
    found: set[str] = set()
    todo = [n for n in all_blocks if n in words]
    while todo:
        name = todo.pop()
        if name in found:
            continue
        found.add(name)
        inner = set(re.findall(r"\b(?:FROM|JOIN)\s+(?:\()?([a-z_0-9]+)", all_blocks[name]))
        todo += [n for n in all_blocks if n in inner and n not in found]
    return [n for n in all_blocks if n in found]


def sql(select: str, squeeze: int = 60, rail: bool = True, day_starts_ms: int = 0) -> str:
    all_blocks = blocks(squeeze, rail, day_starts_ms)
    import re

    direct = " ".join(re.findall(r"\b(?:FROM|JOIN)\s+(?:\()?([a-z_0-9]+)", select))
    parts = [
        f"{name} AS {'' if name in RECURSIVE else 'MATERIALIZED '}({all_blocks[name]})"
        for name in _needed(all_blocks, direct)
    ]
    head = "WITH RECURSIVE " + ",\n".join(parts) if parts else ""
    return f"{head}\n{select}"
