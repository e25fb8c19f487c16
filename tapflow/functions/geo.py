"""Distance between two stops, as SQL text."""

EARTH_RADIUS_KM = 6378.137
UNKNOWN_KM = 100.0


def site_distance(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Kilometres to two places (half up), `2 R sin(sqrt(haversine))`.

    The outer sine is part of the definition (an arc sine would give the great circle); below a
    few hundred kilometres both agree to the last digit kept. A zero, missing or unreadable
    coordinate gives `UNKNOWN_KM`.
    """
    x1, y1, x2, y2 = (f"try_cast({c} AS double)" for c in (lon1, lat1, lon2, lat2))
    haversine = f"""power(sin((radians({y1}) - radians({y2})) / 2), 2)
        + cos(radians({y1})) * cos(radians({y2})) * power(sin((radians({x1}) - radians({x2})) / 2), 2)"""
    return f"""CASE WHEN {x1} != 0 AND {y1} != 0 AND {x2} != 0 AND {y2} != 0
        THEN round({2 * EARTH_RADIUS_KM}D * sin(sqrt({haversine})), 2) ELSE {UNKNOWN_KM}D END"""
