"""Fixed-width keys, as SQL text.

Zero padding makes text order equal numeric order on stop ordinals.
"""

UP_TEXT = "上行"
UP, DOWN, RAIL = "0", "1", "2"
NO_VEHICLE = "00000000"


VEHICLE, ROUTE, SITE, TYPE = 8, 8, 6, 2  # widths


def padded(text: str, width: int) -> str:
    """Zeros in front up to `width`; what is wider stays whole, so that no two keys fall together."""
    return f"lpad({text}, greatest(length({text}), {width}), '0')"


def pad_vehicle(text: str) -> str:
    return padded(text, VEHICLE)


def pad_route(text: str) -> str:
    return padded(text, ROUTE)


def pad_site(text: str) -> str:
    return padded(text, SITE)


def pad_type(text: str) -> str:
    return padded(text, TYPE)


def no_card(text: str) -> str:
    """Whether a record names no card: it can't be told from other riders' then."""
    return f"coalesce(trim({text}), '') = ''"


def rail_card(text: str) -> str:
    """The last sixteen characters of a rail ticket number, padded."""
    return f"lpad(right({text}, 16), 16, '0')"


def person_key(card: str) -> str:
    """Characters 9 to 16 of the card number identify the card holder on bus and rail alike."""
    return f"substr(lpad({card}, 16, '0'), 9, 8)"


def station_route_id(code: str) -> str:
    """Sixteen wide: the two digits of the line."""
    return f"lpad(substr({code}, 1, 2), 16, '0')"


def station_route(code: str) -> str:
    return f"lpad(substr({code}, 1, 2), 8, '0')"


def station_site(code: str) -> str:
    """Six wide: the two digits of the stop."""
    return f"lpad(substr({code}, 3, 2), 6, '0')"


def station_site_id(code: str) -> str:
    return f"lpad({code}, 16, '0')"


def bus_direction(text: str) -> str:
    """`0` for the up direction, `1` for any other text, a missing one included."""
    return f"IF({text} <=> '{UP_TEXT}', '{UP}', '{DOWN}')"


def reserved_field(text: str) -> str:
    """Characters 17 and 18 of a gate record's reserved text, `00` where it is shorter or missing."""
    return f"IF(length({text}) >= 18, substr({text}, 17, 2), '00')"
