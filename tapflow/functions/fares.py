"""Fares in whole cents, as SQL text."""

# Card types, as written in the feed, whose holders ride free.
FREE_CARD_TYPES = ["3", "14", "15"]


def amount(text: str) -> str:
    return f"try_cast({text} AS int)"


def free_ride(raw_card_type: str, fare: str) -> str:
    """Nothing is due on a free card. The type is compared as written, before padding."""
    free = ", ".join(f"'{kind}'" for kind in FREE_CARD_TYPES)
    return f"CASE WHEN {raw_card_type} IN ({free}) THEN 0 ELSE {fare} END"


def amount_sum(first: str, second: str) -> str:
    return f"{amount(first)} + {amount(second)}"
