"""Text <-> epoch milliseconds, as SQL text to put in `selectExpr` or `F.expr`.

Times stay `bigint` ms inside the engine; text only at the edges. All conversions use the session time
zone (`spark.sql.session.timeZone`). Unreadable text gives NULL rather than an error, so that rejects
can be counted.
"""

TEXT_PATTERN = "yyyy-M-d H:m:s"
TEXT_TIME = r"^\\s*(\\d{1,4}-\\d{1,2}-\\d{1,2} \\d{1,2}:\\d{1,2}:\\d{1,2})"
COMPACT_PATTERN = "yyyyMMddHHmmss"
NO_TIME = "0" * 14
NO_MONTH = "0" * 6


def ms_from_text(text: str) -> str:
    """`yyyy-MM-dd HH:mm:ss[.fraction]` to epoch ms; fields may have one digit, what follows the seconds is ignored."""
    return f"unix_millis(try_to_timestamp(nullif(regexp_extract({text}, '{TEXT_TIME}', 1), ''), '{TEXT_PATTERN}'))"


def ms_from_compact(text: str) -> str:
    """`yyyyMMddHHmmss` to epoch ms."""
    return f"unix_millis(try_to_timestamp({text}, '{COMPACT_PATTERN}'))"


def compact_from_ms(ms: str) -> str:
    """Epoch ms to `yyyyMMddHHmmss`; times before 1970 print as fourteen zeros."""
    shown = f"date_format(timestamp_millis({ms}), '{COMPACT_PATTERN}')"
    return f"IF({ms} < 0, '{NO_TIME}', {shown})"


def month_from_ms(ms: str) -> str:
    """Epoch ms to `yyyyMM`; times before 1970 print as six zeros."""
    return f"IF({ms} < 0, '{NO_MONTH}', date_format(timestamp_millis({ms}), 'yyyyMM'))"


def service_day(ms: str) -> str:
    """Calendar day a record belongs to."""
    return f"to_date(timestamp_millis({ms}))"
