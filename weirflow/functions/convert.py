r"""Forgiving text conversions.

Each function takes the SQL text of a string expression and returns the SQL
text of the converted value, for use in ``F.expr`` or ``spark.sql``. None of
them raises under ANSI mode or depends on the session time zone, and all but
``jdbc_timestamp`` stay inside whole-stage code generation.

Every part is itself safe for any text, because Spark may evaluate a part that
occurs in several conditions ahead of them. Patterns end in ``\z``, because ``$`` would also match before a final line
separator.
"""

from __future__ import annotations

# Below this an all-digit date is epoch days, else epoch millis.
EPOCH_DAYS_LIMIT = 100_000
MILLIS_PER_DAY = 86_400_000
# The last millisecond whose microseconds still fit in 64 bits.
MAX_EPOCH_MILLIS = 9_223_372_036_854_775

# Accepted syntax.
DIGITS = r"r'^[0-9]+\z'"
DATETIME = r"r'^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z'"
DECIMAL = r"r'^[+-]?[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?\z'"
PLAIN_DECIMAL = r"r'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z'"
SHORT_DECIMAL = r"r'^[+-]?[0-9]{1,7}(\.[0-9]{1,2})?\z'"
EXPONENT = r"r'[eE]([+-]?[0-9]+)\z'"
JDBC_TIMESTAMP = (
    r"r'^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} "
    r"[0-9]{1,5}:[0-9]{1,5}:[0-9]{1,5}(\.[0-9]{1,9})?\z'"
)

# Every character up to U+0020: what counts as blank at the ends of a value.
BLANKS = "".join(f"\\u{code:04x}" for code in range(0x21))

ZERO = "CAST(0 AS DECIMAL(10,2))"


def java_trim(text: str) -> str:
    """Drop every character up to U+0020 at both ends (blanks, tabs, controls)."""
    return (
        f"IF(left({text}, 1) <= ' ' OR right({text}, 1) <= ' ', "
        f"trim(BOTH '{BLANKS}' FROM {text}), {text})"
    )


def _epoch(number: str) -> str:
    """Epoch days when small, else epoch milliseconds; NULL beyond the range."""
    millis = (
        f"IF({number} < {EPOCH_DAYS_LIMIT}, {number} % {EPOCH_DAYS_LIMIT} * {MILLIS_PER_DAY}L, "
        f"IF({number} <= {MAX_EPOCH_MILLIS}, {number}, NULL))"
    )
    return f"timestampadd(MILLISECOND, {millis}, TIMESTAMP_NTZ '1970-01-01 00:00:00')"


def _lenient_wall_clock(text: str) -> str:
    """For text in the DATETIME form that is no real time: a day up to 31 is
    clamped to the month's last day, and exactly 24:00:00 is the next midnight."""
    month, day, hour, minute, second = (
        f"try_cast(substr({text}, {start}, 2) AS INT)" for start in (6, 9, 12, 15, 18)
    )
    first = f"try_cast(concat(substr({text}, 1, 8), '01') AS DATE)"
    return (
        f"IF({month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31 AND {minute} <= 59 "
        f"AND {second} <= 59 AND ({hour} <= 23 OR substr({text}, 12, 8) = '24:00:00'), "
        f"CAST({first} AS TIMESTAMP_NTZ) + make_dt_interval("
        f"least({day}, day(last_day({first}))) - 1, {hour}, {minute}, "
        f"CAST({second} AS DECIMAL(18,6))), NULL)"
    )


def clean_datetime(text: str) -> str:
    """Bring a date text into the form that :func:`parse_clean_datetime` reads."""
    return f"replace({java_trim(text)}, 'T', ' ')"


def parse_clean_datetime(clean: str) -> str:
    """Nearly every value is a real time and takes the plain cast; only the
    rest pays for the lenient reading."""
    return (
        f"CASE WHEN {clean} RLIKE {DATETIME} THEN IF({clean} >= '0001', "
        f"coalesce(try_cast({clean} AS TIMESTAMP_NTZ), {_lenient_wall_clock(clean)}), NULL) "
        f"WHEN {clean} RLIKE {DIGITS} THEN {_epoch(f'try_cast({clean} AS BIGINT)')} END"
    )


def parse_datetime(text: str) -> str:
    """Text to a zone-less timestamp.

    All digits: epoch days below 100,000, else epoch milliseconds (UTC).
    Otherwise ``yyyy-MM-dd HH:mm:ss``, with ``T`` allowed in place of the blank.
    Anything else is NULL: fractions, zones, bare dates and signs included.
    """
    return parse_clean_datetime(clean_datetime(text))


def _exponent_in_range(text: str) -> str:
    """Whether the exponent, if any, fits in 32 bits."""
    exponent = f"try_cast(regexp_extract({text}, {EXPONENT}, 1) AS BIGINT)"
    return (
        f"IF(contains({text}, 'e') OR contains({text}, 'E'), "
        f"coalesce(abs({exponent}) <= 2147483647, false), true)"
    )


def parse_clean_decimal(clean: str) -> str:
    """:func:`parse_decimal` for text that is already trimmed."""
    return (
        f"CASE WHEN {clean} RLIKE {DECIMAL} THEN "
        f"IF({_exponent_in_range(clean)}, try_cast({clean} AS DECIMAL(10,2)), {ZERO}) "
        f"WHEN {clean} <> '' THEN {ZERO} END"
    )


def parse_decimal(text: str) -> str:
    """Text to DECIMAL(10,2), rounding half up.

    Blank or NULL stays NULL; text that is not a number is 0. A number too
    large for the column is NULL; see :func:`decimal_overflow`.
    """
    return parse_clean_decimal(java_trim(text))


def decimal_overflow(text: str, clean: str) -> str:
    """True for text that, trimmed to ``clean``, is a number too large to store. Up to eight
    characters without an exponent always fit, so most values are neither trimmed nor parsed."""
    return (
        f"(length({text}) > 8 OR contains({text}, 'e') OR contains({text}, 'E')) "
        f"AND {clean} <> '' AND {parse_clean_decimal(clean)} IS NULL"
    )


def jdbc_timestamp(text: str) -> str:
    """JDBC escape text ``yyyy-m-d h:m:s[.f]`` to a zone-less timestamp. Day and
    time parts beyond their range roll over into the next unit."""
    trimmed = java_trim(text)
    year, month, day, hour, minute, second = (f"try_cast(get(parts, {n}) AS INT)" for n in range(6))
    fraction = "try_cast(concat('0.', rpad(get(parts, 6), 6, '0')) AS DECIMAL(18,6))"
    moment = (
        f"IF({month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31 AND {year} >= 1, "
        f"CAST(try_cast(concat_ws('-', {year}, {month}, '1') AS DATE) AS TIMESTAMP_NTZ) + "
        f"make_dt_interval({day} - 1, {hour}, {minute}, "
        f"CAST({second} + coalesce({fraction}, 0) AS DECIMAL(18,6))), NULL)"
    )
    # the lambda splits the text once
    return (
        f"IF({trimmed} RLIKE {JDBC_TIMESTAMP}, "
        f"transform(array(split({trimmed}, '[-: .]')), parts -> {moment})[0], NULL)"
    )


def standard_timestamp(text: str) -> str:
    """:func:`jdbc_timestamp` for its usual form, a real time as ``yyyy-MM-dd HH:mm:ss``; NULL for any other."""
    return f"IF({text} RLIKE {DATETIME} AND {text} >= '1000', try_cast({text} AS TIMESTAMP_NTZ), NULL)"


def plain_decimal(text: str) -> str:
    """Plain decimal text to DECIMAL(10,2); NULL for anything else. No trimming:
    surrounding blanks make the text invalid."""
    return (
        f"IF({text} RLIKE {PLAIN_DECIMAL} AND {_exponent_in_range(text)}, "
        f"try_cast({text} AS DECIMAL(10,2)), NULL)"
    )


def standard_decimal(text: str) -> str:
    """:func:`plain_decimal` for its usual form, up to seven digits and two decimals; NULL for any other."""
    return f"IF({text} RLIKE {SHORT_DECIMAL}, try_cast({text} AS DECIMAL(10,2)), NULL)"
