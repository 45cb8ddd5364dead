"""Text to value and back. Nothing here throws on bad input: bad text becomes null.

Each function takes a column name (or any SQL expression) and gives a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import UNKNOWN_LOCATION

# Only these characters, and readable as a double: decimal or scientific notation. Leaves out
# what a bare cast would also take, such as type suffixes (1.5f) and hex floats.
_PLAIN = r"^\\s*[0-9.eE+-]+\\s*\\z"
_INFINITE = "'inf', '+inf', '-inf', 'infinity', '+infinity', '-infinity'"
_NAN = "'nan', '+nan', '-nan'"
_INT = r"^\\s*[+-]?[0-9]+\\s*\\z"
_STRICT_TIME = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\\z"
_ISO_DAY = r"^([0-9]{4})-?([0-9]{2})-?([0-9]{2})"
_ISO_WEEK = r"^([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?"
_ISO_DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{4}-W[0-9]{2}(?:-[1-7])?|[0-9]{4}W[0-9]{2}[1-7]?)"
_CLOCK = r"([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
_ISO_CLOCK = rf"^{_ISO_DATE}([^0-9]){_CLOCK}"
_ISO_OFFSET = rf"^{_ISO_DATE}[^0-9][0-9:.,]+?([+-]){_CLOCK}$"
_ISO_ANY = rf"^{_ISO_DATE}(?:[^0-9]{_CLOCK}(?:Z|[+-]{_CLOCK})?)?$"
_ISO_TIME = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.]([0-9]{3}|[0-9]{6}))?)?)?)?\\z"
)


def float_sql(text: str) -> str:
    return f"""case when {text} rlike '{_PLAIN}' then try_cast({text} as double)
        when lower(trim({text})) in ({_INFINITE}) then cast(lower(trim({text})) as double)
        when lower(trim({text})) in ({_NAN}) then double('nan') end"""


def parse_float(text: str) -> Column:
    """Text to double, null where the text is no number; surrounding blanks are fine."""
    return F.expr(float_sql(text))


def parse_int_or_zero(text: str) -> Column:
    """Text to integer, zero where the text is no whole number."""
    return F.expr(f"coalesce(if({text} rlike '{_INT}', try_cast({text} as bigint), null), bigint(0))")


def retry_sql(text: str) -> str:
    """Retry count text to integer, cutting a fraction; null where it is no finite number."""
    return f"""if({text} rlike '{_INT}', try_cast({text} as int),
        try_cast(nullif({float_sql(text)}, double('nan')) as int))"""


def event_time_lenient(text: str) -> Column:
    """What a cast accepts (date only, ``T``, fractions); anything else is null."""
    return F.expr(f"try_to_timestamp({text})")


def event_time_strict(text: str) -> Column:
    """Exactly ``year-month-day hour:minute:second``, where leading zeros may be missing."""
    return F.expr(
        f"""if({text} rlike '{_STRICT_TIME}',
            try_to_timestamp(regexp_replace({text}, '\\\\s+', ' '), 'yyyy-M-d H:m:s'), null)"""
    )


def iso_text(time: str) -> Column:
    """ISO text of a timestamp; the six-digit fraction appears only where there is one."""
    return F.expr(
        f"""if(pmod(unix_micros({time}), 1000000) = 0,
            date_format({time}, "yyyy-MM-dd'T'HH:mm:ss"),
            date_format({time}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))"""
    )


def _iso_parts(text: str) -> str:
    """Any ISO spelling, part by part: basic or extended, week dates, offsets, long fractions."""

    def part(pattern: str, group: int, whole: str = text) -> str:
        return f"nullif(regexp_extract({whole}, '{pattern}', {group}), '')"

    def number(piece: str) -> str:
        return f"coalesce(try_cast({piece} as int), 0)"

    def clock(pattern: str) -> str:
        fraction = f"rpad(substr(coalesce({part(pattern, 5)}, ''), 1, 6), 6, '0')"
        return f"""({number(part(pattern, 2))} * 3600 + {number(part(pattern, 3))} * 60
            + {number(part(pattern, 4))}) * 1000000L + bigint({fraction})"""

    day = f"""if({text} rlike '{_ISO_WEEK}',
        date_add(trunc(make_date(int({part(_ISO_WEEK, 1)}), 1, 4), 'WEEK'),
            (int({part(_ISO_WEEK, 2)}) - 1) * 7 + coalesce(int({part(_ISO_WEEK, 3)}), 1) - 1),
        try_cast(concat_ws('-', {part(_ISO_DAY, 1)}, {part(_ISO_DAY, 2)}, {part(_ISO_DAY, 3)}) as date))"""
    time, offset = clock(_ISO_CLOCK), clock(_ISO_OFFSET)
    sign = f"if({part(_ISO_OFFSET, 1)} = '-', -1, 1)"
    micros = f"unix_micros(timestamp({day})) + {time} - coalesce({sign} * ({offset}), 0)"
    inside = f"{number(part(_ISO_CLOCK, 2))} < 24 and {number(part(_ISO_CLOCK, 3))} < 60 and {number(part(_ISO_CLOCK, 4))} < 60"
    inside += f" and {number(part(_ISO_OFFSET, 2))} < 24"
    return f"if({text} rlike '{_ISO_ANY}' and {inside}, timestamp_micros({micros}), null)"


def iso_time(text: str) -> Column:
    """ISO text to timestamp, null for any other text.

    Takes what Python 3.12 takes: basic and extended forms, week dates, any sign between date and
    time, fractions of any length (cut to microseconds), ``Z`` and offsets. A time with an offset
    is turned into UTC, one without is taken as UTC.
    """
    return F.expr(
        f"if({text} rlike '{_ISO_TIME}', try_to_timestamp({text}), {_iso_parts(text)})"
    )


def float_text_sql(number: str) -> str:
    plain = f"rtrim('0', string(try_cast(string({number}) as decimal(38,21))))"
    size = f"abs({number})"
    return f"""if(({size} >= 1e7 and {size} < 1e16) or ({size} >= 1e-4 and {size} < 1e-3),
        if(endswith({plain}, '.'), concat({plain}, '0'), {plain}), string({number}))"""


def float_text(number: str) -> Column:
    """Shortest decimal text of a double, without an exponent from 0.0001 up to 1e16.

    Spark itself changes to an exponent outside 0.001 to 1e7.
    """
    return F.expr(float_text_sql(number))


def or_unknown(text: str) -> Column:
    """The location used as a message key: null and blank both become ``unknown``."""
    return F.expr(f"coalesce(nullif({text}, ''), '{UNKNOWN_LOCATION}')")
