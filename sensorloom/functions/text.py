"""Notification texts. The literal texts of this module are fixed values: messages carry them exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ALERT_EMOJI, DEFAULT_EMOJI


def _time_text(col: Column | str) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss``, with a six-digit fraction where there is one."""
    time = F.col(col) if isinstance(col, str) else col
    fraction = F.pmod(F.unix_micros(time), F.lit(1_000_000))
    return F.when(fraction == 0, F.date_format(time, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def _text(col: Column | str) -> Column:
    """Null shows as ``None`` in every message."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit("None"))


def alert_text(
    alert_type: str = "alert_type",
    location: str = "location",
    reason: str = "alert_reason",
    event_time: str = "event_time",
    window_start: str = "window_start",
    window_end: str = "window_end",
) -> Column:
    kind = F.col(alert_type)
    emoji = F.lit(DEFAULT_EMOJI)
    for name, sign in ALERT_EMOJI.items():
        emoji = F.when(kind == name, F.lit(sign)).otherwise(emoji)
    return F.concat_ws(
        "\n",
        F.concat(emoji, F.lit(" *"), F.replace(kind, F.lit("_"), F.lit(" ")), F.lit(" Alert*")),
        F.concat(F.lit("Location: "), _text(location)),
        F.col(reason),
        F.concat(F.lit("Event Time: "), _text(_time_text(event_time))),
        F.concat(
            F.lit("Window: "),
            _text(_time_text(window_start)),
            F.lit(" ~ "),
            _text(_time_text(window_end)),
        ),
    )


def retry_text(
    retry_count: str = "retry_count",
    location: str = "location",
    reason: str = "alert_reason",
    event_time: str = "event_time",
) -> Column:
    return F.concat_ws(
        "\n",
        F.concat(F.lit("♻️ *Retry Alert ("), _text(retry_count), F.lit(")*")),
        F.concat(F.lit("Location: "), _text(location)),
        F.col(reason),
        F.concat(F.lit("Time: "), _text(_time_text(event_time))),
    )


# Nesting that pretty_json indents; deeper values stay on one line.
_PRETTY_DEPTH = 4


def _quoted(text: Column) -> Column:
    """Text as a JSON string."""
    wrapped = F.to_json(F.array(text))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def _indented(text: Column, depth: int) -> Column:
    """JSON text with its members on lines of their own; scalars as they are."""
    start, end = "\n" + "  " * (depth + 1), "\n" + "  " * depth

    def member(kind: Column, raw: Column) -> Column:
        # A value that is text in the source is quoted again; null has no text.
        is_text = F.schema_of_variant(kind) == "STRING"
        plain = F.coalesce(raw, F.lit("null"))
        if depth + 1 < _PRETTY_DEPTH:
            plain = F.when(raw.rlike(r"^\s*[\[{]"), _indented(raw, depth + 1)).otherwise(plain)
        return F.when(is_text, F.to_json(kind)).otherwise(plain)

    def joined(lines: Column, opening: str, closing: str) -> Column:
        return F.concat(
            F.lit(opening + start), F.array_join(lines, "," + start), F.lit(end + closing)
        )

    fields, kinds = F.from_json(text, "map<string,string>"), F.from_json(text, "map<string,variant>")
    members = F.transform(
        F.map_keys(fields),
        lambda key: F.concat(
            _quoted(key),
            F.lit(": "),
            member(F.element_at(kinds, key), F.element_at(fields, key)),
        ),
    )
    items, item_kinds = F.from_json(text, "array<string>"), F.from_json(text, "array<variant>")
    elements = F.transform(items, lambda raw, n: member(F.get(item_kinds, n), raw))
    is_object, is_array = text.rlike(r"^\s*\{"), text.rlike(r"^\s*\[")
    return (
        F.when(is_object & (F.size(fields) > 0), joined(members, "{", "}"))
        .when(is_array & (F.size(items) > 0), joined(elements, "[", "]"))
        .otherwise(text)
    )


def pretty_json(raw_row: Column | str) -> Column:
    """A JSON object or array re-indented by two blanks; any other text stays as it is."""
    text = F.col(raw_row) if isinstance(raw_row, str) else raw_row
    return F.coalesce(_indented(text, 0), text)


def error_text(
    error_type: str = "error_type",
    location: str = "location",
    file_name: str = "file_name",
    message: str = "error_message",
    raw_row: str = "raw_row",
    created_at: str = "created_at",
) -> Column:
    return F.concat_ws(
        "\n",
        F.lit("🚨 *Error Detected*"),
        F.concat(F.lit("• Type: `"), _text(error_type), F.lit("`")),
        F.concat(F.lit("• Location: `"), _text(location), F.lit("`")),
        F.concat(F.lit("• File: `"), _text(file_name), F.lit("`")),
        F.concat(F.lit("• Reason: "), _text(message)),
        F.concat(F.lit("• Raw Row: ```"), _text(pretty_json(raw_row)), F.lit("```")),
        F.concat(F.lit("• Time: "), _text(_time_text(created_at))),
    )
