"""Reading JSON payloads held as VARIANT.

VARIANT keeps what the checks need: the original JSON type, and the difference between
a key that is missing (SQL NULL) and a key that holds JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER, TEXT, BOOLEAN, OBJECT, ARRAY, NULL = "NUMBER", "STRING", "BOOLEAN", "OBJECT", "ARRAY", "NULL"


def quoted_path(name: str) -> str:
    """``a.b`` read as a path of two keys."""
    return "$" + "".join(f'["{part}"]' for part in name.split("."))


def flat_path(name: str) -> str:
    """``a.b`` read as one key that contains a dot."""
    return f'$["{name}"]'


def field(payload: Column, name: str, as_type: str = "variant") -> Column:
    """A payload field; a dotted name is looked up as one key first, then as a path."""
    by_path = F.try_variant_get(payload, quoted_path(name), as_type)
    if "." not in name:
        return by_path
    return F.coalesce(F.try_variant_get(payload, flat_path(name), as_type), by_path)


def text(value: Column) -> Column:
    """Text form of a value; JSON null and missing are null."""
    return F.try_variant_get(value, "$", "string")


def json_kind(value: Column) -> Column:
    """NUMBER, STRING, BOOLEAN, OBJECT, ARRAY or NULL; SQL NULL when the field is missing."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.isNull(), F.lit(None).cast("string"))
        .when(shape == "STRING", TEXT)
        .when(shape == "BOOLEAN", BOOLEAN)
        .when(shape == "VOID", NULL)
        .when(shape.startswith("OBJECT"), OBJECT)
        .when(shape.startswith("ARRAY"), ARRAY)
        .otherwise(NUMBER)
    )


def is_object_text(payload_text: Column) -> Column:
    """Whether a text that parses as JSON holds an object, without walking the value."""
    return payload_text.rlike(r"^\s*\{")


def number(value_text: Column) -> Column:
    """Numeric reading of a text form; null for anything that is not a finite number."""
    parsed = value_text.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def instant(value_text: Column) -> Column:
    """ISO-8601 text as a timestamp, null when it does not parse."""
    return F.try_to_timestamp(value_text)


#: Date, time and offset: without an offset a text would mean another instant in every session zone.
WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)$"


def snapshot_millis(snapshot_text: Column, as_of: Column | None = None) -> Column:
    """Epoch milliseconds of a snapshot time with an offset; an unreadable one counts as ``as_of`` when given."""
    parsed = F.unix_millis(F.when(snapshot_text.rlike(WITH_OFFSET), instant(snapshot_text)))
    return parsed if as_of is None else F.coalesce(parsed, F.unix_millis(as_of))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC, in any session time zone."""
    return F.unix_micros(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


DURATION_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "second": 1, "minute": 60, "hour": 3600}


def duration_micros(amount: str | int | float, unit: str | None = None) -> int:
    """``"30d"``, ``"10m"`` or an amount with a unit name, in microseconds."""
    if unit is None:
        amount, unit = amount[:-1], amount[-1]
    return int(float(amount) * DURATION_UNITS[unit.lower()] * 1_000_000)
