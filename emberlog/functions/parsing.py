"""Column functions for log text. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level patterns, checked in this order.
ERROR_PATTERN = "error|exception|failed|timeout|cannot|unable|denied"
WARN_PATTERN = "warning|warn|deprecated|retry"

# Accepted timestamp layouts (the last one is our addition).
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
)

# A numeric timestamp above this is taken as milliseconds.
EPOCH_MILLIS_FROM = 1e10


# What a strict parser refuses and Spark's takes by default.
STRICT_JSON = {"allowSingleQuotes": "false", "allowUnquotedFieldNames": "false"}

# A decimal number or an infinity, as text; not the type suffixes that a cast would take.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def json_fields(message: Column) -> Column:
    """MAP of the top-level keys of a JSON object (may be empty); NULL for anything else.

    The shape test keeps scalars and arrays away. The message is read as the one element of
    an array, so that a second value or any text after the object is an error. Of a
    repeated key the last value counts.
    """
    shaped = message.rlike(r"(?s)^\s*\{.*\}\s*$")
    values = F.from_json(F.concat(F.lit("["), message, F.lit("]")), "array<map<string,string>>", STRICT_JSON)
    found = F.get(values, F.lit(0))
    keys = F.map_keys(found)
    last = F.filter(
        F.map_entries(found),
        lambda _, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), F.get(keys, i)),
    )
    plain = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(shaped & (F.size(values) == 1), F.when(plain, found).otherwise(F.map_from_entries(last)))


def level_from_text(message: Column) -> Column:
    low = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(low.rlike(ERROR_PATTERN), "ERROR")
        .when(low.rlike(WARN_PATTERN), "WARN")
        .when(low.contains("info"), "INFO")
        .when(low.contains("debug"), "DEBUG")
        .otherwise("INFO")
    )


def service_from_stream(stream: Column) -> Column:
    """Third '/'-separated part, else ``unknown``."""
    return F.coalesce(F.get(F.split(stream, "/"), F.lit(2)), F.lit("unknown"))


def to_number(value: Column) -> Column:
    """Numeric coercion; bad text and NaN become NULL."""
    number = F.when(value.cast("string").rlike(NUMBER_PATTERN), value.try_cast("double"))
    return F.when(~F.isnan(number), number)


def parse_epoch(value: Column) -> Column:
    number = value.cast("double")
    seconds = F.when(number > EPOCH_MILLIS_FROM, number / 1000).otherwise(number)
    return F.timestamp_micros(F.round(seconds * 1e6).cast("bigint"))


def parse_text_timestamp(value: Column, layout: str | None = None) -> Column:
    if layout is not None:
        return F.try_to_timestamp(value, F.lit(layout))
    # fractions are optional-length, so short ones are padded to six digits first
    padded = F.regexp_replace(
        value,
        r"^(.*\.\d{1,6})(Z?)$",
        "$1@@$2",
    )
    padded = F.when(
        padded.contains("@@"),
        F.concat(
            F.substring_index(padded, ".", 1), F.lit("."),
            F.rpad(F.regexp_extract(padded, r"\.(\d+)@@", 1), 6, "0"),
            F.substring_index(padded, "@@", -1),
        ),
    ).otherwise(value)
    return F.coalesce(*[F.try_to_timestamp(padded, F.lit(f)) for f in TIMESTAMP_FORMATS])


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; NULL stays NULL."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))) + F.when(
        text.isNull(), F.lit(None).cast("int")
    ).otherwise(0)


def matches_filter(message: Column, pattern: str) -> Column:
    """Text filter: plain terms must all occur, ``?a ?b`` needs one of them, ``-x`` must
    not occur, and a double-quoted phrase is one term. Case-sensitive; an empty pattern
    keeps everything."""
    import re

    required, optional, banned = [], [], []
    for sign, quoted, bare in re.findall(r'([?-]?)(?:"([^"]*)"|(\S+))', pattern):
        {"": required, "?": optional, "-": banned}[sign].append(quoted or bare)
    test = F.lit(True)
    for term in required:
        test = test & message.contains(term)
    for term in banned:
        test = test & ~message.contains(term)
    if optional:
        any_of = F.lit(False)
        for term in optional:
            any_of = any_of | message.contains(term)
        test = test & any_of
    return F.coalesce(test, F.lit(False))
