"""Text clean-up and strict or lenient parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field contents that a reader takes for "no value".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Every character that counts as white space at either end.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)


def normalize(column: Column) -> Column:
    """Missing tokens to null, surrounding white space off, '' to null."""
    present = F.when(~column.isin(MISSING_TOKENS), column)
    return F.nullif(F.btrim(present, F.lit(WHITESPACE)), F.lit(""))


def parse_number(column: Column, target: T.DataType) -> Column:
    """Number in ``column``, or null when the text is not a number."""
    return column.try_cast(target)


def parse_integer(column: Column) -> Column:
    """Whole number in ``column``; '1.0' is one, '1.5' is not a whole number."""
    exact = column.try_cast(T.DecimalType(38, 18))
    from_decimal = F.when(exact == F.floor(exact), exact.try_cast(T.LongType()))
    return F.coalesce(column.try_cast(T.LongType()), from_decimal)


_ISO = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_TIMED = rf"^{_ISO}[ T][0-9]{{1,2}}:[0-9]{{1,2}}(?::[0-9]{{1,2}}(?:\.[0-9]{{1,9}})?)?$"
_HOUR = rf"^{_ISO}[ T][0-9]{{1,2}}$"


def parse_timestamp(column: Column) -> Column:
    """Timestamp without zone in ``column``, or null when it is not one.

    Read are ISO dates, alone or followed by a space or ``T`` and an hour, minutes, seconds
    and a fraction, which is cut after microseconds.  A cast alone would also take a bare
    year or month, which is shorter than a date, and drop a zone after the time, which
    changes the instant meant.
    """
    dated = (F.length(column) == len("yyyy-MM-dd")) & column.rlike(rf"^{_ISO}$")
    text = F.when(dated | column.rlike(_TIMED), column).when(
        column.rlike(_HOUR), F.concat(column, F.lit(":00"))
    )
    return text.try_cast(T.TimestampNTZType())


def is_invalid(raw: Column, parsed: Column) -> Column:
    """True where a value is present but could not be parsed."""
    return raw.isNotNull() & parsed.isNull()


def strict(raw: Column, parsed: Column, label: str) -> Column:
    """``parsed``, failing the job on the first value that cannot be parsed."""
    message = F.concat(F.lit(f"{label} holds an invalid value: "), raw.cast("string"))
    return F.when(is_invalid(raw, parsed), F.raise_error(message)).otherwise(parsed)
