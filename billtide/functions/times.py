"""Time expressions as SQL text or columns. All of them assume a UTC session."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


#: A date, and after it a time of day and a zone if any; a bare time of day is no time.
ISO_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)


def parsed_or_null(text: str) -> str:
    """ISO-8601 text to a timestamp; text that is no time becomes null."""
    return f"if(CAST({text} AS STRING) RLIKE '{ISO_PATTERN}', try_cast({text} AS TIMESTAMP), NULL)"


def parsed(text: str) -> str:
    """The same, but text that is no time raises."""
    wrong = f"CAST(raise_error(concat('no time: ', {text})) AS TIMESTAMP)"
    return f"if({text} IS NULL, NULL, coalesce({parsed_or_null(text)}, {wrong}))"


def iso_text(time: str) -> str:
    """A timestamp as ISO-8601 text with microseconds and ``Z``."""
    return f'date_format({time}, "{ISO_MICROS}")'


def event_date(column="event_time") -> Column:
    return F.to_date(column)


def moment(value) -> Column:
    """A timestamp column from a mark given as microseconds since 1970, ISO text, ``datetime`` or column.

    Marks that pass through the driver are microseconds: local times of the driver's zone would not be
    unambiguous.
    """
    if isinstance(value, int):
        return F.timestamp_micros(F.lit(value).cast("bigint"))
    if isinstance(value, str):
        return F.lit(value).cast("timestamp")
    return value if isinstance(value, Column) else F.lit(value)
