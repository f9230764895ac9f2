"""Date texts: a fixed order of formats, null where none fits (nothing raises)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
_FULL = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}"
_SLASH = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:( \d{2}:\d{2}:\d{2}).*)?$"


def to_ts(col: Column) -> Column:
    """Timestamp of a text in one of the known renderings.

    ISO with `T`; `Y-m-d H:M:S`; slashes, day first where the first part exceeds 12; epoch in
    milliseconds (13 digits) or seconds (10 digits); whatever a plain cast accepts. A zone offset
    after a full ISO time is not applied.

    The shape is settled by pattern first and the value then cast: a format that does not fit would
    cost an exception per row.
    """
    c = F.trim(col)
    day_first = F.split_part(c, F.lit("/"), F.lit(1)).try_cast("int") > 12
    slash = F.when(day_first, F.regexp_replace(c, _SLASH, "$3-$2-$1$4")).otherwise(
        F.regexp_replace(c, _SLASH, "$3-$1-$2$4")
    )
    return (
        F.when(
            c.rlike(_FULL),
            F.coalesce(F.substring(c, 1, 19).try_cast("timestamp"), c.try_cast("timestamp")),
        )
        .when(c.rlike(_SLASH), slash.try_cast("timestamp"))
        .when(c.rlike(r"^\d{13}$"), F.timestamp_millis(c.try_cast("bigint")))
        .when(c.rlike(r"^\d{10}$"), F.timestamp_seconds(c.try_cast("bigint")))
        .otherwise(c.try_cast("timestamp"))
    )


def parse_ts(col: Column) -> Column:
    """The same as text `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(to_ts(col), TEXT_FORMAT)


def lenient_iso(col: Column) -> Column:
    """ISO text of a date attribute, its zone offset kept; the raw text where it is no date."""
    text = F.nullif(F.trim(col), F.lit(""))
    offset = F.regexp_extract(text, r"\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$", 1)
    local = F.trim(F.regexp_replace(text, r"(?<=\d{2}:\d{2})\s*(Z|[+-]\d{2}:?\d{2})$", ""))
    tail = F.when(offset == "Z", F.lit("+00:00")).otherwise(
        F.regexp_replace(offset, r"^([+-]\d{2}):?(\d{2})$", "$1:$2")
    )
    return F.coalesce(
        F.concat(F.date_format(to_ts(local), "yyyy-MM-dd'T'HH:mm:ss"), tail),
        F.nullif(col, F.lit("")),
    )


def date_key(col: Column) -> Column:
    """`yyyyMMdd` as a number."""
    return F.date_format(col.try_cast("date"), "yyyyMMdd").cast("bigint")
