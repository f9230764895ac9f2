"""Text clean-up, presence tests and small string builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia import fixed_values as V

# A run of cased letters, or a run of anything else.
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"

# White space that is not a single plain space already.
_TO_COLLAPSE = r"\s{2,}|[\t\n\x0B\f\r]"


# The Unicode white space that is cut off the ends of values.
_WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(col: Column) -> Column:
    """The value without white space of any kind at its ends."""
    return F.btrim(col, F.lit(_WHITE_SPACE))


def is_present(col: Column) -> Column:
    """Neither null nor one of the words that stand for an empty value."""
    return col.isNotNull() & ~F.lower(F.trim(col)).isin(V.EMPTY_WORDS)


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (F.trim(col) != "")


def country_ok(col: Column) -> Column:
    """Not denied, and names the country in one of its spellings."""
    word = F.lower(F.trim(col))
    return col.isNotNull() & ~word.isin(V.COUNTRY_DENIED) & word.rlike(V.COUNTRY_PATTERN)


def clean_html(col: Column) -> Column:
    """Tags become a space, white space collapses, ends are trimmed. Entities stay as they are.

    Each replacement rebuilds the text, so texts without a tag or without a run to collapse skip it.
    """
    untagged = F.when(col.contains("<"), F.regexp_replace(col, "<[^>]+>", " ")).otherwise(col)
    collapsed = F.when(
        untagged.rlike(_TO_COLLAPSE), F.regexp_replace(untagged, _TO_COLLAPSE, " ")
    ).otherwise(untagged)
    return F.trim(collapsed)


def clean_or(col: Column, default: str) -> Column:
    """Cleaned text, or the default where nothing is left of it."""
    return F.coalesce(F.nullif(clean_html(col), F.lit("")), F.lit(default))


def first_truthy(*cols: Column) -> Column:
    """The first alternate that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def title_case(col: Column) -> Column:
    """Capital at the start of every run of letters, the rest in lower case."""
    runs = F.regexp_extract_all(col, F.lit(_CASED_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, _capitalize), "")


def _capitalize(run: Column) -> Column:
    head = F.upper(F.substring(run, 1, 1))
    # One letter may become two ("ß" -> "SS"): only the first of them stays a capital.
    return F.concat(
        F.substring(head, 1, 1),
        F.lower(F.substr(head, F.lit(2))),
        F.lower(F.substr(run, F.lit(2))),
    )


def map_city(col: Column, names: dict[str, str] | None = None) -> Column:
    """Known spelling -> city name (lower-cased key first, then the exact one), else title case."""
    names = V.CITY_NAMES if names is None else names
    city = strip(col)
    # One literal that Spark folds into a map, instead of an expression per spelling.
    pairs = "\x01".join(f"{spelling}\x02{name}" for spelling, name in names.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    known = F.try_element_at(table, F.lower(city))
    if any(key != key.lower() for key in names):
        known = F.coalesce(known, F.try_element_at(table, city))
    return F.when(
        city.isNull() | F.lower(city).isin(V.CITY_EMPTY_WORDS), F.lit(V.UNKNOWN)
    ).otherwise(F.coalesce(known, title_case(city)))


def city_from_location(city: Column, location: Column) -> Column:
    """The given city, else the last comma-separated part of the location."""
    return F.coalesce(
        F.nullif(city, F.lit("")),
        strip(F.substring_index(F.coalesce(location, F.lit("")), ",", -1)),
    )


def truthy(col: Column) -> Column:
    """Not null, not empty, not a zero written in any way."""
    return F.coalesce((col != "") & ~F.coalesce(col.try_cast("double") == 0, F.lit(False)), F.lit(False))


def salary_text(low: Column, high: Column, currency: Column | None = None) -> Column:
    """`low - high CUR`, `low CUR`, or null; the currency has a default."""
    code = F.lit(V.CURRENCY) if currency is None else first_truthy(currency, F.lit(V.CURRENCY))
    return F.when(
        truthy(low),
        F.when(truthy(high), F.concat(low, F.lit(" - "), high, F.lit(" "), code)).otherwise(
            F.concat(low, F.lit(" "), code)
        ),
    )


def experience_text(low: Column, high: Column) -> Column:
    """`low - high years` if either side is set; a missing side is left out."""
    return F.when(
        truthy(low) | truthy(high),
        F.concat(F.concat_ws(" - ", F.nullif(low, F.lit("")), F.nullif(high, F.lit(""))), F.lit(" years")),
    )
