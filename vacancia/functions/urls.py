"""URL shaping by pattern: no parser that gives up on unusual characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(col: Column) -> Column:
    """Network location of an absolute URL; empty for a relative one."""
    return F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def host_is(col: Column, host: str) -> Column:
    return host_of(col) == host


def absolute_url(col: Column, base: str) -> Column:
    """A link made absolute against a bare host such as `https://host`."""
    base = base.rstrip("/")
    scheme = base.split("://")[0]
    return (
        F.when(col.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), col)
        .when(col.startswith("//"), F.concat(F.lit(scheme + ":"), col))
        .when(col.rlike("^[/?#]") | (col == ""), F.concat(F.lit(base), col))
        .otherwise(F.concat(F.lit(base + "/"), col))
    )


def normalize_url(col: Column, base: str, language_prefix: str = "ar") -> Column:
    """Absolute, without the language prefix, query and fragment."""
    base = base.rstrip("/")
    plain = F.replace(absolute_url(col, base), F.lit(f"{base}/{language_prefix}/"), F.lit(f"{base}/"))
    return F.substring_index(F.substring_index(plain, "?", 1), "#", 1)
