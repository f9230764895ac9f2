"""Content-hash ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def job_id(source: Column, url: Column, title: Column) -> Column:
    """First 12 hex digits of the md5 of source, URL and title, lower-cased; nulls are skipped."""
    parts = [F.lower(F.trim(c)) for c in (source, url, title)]
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, 12)


def slug_id(url: Column) -> Column:
    """First 12 hex digits of the sha1 of the posting's slug, or of the URL where it has none."""
    slug = F.nullif(F.regexp_extract(url, "/jobs/p/([^/?]+)", 1), F.lit(""))
    return F.substring(F.sha1(F.coalesce(slug, url)), 1, 12)
