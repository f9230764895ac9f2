"""URL filtering by dated lists, with DataFrame functions alone.

A list's log says from which date an entry blocks, allows, or is off the list. Each entry's dates
become validity intervals, and an as-of join evaluates every capture against the entries that were
active when it was fetched. Entries are hosts, which cover their subdomains, or a host with its
first path segment; the most specific active entry decides.

A capture without URL, host or fetch date matches nothing and is not blocked. Log rows without entry
or date are ignored; of several actions for an entry on one date, blocking wins over allowing over
removal. Rows that repeat are evaluated each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, small, stored

# Host and first path segment of a URL.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def keys_of(url: Column) -> Column:
    """The host and its parents, and the host with the first path segment."""
    host, segment = host_of(url), F.regexp_extract(url, SEGMENT, 1)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    keys = F.concat(parents, F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment))).otherwise(F.array().cast("array<string>")))
    return F.when(host.isNotNull(), keys)


def intervals(log: DataFrame) -> DataFrame:
    """(entry, action, valid_from, valid_to): the times at which an entry blocks or allows.

    `log` has entry, action (block, allow or remove) and listed_on. One row per entry and date is
    left before the dates are put in order, so an entry's history is as long as its dates at most.
    """
    rank = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).otherwise(0)
    daily = log.filter("entry IS NOT NULL AND listed_on IS NOT NULL").groupBy("entry", "listed_on").agg(F.max(rank).alias("rank"))
    ends = F.lead("listed_on").over(Window.partitionBy("entry").orderBy("listed_on"))
    action = F.when(F.col("rank") == 2, "block").otherwise("allow")
    dated = daily.withColumn("valid_to", ends).filter("rank > 0")
    return dated.select("entry", action.alias("action"), F.col("listed_on").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, log: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """Every capture's key, host, fetch date, blocked, and the deciding entry with its start."""
    listed = stored(intervals(log), new_folder(captures.sparkSession, "list-intervals"))
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        F.col(fetched).alias("fetched_on"),
    )
    asked = rows.select("row", "page_id", host_of(F.col("url")).alias("host"), "fetched_on", F.explode_outer(keys_of(F.col("url"))).alias("entry"))
    active = (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    right = small(listed, 256).withColumnRenamed("entry", "listed")
    met = asked.join(right, (F.col("entry") == F.col("listed")) & active, "left")
    best = F.max(F.when(F.col("listed").isNotNull(), F.struct(F.length("listed"), "listed", "action", "valid_from")))
    decided = met.groupBy("row", "page_id", "host", "fetched_on").agg(best.alias("best"))
    return decided.select(
        "page_id",
        "host",
        "fetched_on",
        F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
        F.col("best.listed").alias("entry"),
        F.col("best.action").alias("action"),
        F.col("best.valid_from").alias("listed_on"),
    )
