"""Boilerplate lines by their frequency within a site, with DataFrame functions alone.

For each host, the pages that contain a line are divided by all pages of the host; lines above a ratio
are dropped from the host's pages. The ratio falls with the line's length, as a long line hardly comes twice
by chance: SHORT_SHARE of the pages up to SHORT_CHARS characters, less in proportion beyond. SPARE pages on top of
that keep a few pages from losing what they share; a line that stands on every page of a host of two
or more goes whatever the host's size. A page counts once for a line however often it repeats it.

Near copies count once, in the pages of a line as in those of the host; else an article that was copied with
small changes would look like boilerplate and vanish from all its copies. A page counts as 1/m of a page if half
of its characters stand on lines that m pages of the host hold: of m near copies each has most of its lines in
common with all others. Shares of a page are whole numbers of 1/UNIT, so sums do not depend on their order.

Lines are counted under 16 bytes of their SHA-256, combined on the map side, so a host or line with a third of
all rows does not meet in one task. A host has at most (50 times the mean lines + 5 times the mean characters of
a page) such lines, so its list is bounded whatever its size.

Null text and null host: the row stays as it is (no site to compare with), and rows without host
count for no site. Blank lines are never boilerplate. A text of boilerplate alone becomes empty.
Rows that repeat are copies, and count once. All other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import BROADCAST_BYTES, new_folder, stored

#: A line of so many characters goes above 1/SHORT_PAGES of a host's pages and so many pages on top.
SHORT_PAGES, SHORT_CHARS, SPARE = 50, 10, 2
#: A page is the sum of so many parts; divisible by 1 to 16.
UNIT = 720720


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.substring(F.unhex(F.sha2(line, 256)), 1, 16)


def page_parts(lines: DataFrame) -> DataFrame:
    """(page, parts) of the pages that count as less than one.

    `lines` holds (page, total, chars, n): the characters of the page and of a line, and the pages that hold it.
    """
    by_n = lines.groupBy("page", "total", "n").agg(F.sum("chars").alias("chars"))
    down = Window.partitionBy("page").orderBy(F.col("n").desc())
    held = by_n.withColumn("up_to", F.sum("chars").over(down)).filter(2 * F.col("up_to") >= F.col("total"))
    return held.groupBy("page").agg(F.floor(F.lit(UNIT) / F.max("n")).alias("parts"))


def boilerplate(docs: DataFrame, host: str, text: str, folder: str) -> DataFrame:
    """(host, key) of every boilerplate line; lines are written to `folder` once."""
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("host IS NOT NULL")
    lines = F.filter(F.array_distinct(lines_of(F.col("text"))), lambda line: F.trim(line) != "")
    pages = pages.select(F.monotonically_increasing_id().alias("page"), "host", F.coalesce(lines, F.array()).alias("lines"))
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda sum_, line: sum_ + F.char_length(line))
    laid = pages.select("page", "host", total.alias("total"), F.explode_outer("lines").alias("line"))
    laid = laid.select("page", "host", "total", F.char_length("line").alias("chars"), line_key(F.col("line")).alias("key"))
    laid = stored(laid, f"{folder}/lines")

    counts = laid.filter("key IS NOT NULL").groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    shared = stored(laid.join(counts, ["host", "key"]), f"{folder}/shared")
    parts = stored(page_parts(shared), f"{folder}/parts")
    less = shared.select("page", "host").distinct().join(parts, "page").groupBy("host").agg(F.sum(UNIT - F.col("parts")).alias("less"))
    totals = laid.groupBy("host").agg(F.count_distinct("page").alias("pages")).join(less, "host", "left")
    totals = totals.select("host", (F.col("pages") * UNIT - F.coalesce("less", F.lit(0))).alias("pages"))

    parted = shared.join(parts, "page", "left").groupBy("host", "key", "chars")
    counted = parted.agg(F.sum(F.coalesce("parts", F.lit(UNIT))).alias("with_line")).join(totals, "host")
    per_page = F.lit(SHORT_PAGES) * F.greatest("chars", F.lit(SHORT_CHARS)) / SHORT_CHARS  # one page in so many
    often = (F.col("with_line") - SPARE * UNIT) * per_page > F.col("pages")
    everywhere = (F.col("with_line") == F.col("pages")) & (2 * F.col("pages") > 3 * UNIT)
    return counted.filter(often | everywhere).select("host", "key")


def dedup_lines(
    docs: DataFrame, host: str = "source", text: str = "text", length: str | None = None, dropped: str | None = None
) -> DataFrame:
    """Every row with its boilerplate lines taken out of `text`.

    `length` names a column to be set to the new text's code points; `dropped` one that receives the
    number of lines taken out.
    """
    folder = new_folder(docs.sparkSession, "boilerplate")
    found = stored(boilerplate(docs, host, text, folder), f"{folder}/found")
    lists = found.groupBy("host").agg(F.collect_list("key").alias("keys"))
    if found.count() * 96 <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    packed = docs.select(F.struct("*").alias("row"), F.col(host).alias("host")).join(lists, "host", "left")
    old = F.col("row").getField(text)
    left = F.filter(lines_of(old), lambda line: ~F.array_contains(F.col("keys"), line_key(line)))
    new = F.when(F.col("keys").isNull() | old.isNull(), old).otherwise(F.array_join(left, "\n"))
    gone = F.coalesce(F.size(lines_of(old)) - F.size(left), F.lit(0))
    row = F.col("row").withField(text, F.col("new"))
    if length:
        row = row.withField(length, F.char_length("new").cast(docs.schema[length].dataType))
    if dropped:
        row = row.withField(dropped, F.when(F.col("keys").isNull(), F.lit(0)).otherwise(gone).cast("long"))
    return packed.withColumn("new", new).select(row.alias("row")).select("row.*")
