"""Exact duplicates by distributed MSD radix partitioning; texts are compared byte by byte.

A level reads the next bytes of each text that still shares its group with others: texts of one
group with equal bytes go on together, a text that is alone or at its end is finished. Levels read
more bytes each time, so copies of n bytes take log n levels and no byte is read twice. Counting
combines on the map side and finished rows leave, so a level moves only texts that are still equal
to another one. The groups that go on are broadcast while their measured size is small; beyond that
the join shuffles, and adaptive execution splits hot groups.

White space (U+0020, U+0009 to U+000D) does not count; null text is empty text. All empty texts are
one group. Of a group, the row with the most code points, then the smallest key stays; of rows that
repeat a key with equal text, all carry the same keep_id and exactly one is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import new_folder, small, small_by, stored

BLANKS = r"[\x20\x09-\x0D]+"
#: Bytes of the first level, and how many times more the next one reads.
FIRST_BYTES, GROWTH = 32, 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def _level(rows: DataFrame, width: int, folder: str, keys: DataFrame) -> DataFrame:
    """Split the open groups by their next bytes; finished rows get `done`."""
    groups = keys.groupBy("gid", "digit", "ended").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = stored(groups.withColumn("next", F.monotonically_increasing_id()), f"{folder}-groups")
    split = rows.withColumns({"digit": F.substring("rest", 1, width), "ended": F.octet_length("rest") <= width})
    groups = small_by(groups, F.octet_length("digit") + 64)
    split = split.join(groups, ["gid", "digit", "ended"], "left")
    alone = F.col("next").isNull()
    return split.select(
        "doc_id",
        "n_chars",
        "text_sha256",
        "row",
        F.coalesce("next", F.lit(-1)).alias("gid"),
        (F.col("ended") | alone).alias("done"),
        alone.alias("alone"),
        F.when(~F.col("ended") & ~alone, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    )


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text) of every row."""
    spark = docs.sparkSession
    folder = new_folder(spark, "radix")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    body = normalised(F.col("text")).cast("binary")
    rows = source.select(
        "doc_id",
        F.coalesce(F.char_length("text"), F.lit(0)).alias("n_chars"),
        body.alias("rest"),
        F.sha2(body, 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(0).cast("long").alias("gid"),
    )
    # The first level counts leading bytes alone; one code point more than the width tells the end.
    head = F.regexp_extract(
        F.coalesce("text", F.lit("")), rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D][\x20\x09-\x0D]*+){{0,{FIRST_BYTES + 1}}}", 0
    )
    head = F.regexp_replace(head, BLANKS, "").cast("binary")
    keys = source.select(
        F.lit(0).cast("long").alias("gid"),
        F.substring(head, 1, FIRST_BYTES).alias("digit"),
        (F.octet_length(head) <= FIRST_BYTES).alias("ended"),
    )
    width, level, finished = FIRST_BYTES, 0, None
    while True:
        now = stored(_level(rows, width, f"{folder}/{level}", keys), f"{folder}/{level}")
        out = now.filter("done").select(
            "doc_id", "n_chars", "text_sha256", "row", "alone", F.lit(level).alias("level"), "gid"
        )
        finished = out if finished is None else finished.unionByName(out)
        rows = now.filter("NOT done").drop("done", "alone")
        if rows.isEmpty():
            break
        width, level = width * GROWTH, level + 1
        keys = rows.select(
            "gid", F.substring("rest", 1, width).alias("digit"), (F.octet_length("rest") <= width).alias("ended")
        )
    return _choose(finished, folder)


def _choose(finished: DataFrame, folder: str) -> DataFrame:
    single = finished.filter("alone").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    many = finished.filter("NOT alone")
    best = many.groupBy("level", "gid").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("best"),
    )
    best = best.select("level", "gid", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    best = small(stored(best, f"{folder}/best"), 64)
    chosen = many.join(best, ["level", "gid"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
    return single.unionByName(chosen)
