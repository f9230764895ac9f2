"""Array helpers: fall-back chains, label/value maps and list-to-text joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_nonempty(*arrays: Column) -> Column:
    """The first array that has any element; an empty array if none has."""
    picks = [F.when(F.size(a) > 0, a) for a in arrays]
    return F.coalesce(*picks, F.array().cast("array<string>"))


def kv_map(labels: Column, values: Column) -> Column:
    """Label -> value; of repeated labels the last one counts, null labels are left out."""
    pairs = F.arrays_zip(labels.alias("label"), values.alias("value"))
    last_first = F.reverse(F.filter(pairs, lambda pair: pair["label"].isNotNull()))

    def first_of_each(kept: Column) -> Column:
        return F.filter(
            kept,
            lambda pair, i: F.array_position(F.transform(kept, lambda p: p["label"]), pair["label"]) == i + 1,
        )

    # A one-element array names the reversed pairs, so they are built once per row.
    return F.transform(F.array(last_first), lambda kept: F.map_from_entries(first_of_each(kept)))[0]


def join_list(items: Column, separator: str = "; ") -> Column:
    """Non-empty items joined to one text; null if there are none."""
    kept = F.filter(items, lambda x: x.isNotNull() & (F.trim(x) != ""))
    return F.nullif(F.array_join(kept, separator), F.lit(""))


def join_names(items: Column, separator: str = "; ") -> Column:
    """The `name` fields of an array of structs joined to one text; null if there are none."""
    names = F.filter(
        F.transform(items, lambda x: x["name"]), lambda n: n.isNotNull() & (n != "")
    )
    return F.nullif(F.array_join(names, separator), F.lit(""))


def named_objects(text: Column) -> Column:
    """The elements of a JSON list as structs of their `name`; null if the text is no list.

    The JSON functions drop a whole list for one element of another kind, so a mixed list is read as
    VARIANT: elements that are no objects have a null name there.
    """
    listed = F.when(text.startswith("["), text)
    alike = F.from_json(listed, "array<struct<name:string>>")
    mixed = F.try_variant_get(F.try_parse_json(listed), "$", "array<variant>")
    return F.coalesce(alike, F.transform(mixed, lambda x: F.struct(F.try_variant_get(x, "$.name", "string").alias("name"))))


def split_skills(col: Column, sentinel: str) -> Column:
    """Distinct skill names of a `;`- or `,`-separated text, blanks and the sentinel left out."""
    names = F.transform(F.split(col, "[;,]"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_distinct(F.filter(names, lambda x: (x != "") & (x != sentinel)))
