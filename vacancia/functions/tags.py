"""HTML pages as streams of tags, with column functions alone.

A page becomes an array of tokens: tags, texts and marks where something was left out. The tokens that a
selector may want are picked by what they contain, and only those are looked at closely. One pass over the
tags with a stack of open elements finds where the picked ones end: an end tag closes the nearest open
element of its name and all that are open inside it. Whether an element lies in another is then a comparison
of places.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import strip

# Elements without content; elements whose content is no text of the page.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
NO_TEXT = ["script", "style", "template"]

_NAME = r"[A-Za-z][^\s/>]*+"
_ATTRIBUTE = r"""[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+"""
#: A tag up to its end, at most so many attributes: a longer one counts as text.
_REST = rf"(?:[\s/=]++|{_ATTRIBUTE}){{0,400}}+>"
#: Comments, and the content of elements that are read as raw text.
_LEFT_OUT = rf"(?is)<!--.*?(?:-->|\z)|(<(script|style)(?=[\s/>]){_REST}).*?(?=</\2[\s/>]|\z)"
_TOKEN = rf"</?{_NAME}{_REST}|<[!?][^>]*+>|[^<]++|<"


def bare(html: Column) -> Column:
    """The page without comments and scripts; a comment leaves a mark, as it parts the texts beside it."""
    less = F.when(html.rlike(r"(?i)<!--|<script|<style"), F.regexp_replace(html, _LEFT_OUT, "$1<!>")).otherwise(html)
    return F.coalesce(less, F.lit(""))


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(bare(html), F.lit(_TOKEN), F.lit(0))


def anchors(html: Column, before: str = "") -> Column:
    """The start tags of the page's anchors; with `before` only those right behind that pattern."""
    if before:
        return F.regexp_extract_all(bare(html), F.lit(rf"(?i){before}(<a(?=[\s/>]){_REST})"), F.lit(1))
    found = F.regexp_extract_all(bare(html), F.lit(rf"<{_NAME}{_REST}"), F.lit(0))
    return F.filter(found, lambda tag: tag.rlike(r"^<[aA][\s/>]"))


def value_of(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag; null if it has none."""
    return _let(_attributes(tag), lambda held: attribute_of(held, name))


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


# --- character references -----------------------------------------------------------------------

_SEPARATOR = "\x01"


def _entities() -> Column:
    """Name (as written behind `&`) -> characters; one literal after constant folding."""
    names, values = (F.split(F.lit(_SEPARATOR.join(part)), _SEPARATOR) for part in (html5.keys(), html5.values()))
    return F.map_from_arrays(names, values)


_WITHOUT_SEMICOLON = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


def _code_point(n: Column) -> Column:
    """The character of a numeric reference; 0x80 to 0x9F stand for those of Windows, as browsers have it."""
    windows = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
    control = n.between(1, 8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F)
    none = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    character = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF) | n.isNull(), "�")
        .when(n.between(0x80, 0x9F), F.substring(F.lit(windows), (n - 0x7F).cast("int"), F.lit(1)))
        .when(control | none, "")
        .otherwise(character)
    )


def _decoded(part: Column, following: str) -> Column:
    number = F.regexp_extract(part, r"^&#([0-9]+|[xX][0-9a-fA-F]+);?", 1)
    hexadecimal = F.conv(F.substring(number, 2, 12), 16, 10).cast("long")
    n = F.when(number.rlike("^[xX]"), hexadecimal).otherwise(number.try_cast("long"))
    rest = F.regexp_replace(part, r"^&#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    name = F.substring(part, 2, 99)
    known = F.element_at(_entities(), name)
    short = F.regexp_extract(name, f"^({_WITHOUT_SEMICOLON}){following}", 1)
    return (
        F.when(~part.startswith("&") | (part == "&"), part)
        .when(number != "", F.concat(_code_point(n), rest))
        .when(known.isNotNull() & (name.endswith(";") | (short != "")), known)
        .when(short != "", F.concat(F.element_at(_entities(), short), F.substring(name, F.length(short) + 1, F.lit(99))))
        .otherwise(part)
    )


def unescape(text: Column, in_attribute: bool = False) -> Column:
    """The text with its character references resolved.

    Old names may lack their semicolon, but in an attribute not before `=`, a letter or a digit: `?a=1&copy=2`.
    """
    following = "(?![=A-Za-z0-9])" if in_attribute else ""
    parts = F.regexp_extract_all(text, F.lit(r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\f <&#;]{1,32};?|&|[^&]+"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(parts, lambda part: _decoded(part, following)), "")).otherwise(text)


# --- selectors ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """One step of a selector: all that it names must hold of an element."""

    tag: str
    classes: tuple[str, ...]
    ident: str
    #: (attribute, operator, value): `` the attribute is there, `=` equal, `*=` contains, `^=` begins, `$=` ends.
    attributes: tuple[tuple[str, str, str], ...]

    def hint(self, token: Column, tag: Column) -> Column:
        """Whether a start tag may fit, without looking into it."""
        tests = [token.contains(c) for c in self.classes]
        tests += [tag == self.tag] * bool(self.tag) + [token.contains(self.ident)] * bool(self.ident)
        out = F.lit(True)
        for test in tests:
            out &= test
        return out

    def fits(self, element: Column) -> Column:
        out = F.lit(True)
        if self.tag:
            out &= element["tag"] == self.tag
        for name in self.classes:
            out &= F.array_contains(element["classes"], name)
        if self.ident:
            out &= attribute(element, "id") == self.ident
        for name, operator, value in self.attributes:
            held = attribute(element, name)
            out &= {
                "": F.exists(element["attributes"], lambda a, name=name: a["name"] == name), "=": held == value,
                "*=": held.contains(value), "^=": held.startswith(value), "$=": held.endswith(value),
            }[operator]
        return F.coalesce(out, F.lit(False))


_PART = re.compile(r"""\.([^.#\[\s]+)|\#([^.#\[\s]+)|\[\s*([^\s\]=*^$]+)\s*(?:([*^$]?=)\s*("[^"]*"|'[^']*'|[^\]\s]*)\s*)?\]""")


def parse_selector(selector: str) -> list[Step]:
    """Steps separated by white space, each a tag with `.class`, `#id` and `[attribute*='value']` parts."""
    steps = []
    for text in re.findall(r"(?:\[(?:\"[^\"]*\"|'[^']*'|[^\]])*\]|[^\s\[])+", selector):
        tag = re.match(r"[^.#\[]*", text).group()
        parts, at = list(_PART.finditer(text, len(tag))), len(tag)
        for part in parts:
            if part.start() != at:
                break
            at = part.end()
        if at != len(text):
            raise ValueError(f"selector not understood: {selector!r}")
        attributes = tuple((p[3].lower(), p[4] or "", (p[5] or "").strip("\"'")) for p in parts if p[3])
        steps.append(Step(tag.lower().replace("*", ""), tuple(p[1] for p in parts if p[1]), "".join(p[2] or "" for p in parts), attributes))
    if not steps:
        raise ValueError("an empty selector")
    return steps


# --- elements -----------------------------------------------------------------------------------


def _attributes(token: Column) -> Column:
    inside = F.regexp_replace(token, rf"^<{_NAME}", "")
    found = F.regexp_extract_all(inside, F.lit(_ATTRIBUTE), F.lit(0))

    def parse(text: Column) -> Column:
        value = F.regexp_extract(text, r"(?s)^[^\s/>=]+\s*=\s*(.*)$", 1)
        quoted = value.startswith('"') | value.startswith("'")
        value = F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
        value = F.when(text.contains("="), unescape(value, in_attribute=True))
        return F.struct(F.lower(F.regexp_extract(text, r"^[^\s/>=]+", 0)).alias("name"), value.alias("value"))

    return F.transform(found, parse)


def attribute(element: Column, name: str) -> Column:
    """The value of an element's attribute; of repeated ones the last. Null if it has none."""
    return attribute_of(element["attributes"], name)


def attribute_of(attributes: Column, name: str) -> Column:
    return F.try_element_at(F.filter(attributes, lambda a: a["name"] == name), F.lit(-1))["value"]


def tags(stream: Column, steps: list[Step]) -> Column:
    """(at, tag, kind, picked) of every tag: kind 1 opens, 0 stands alone, -1 closes."""

    def tag(token: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(token, rf"^</?({_NAME})", 1))
        # A slash behind a value without quotes is part of the value.
        closed = token.endswith("/>") & ~token.rlike(r"""=\s*[^\s>"']+/>$""")
        alone = closed | name.isin(VOID)
        kind = F.when(token.startswith("</"), -1).when(alone, 0).otherwise(1)
        picked = F.lit(False)
        for step in dict.fromkeys(steps):
            picked |= step.hint(token, name)
        return F.struct(at.alias("at"), name.alias("tag"), kind.alias("kind"), (picked & (kind >= 0)).alias("picked"))

    all_tags = F.transform(stream, lambda token, at: F.when(token.rlike("^</?[A-Za-z]"), tag(token, at)))
    return F.filter(all_tags, lambda t: t.isNotNull())


_STATE = "struct<open:array<struct<at:int,tag:string,picked:boolean>>,closed:array<struct<at:int,end:int>>>"


def _leaves(of: Column) -> Column:
    """Struct of `closed`, (at, end) of picked elements that hold no others, and `rest`, all other tags.

    Most elements are such leaves: their end tag is the next tag, and they change nothing for the others.
    """

    def closes(first: Column, then: Column) -> Column:
        return F.coalesce((first["kind"] == 1) & (then["kind"] == -1) & (first["tag"] == then["tag"]), F.lit(False))

    def split(held: Column) -> Column:
        following = lambda t, i: F.get(held, i + 1)
        leaves = F.filter(held, lambda t, i: t["picked"] & closes(t, following(t, i)))
        ends = F.filter(held, lambda t, i: (t["kind"] == -1) & closes(F.get(held, i - 1), t) & F.get(held, i - 1)["picked"])
        closed = F.zip_with(leaves, ends, lambda t, e: F.struct(t["at"].alias("at"), e["at"].alias("end")))
        rest = F.filter(held, lambda t, i: ~closes(t, following(t, i)) & ~closes(F.get(held, i - 1), t))
        return F.struct(closed.alias("closed"), rest.alias("rest"))

    return _let(of, split)


def _closings(of: Column) -> Column:
    """(at, end) of the picked elements that are closed."""
    opening = F.filter(of, lambda t: t["kind"] != 0)
    return _let(_leaves(opening), lambda one: _let(_leaves(one["rest"]), lambda two: F.concat(one["closed"], two["closed"], _nested_closings(two["rest"]))))


def _nested_closings(of: Column) -> Column:
    none = F.struct(F.array().alias("open"), F.array().alias("closed"))

    def follow(state: Column, t: Column) -> Column:
        opened = F.struct(
            F.concat(state["open"], F.array(F.struct(t["at"].alias("at"), t["tag"].alias("tag"), t["picked"].alias("picked")))).alias("open"),
            state["closed"].alias("closed"),
        )

        def close(place: Column) -> Column:
            """Elements from the place-th on are closed; nothing if none is open by that name (place 0)."""
            gone = F.slice(state["open"], F.greatest(place, F.lit(1)), F.size(state["open"]))
            ends = F.transform(F.filter(gone, lambda o: o["picked"]), lambda o: F.struct(o["at"].alias("at"), t["at"].alias("end")))
            left = F.slice(state["open"], F.lit(1), F.greatest(place - 1, F.lit(0)))
            return F.when(place > 0, F.struct(left.alias("open"), F.concat(state["closed"], ends).alias("closed"))).otherwise(state)

        from_end = F.array_position(F.reverse(state["open"]["tag"]), t["tag"]).cast("int")
        place = F.when(from_end > 0, F.size(state["open"]) - from_end + 1).otherwise(0)
        return F.when(t["kind"] == 1, opened).otherwise(_let(place, close))

    return F.aggregate(of, none.cast(_STATE), follow, lambda state: state["closed"])


def elements(stream: Column, of: Column) -> Column:
    """(at, end, tag, classes, attributes) of the picked elements; those never closed end with the page."""

    def element(t: Column, closed: Column) -> Column:
        end = F.try_element_at(F.filter(closed, lambda c: c["at"] == t["at"]), F.lit(1))["end"]
        end = F.when(t["kind"] == 0, t["at"]).otherwise(F.coalesce(end, F.size(stream)))

        def build(attributes: Column) -> Column:
            named = F.filter(attributes, lambda a: a["name"] == "class")
            classes = F.split(F.trim(F.coalesce(F.try_element_at(named, F.lit(-1))["value"], F.lit(""))), r"\s+")
            return F.struct(t["at"].alias("at"), end.alias("end"), t["tag"].alias("tag"), classes.alias("classes"), attributes.alias("attributes"))

        return _let(_attributes(stream[t["at"]]), build)

    picked = F.filter(of, lambda t: t["picked"])
    return _let(_closings(of), lambda closed: F.transform(picked, lambda t: element(t, closed)))


def chosen(among: Column, steps: list[Step]) -> Column:
    """The elements that fit the last step and lie in elements that fit the ones before, from inside out."""

    def within(element: Column, before: list[Step]) -> Column:
        if not before:
            return F.lit(True)
        return F.exists(
            among,
            lambda outer: (outer["at"] < element["at"]) & (element["at"] < outer["end"]) & before[-1].fits(outer) & within(outer, before[:-1]),
        )

    return F.filter(among, lambda e: steps[-1].fits(e) & within(e, steps[:-1]))


def texts(stream: Column, among: Column) -> Column:
    """(at, text) of the page's texts that are not blank; those of templates are left out."""
    placed = F.transform(stream, lambda token, at: F.when(~token.rlike(r"^<[A-Za-z/!?]|^\s*$"), F.struct(at.alias("at"), token.alias("text"))))
    hidden = F.filter(among, lambda e: e["tag"] == "template")
    seen = lambda t, among: ~F.exists(among, lambda e: (e["at"] < t["at"]) & (t["at"] < e["end"]))
    return _let(hidden, lambda held: F.filter(placed, lambda t: t.isNotNull() & seen(t, held)))


def text_within(element: Column, of: Column) -> Column:
    """The texts inside an element, stripped and joined by spaces."""
    inside = F.filter(of, lambda t: (element["at"] < t["at"]) & (t["at"] < element["end"]))
    stripped = F.transform(inside, lambda t: strip(unescape(t["text"])))
    return F.array_join(F.filter(stripped, lambda t: t != ""), " ")
