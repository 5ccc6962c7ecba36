"""Text expressions: identifiers, classes, labels, markup, names."""

from __future__ import annotations

import html as html_module
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Millimetres of a unit.
MILLIMETRES = {"mm": 1.0, "cm": 10.0, "µm": 0.001, "um": 0.001}


@F.pandas_udf(T.StringType())
def unescaped(c: pd.Series) -> pd.Series:
    """Named and numeric character references as the characters they stand for; the standard's table has over two thousand."""
    return c.map(html_module.unescape, na_action="ignore")


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, null where it does not match."""
    return or_null(F.regexp_extract(c, pattern, group))


def labelled_pairs(c: Column, labels: Mapping[str, str]) -> Column:
    """Struct of named values from "label: value; label: value", also with "|" between.

    Split at the first colon; values are trimmed, empty ones are null; of repeated labels the last counts;
    other labels are ignored. labels maps a label to the field's name.
    """
    parts = F.split(c, r"\s*[;|]\s*")

    def value(label: str) -> Column:
        own = F.filter(parts, lambda p: F.contains(p, F.lit(":")) & (F.trim(F.substring_index(p, ":", 1)) == label))
        last = F.try_element_at(own, F.lit(-1))
        return or_null(F.trim(F.substr(last, F.instr(last, ":") + 1)))

    return F.struct(*[value(label).alias(name) for label, name in labels.items()])


def url_file(url: Column) -> Column:
    """Last part of a URL's path, without query and fragment."""
    return F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def without_size(name: Column) -> Column:
    return F.regexp_replace(name, "_(lg|tn)$", "")


def first_contained(c: Column, words: Sequence[str]) -> Column:
    """The first of words, in their order, that the lower-cased text contains."""
    found = F.lit(None).cast("string")
    for w in reversed(words):
        found = F.when(F.contains(F.lower(c), F.lit(w)), w).otherwise(found)
    return found


def cascade(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """The name of the first rule that holds; null is no."""
    found = F.lit(default)
    for condition, name in reversed(rules):
        found = F.when(condition, name).otherwise(found)
    return found


def image_kind(collection: Column, url: Column) -> Column:
    """bycatch, tray_ethanol, pinned or individual, from an image's collection and file name."""
    name = without_size(stem(url_file(url)))
    by_prefix = F.lit(False)
    for p in ("IVBC", "HEVC", "MAMC"):  # fixed values: bycatch collections
        by_prefix = by_prefix | F.startswith(collection, F.lit(p))
    pinned = collection.isin("CARC-PV", "DCTC", "NEON-IV")  # fixed values: pinned collections
    return cascade([(by_prefix, "bycatch"), (F.rlike(name, F.lit(r"^A\d{11}$")), "tray_ethanol"), (pinned, "pinned")], "individual")


def image_view(url: Column) -> Column:
    return first_contained(stem(url_file(url)), ("dorsal", "ventral", "lateral"))


def plain_text(html: Column) -> Column:
    """Text of an HTML fragment: list items marked, tags as spaces, all character references decoded, white space single."""
    text = F.regexp_replace(F.regexp_replace(html, "<li[^>]*>", " - "), "<[^>]+>", " ")
    return or_null(F.trim(F.regexp_replace(unescaped(text), r"(?U)\s+", " ")))


def part_count(c: Column, sep: str = r"\|") -> Column:
    """Non-empty parts of a delimited text; null has none."""
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), sep), lambda x: x != ""))


def padded(c: Column, width: int) -> Column:
    """Zeros on the left up to width; longer texts are not cut."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def binomial(name: Column) -> Column:
    """First two words of a scientific name, or one where the second begins like an open name (sp, cf, nr)."""
    words = F.split(F.trim(name), r"\s+")
    second = F.try_element_at(words, F.lit(2))
    is_open = second.isNull() | F.rlike(second, F.lit("^(sp|cf|nr)"))
    return F.when(is_open, words[0]).otherwise(F.concat_ws(" ", words[0], second))


def label_millimetres(c: Column) -> Column:
    """Millimetres of a read scale label, with common misreadings of "mm" repaired; null where there is none."""
    text = F.replace(F.replace(c, F.lit("rnm"), F.lit("mm")), F.lit("rn"), F.lit("m"))
    pattern = r"(\d+(?:[.,]\d+)?)\s*((?i:mm|cm|µm|um))"
    value = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")
    unit = F.lower(F.regexp_extract(text, pattern, 2))
    factor = F.lit(None).cast("double")
    for name, mm in MILLIMETRES.items():
        factor = F.when(unit == name, mm).otherwise(factor)
    return value * factor


def prompt(*parts: Column, sep: str = ", ") -> Column:
    """Parts joined, without null and empty ones."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), sep)


def line_coords(json: Column) -> Column:
    """x1, y1, x2, y2 of the first of a JSON list of lines, as lists or as objects; nulls where there is none."""
    lists = F.from_json(json, "array<array<double>>")
    objects = F.from_json(json, "array<struct<x1:double,y1:double,x2:double,y2:double>>")
    first = F.try_element_at(lists, F.lit(1))
    obj = F.try_element_at(objects, F.lit(1))
    return F.struct(*[F.coalesce(F.try_element_at(first, F.lit(i + 1)), obj[n]).alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def tuple_ints(c: Column) -> Column:
    """Integers of a literal tuple such as (h, w, c)."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"-?\d+"), F.lit(0)), lambda x: x.cast("int"))
