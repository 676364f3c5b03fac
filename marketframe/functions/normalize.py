"""Row normalisation: blanks, sentinels, sets, numbers, notes and headline text."""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .codes import SPECIAL_CONDITION, map_values

INT_UNSET = 2147483647
DOUBLE_UNSET = sys.float_info.max

# Decimal text only: Spark and Python disagree on suffixes and digit separators ("1d", "1_0").
_NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in string columns; elements of sets stay as they are."""
    blanks = {
        f.name: F.nullif(F.col(f"`{f.name}`"), F.lit(""))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(blanks) if blanks else df


def null_to_blank(c: Column) -> Column:
    """Text for a key that is compared or joined as text: NULL reads as blank."""
    return F.coalesce(c.cast("string"), F.lit(""))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal inputs are stored as doubles."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(casts) if casts else df


def unset_int(c: Column) -> Column:
    return F.nullif(c, F.lit(INT_UNSET))


def unset_double(c: Column) -> Column:
    return F.nullif(c, F.lit(DOUBLE_UNSET))


def positive_or_null(c: Column) -> Column:
    return F.when(c > 0, c)


def tick_price(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def option_right(c: Column) -> Column:
    return F.nullif(c, F.lit("?"))


def multiplier(c: Column) -> Column:
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")).cast("double"), F.lit(1.0))


def string_set(elements: Column) -> Column:
    """An order-free set of strings: distinct, sorted; NULL stays NULL."""
    return F.array_sort(F.array_distinct(F.transform(elements, lambda x: x.cast("string"))))


def split_set(text: Column, delimiter: str) -> Column:
    """Delimited text as a set; the empty text is the set holding one empty string."""
    return string_set(F.split(text, f"[{delimiter}]"))


def tag_value_set(pairs: Column) -> Column:
    """Array of (tag, value) structs as a set of ``tag=value``; an empty array is NULL."""
    tags = F.transform(pairs, lambda p: F.concat(p["tag"], F.lit("="), p["value"]))
    return F.when(F.size(pairs) > 0, string_set(tags))


def coded_set(text: Column, codes: Mapping) -> Column:
    """One code per non-blank character of the text, named; NULL and empty text give NULL."""
    letters = F.split(F.regexp_replace(text, r"\s", ""), "")
    letters = F.filter(letters, lambda x: x != "")
    return F.when(F.length(text) > 0, string_set(F.transform(letters, lambda x: map_values(x, codes))))


def special_conditions(text: Column) -> Column:
    return coded_set(text, SPECIAL_CONDITION)


def yield_date(c: Column) -> Column:
    """Integer ``yyyymmdd`` as ``yyyy-mm-dd``; 0 is no date."""
    digits = F.lpad(c.cast("string"), 8, "0")
    dashed = F.concat_ws("-", digits.substr(1, 4), digits.substr(5, 2), digits.substr(7, 2))
    return F.when(c != 0, dashed)


def lenient_double(text: Column) -> Column:
    """A number where the text is one, else NULL."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def note_value(note: Column, key: str) -> Column:
    """The value under a key of a flat JSON note; NULL without the key or the note."""
    return F.try_element_at(F.from_json(note, "map<string,string>"), F.lit(key))


def note_json(values: Mapping[str, Column]) -> Column:
    """A flat JSON note whose values are all strings."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return F.to_json(F.create_map(*pairs))


_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names by their first letter, with their ``;`` and, where HTML 5 allows it, without; those without again.
_NAMES = {c: {k: v for k, v in html5.items() if k[0] == c} for c in sorted({k[0] for k in html5})}
_OPEN_NAMES = {c: {k: v for k, v in of.items() if not k.endswith(";")} for c, of in _NAMES.items()}
_OPEN_LENGTHS = sorted({len(k) for of in _OPEN_NAMES.values() for k in of}, reverse=True)
#: What the numbers 128 to 159 stand for.
_WINDOWS_1252 = "\u20ac\x81\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\x8d\u017d\x8f\x90\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\x9d\u017e\u0178"


def html_unescape(text: Column) -> Column:
    """Text with its character references decoded as HTML 5 does (and Python's ``html.unescape``).

    Names may lack their ``;`` where HTML 5 allows it, the longest one counts, and unknown ones stay as they
    are. Numbers of no character become U+FFFD, those of control characters and noncharacters nothing.
    """
    names, open_names = (F.from_json(F.lit(json.dumps(m)), "map<string,map<string,string>>") for m in (_NAMES, _OPEN_NAMES))

    def character(code: Column) -> Column:
        none = code.between(1, 8) | code.isin(11, 127) | code.between(14, 31) | code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE)
        return (
            F.when(code.between(128, 159), F.substring(F.lit(_WINDOWS_1252), (code - 127).cast("int"), F.lit(1)))
            .when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), "\ufffd")
            .when(none, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        )

    def number(name: Column) -> Column:
        digits = F.regexp_replace(name, "^#[xX]?0*|;$", "")
        # More than 9 digits are beyond all characters in either base.
        value = F.when(name.rlike("^#[xX]"), F.conv(F.concat(F.lit("0"), digits), 16, 10)).otherwise(F.concat(F.lit("0"), digits))
        return F.when(F.length(digits) > 9, F.lit(0x110000).cast("long")).otherwise(value.cast("long"))

    def decoded(reference: Column) -> Column:
        name = F.substring(reference, 2, F.length(reference))
        first = F.substring(name, 1, 1)
        starts = [
            F.when(F.length(name) > n, F.concat(F.try_element_at(F.try_element_at(open_names, first), F.substring(name, 1, n)), F.substring(name, n + 1, F.length(name))))
            for n in _OPEN_LENGTHS
        ]
        named = F.coalesce(F.try_element_at(F.try_element_at(names, first), name), *starts, reference)
        return F.when(name.startswith("#"), character(number(name))).otherwise(named)

    found = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), decoded)
    pieces = F.zip_with(F.split(text, _REFERENCE, -1), found, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def clean_headline(headline: Column) -> Column:
    """The text after the first closing brace; the whole text without one."""
    return F.element_at(F.split(headline, "[}]", 2), -1)


def position_exchange(sec_type: Column, exchange: Column) -> Column:
    return F.when(sec_type == "STK", F.lit("SMART")).otherwise(exchange)


def round_half_up(c: Column) -> Column:
    """Whole number, halves toward positive infinity."""
    return F.floor(c + F.lit(0.5))


def mid(bid: Column, ask: Column) -> Column:
    return F.lit(0.5) * (bid + ask)
