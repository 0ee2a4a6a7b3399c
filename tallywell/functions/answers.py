"""Raw answers to typed values. Every function takes and returns a Column and never throws on
a bad answer: what cannot be read becomes NULL."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = "[,、，;；]"
BLANKS = " \t\r\n　"
TRUE_WORDS = ("true", "t", "yes", "y", "1", "はい")
FALSE_WORDS = ("false", "f", "no", "n", "0", "いいえ")
FULL_WIDTH_DIGITS = "０１２３４５６７８９．－"
ASCII_DIGITS = "0123456789.-"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def half_width_number(text: Column) -> Column:
    return strip(F.translate(text, FULL_WIDTH_DIGITS, ASCII_DIGITS))


def to_submitted_at(text: Column, pattern: str | None = None) -> Column:
    if pattern is None:
        return F.try_to_timestamp(strip(text))
    return F.try_to_timestamp(strip(text), F.lit(pattern))


def to_boolean(text: Column) -> Column:
    word = F.lower(strip(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_satisfaction(text: Column, low: int = 1, high: int = 5) -> Column:
    """A whole number in the range; '4.0' is a 4, '4.5' is none."""
    return whole_number(half_width_number(text).try_cast("double"), low, high)


def whole_number(number: Column, low: float | None = None, high: float | None = None) -> Column:
    ok = number == F.floor(number)
    if low is not None:
        ok = ok & number.between(low, high)
    return F.when(ok, number.try_cast("int"))


def to_number(text: Column, low: float | None = None, high: float | None = None) -> Column:
    number = half_width_number(text).try_cast("double")
    ok = ~F.isnan(number)
    if low is not None:
        ok = ok & (number >= low)
    if high is not None:
        ok = ok & (number <= high)
    return F.when(ok, number)


def multi_select(text: Column, separators: str = SEPARATORS) -> Column:
    """'a, b,,a' to ['a', 'b']; '' to []; NULL stays NULL."""
    return cleaned(F.split(text, separators, -1))


def text_list(text: Column, separators: str = SEPARATORS) -> Column:
    """A list held in a text: JSON if it starts like JSON, else separated values; cleaned alike.

    A text that starts with '[' but is no JSON list from end to end is damaged and gives NULL.
    """
    return F.when(looks_like_json(text), cleaned(_json_list(text))).otherwise(multi_select(text, separators))


def cleaned(values: Column) -> Column:
    """Without blanks at the ends, empty or missing values, and repeats."""
    return F.array_distinct(F.filter(F.transform(values, strip), lambda p: F.length(p) > 0))


def _json_list(text: Column) -> Column:
    # As the only element of a list, a list with anything behind it is no JSON or not the only one.
    lists = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<array<string>>")
    return F.when(F.size(lists) == 1, lists[0])


def looks_like_json(text: Column) -> Column:
    return F.substring(strip(text), 1, 1) == "["


def is_damaged_list(text: Column) -> Column:
    return looks_like_json(text) & _json_list(text).isNull()


def band(value: Column, edges: Sequence[float], codes: Sequence[str]) -> Column:
    """The code of the band ``value`` falls in; band i holds edges[i-1] <= value < edges[i]."""
    if len(codes) != len(edges) + 1:
        raise ValueError("one more code than edges is needed")
    if list(edges) != sorted(set(edges)):
        raise ValueError("edges must rise")
    out = F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(None).cast("string"))
    for edge, code in zip(edges, codes):
        out = out.when(value < edge, code)
    return out.otherwise(codes[-1])


def bands_of(table: DataFrame) -> list[tuple[float, float, str]]:
    """Read a (low, high, code) band table of any length, refusing one whose bands overlap."""
    rows = table.select("low", "high", "code").orderBy("low").collect()
    for a, b in zip(rows, rows[1:]):
        if b["low"] < a["high"]:
            raise ValueError(f"bands {a['code']!r} and {b['code']!r} overlap")
    return [(r["low"], r["high"], r["code"]) for r in rows]


def band_from(value: Column, bands: Sequence[tuple[float, float, str]]) -> Column:
    """The code of the band with low <= value < high; NULL in a gap. Bands do not overlap, so the only
    candidate is the last one that starts at or below the value."""
    ordered = sorted(bands)
    if not ordered:
        return F.lit(None).cast("string")

    def numbers(values: list[float]) -> Column:
        return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")

    number = value.cast("double")
    place = F.size(F.filter(numbers([b[0] for b in ordered]), lambda low: low <= number))
    codes = F.from_json(F.lit(json.dumps([b[2] for b in ordered])), "array<string>")
    inside = (place > 0) & ~F.isnan(number) & (number < F.get(numbers([b[1] for b in ordered]), place - 1))
    return F.when(inside, F.get(codes, place - 1))


def rank_of(code: Column, order: Sequence[str]) -> Column:
    """Place of a code in its documented order, from 1; NULL for an unknown code."""
    place = F.array_position(F.array(*[F.lit(c) for c in order]), code)
    return F.when(place > 0, place)
