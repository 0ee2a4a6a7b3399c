"""Free text: sentences, words and character n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywell.functions.answers import BLANKS

SENTENCE_END = "[.!?\\n。！？]+"
# For text that writes numbers with a point, as in "0.00%", and ends sentences in Japanese style.
JAPANESE_SENTENCE_END = "[!?\\n。！？]+"
LETTERS = "a-zà-ÿ"


def sentences(text: Column, end: str = SENTENCE_END) -> Column:
    parts = F.transform(F.split(text, end, -1), lambda s: F.btrim(s, F.lit(BLANKS)))
    return F.filter(parts, lambda s: F.length(s) > 0)


def words(text: Column, letters: str = LETTERS) -> Column:
    parts = F.split(F.lower(text), f"[^{letters}]+", -1)
    return F.filter(parts, lambda w: F.length(w) > 0)


def char_ngrams(text: Column, n: int = 2) -> Column:
    """All runs of n neighbouring characters.

    An empty match with a look-ahead is tried at every place, so the runs overlap. A place inside a
    surrogate pair is left out, or a character beyond the basic plane would give a broken run.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    pattern = "(?s)(?![\\uDC00-\\uDFFF])(?=(" + "." * n + "))"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def place_of(text: Column, term: str) -> Column:
    """The first place of ``term`` in a text, in any case, from 1; 0 without one."""
    return F.regexp_instr(text, F.lit("(?iu)" + "".join(f"\\x{{{ord(c):x}}}" for c in term)))


def snippet(text: Column, term: str, width: int = 20) -> Column:
    """The first place that holds ``term``, with up to ``width`` characters on both sides."""
    at = place_of(text, term)
    start = F.greatest(at - width, F.lit(1))
    return F.when(at > 0, text.substr(start, at - start + F.lit(len(term) + width)))
