"""Term lists that find phrases in a comment and score the category labels.

A ``Lexicon`` is short enough to be written into the query itself, so that finding, labelling and
scoring are one projection over the comment: no join and no shuffle. A longer list stays a
DataFrame and goes through ``operators.long_lists``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.functions.text import LETTERS, SENTENCE_END, sentences
from tallywell.schema import CATEGORIES

MAX_INLINE_TERMS = 500


@dataclass(frozen=True)
class Lexicon:
    """(term, label, weight) entries; a scene list has no labels.

    ``whole_words`` matches terms as words of letters. Without it a term matches anywhere, the
    longest term first, and matches do not overlap; that is the form for Japanese. No term may hold
    what ends a sentence, so that hits of a comment are hits of its sentences.
    """

    entries: tuple[tuple[str, str | None, int], ...]
    whole_words: bool = True
    labels: tuple[str, ...] = tuple(CATEGORIES)
    sentence_end: str = SENTENCE_END

    def __post_init__(self) -> None:
        terms = self.terms
        if not terms:
            raise ValueError("a lexicon needs at least one term")
        if len(terms) > MAX_INLINE_TERMS:
            raise ValueError(f"more than {MAX_INLINE_TERMS} terms: use operators.long_lists")
        for term, label, weight in self.entries:
            if not term or term != term.lower():
                raise ValueError(f"terms are non-empty and lower case: {term!r}")
            if re.search(self.sentence_end, term):
                raise ValueError(f"a sentence ends inside the term {term!r}")
            if weight < 1:
                raise ValueError(f"weights are positive: {term!r}")
            if label is not None and label not in self.labels:
                raise ValueError(f"unknown label {label!r}")
        if len({(t, lab) for t, lab, _ in self.entries}) != len(self.entries):
            raise ValueError("a (term, label) pair occurs twice")

    @classmethod
    def of(cls, entries: Iterable[Sequence], **options) -> Lexicon:
        return cls(tuple((e[0], e[1], int(e[2])) for e in entries), **options)

    @classmethod
    def of_terms(cls, terms: Iterable[str], **options) -> Lexicon:
        return cls(tuple((t, None, 1) for t in terms), **options)

    @classmethod
    def from_table(cls, table: DataFrame, **options) -> Lexicon:
        """Read a whole (term, label, weight) table; its terms are counted first, since a long list stays a table."""
        rows = table.select("term", "label", "weight")
        if rows.select("term").distinct().limit(MAX_INLINE_TERMS + 1).count() > MAX_INLINE_TERMS:
            raise ValueError(f"more than {MAX_INLINE_TERMS} terms: use operators.long_lists")
        return cls.of(rows.collect(), **options)

    @property
    def terms(self) -> list[str]:
        return sorted({t for t, _, _ in self.entries}, key=lambda t: (-len(t), t))

    @property
    def pattern(self) -> str:
        any_term = "|".join(re.escape(t) for t in self.terms)
        if self.whole_words:
            return f"(?<![{LETTERS}])({any_term})(?![{LETTERS}])"
        return f"({any_term})"

    def found_in(self, text: Column) -> Column:
        return F.lower(text).rlike(self.pattern)

    def hits(self, text: Column) -> Column:
        return F.regexp_extract_all(F.lower(text), F.lit(self.pattern), F.lit(1))

    def phrases(self, text: Column) -> Column:
        return F.filter(sentences(text, self.sentence_end), self.found_in)

    def phrases_with_hits(self, text: Column) -> Column:
        """array<struct<phrase, hits>> of the sentences with a term, each searched once."""
        searched = F.transform(sentences(text, self.sentence_end), lambda s: F.struct(
            s.alias("phrase"), self.hits(s).alias("hits")))
        return F.filter(searched, lambda p: F.size(p["hits"]) > 0)

    def scores(self, hits: Column) -> Column:
        """array<struct<score, place, label>>, one element per label the lexicon knows."""
        by_label: dict[str, dict[int, list[str]]] = defaultdict(lambda: defaultdict(list))
        for term, label, weight in self.entries:
            if label is not None:
                by_label[label][weight].append(term)
        sums = {
            label: reduce(
                lambda a, b: a + b,
                [_count_of(hits, terms) * weight for weight, terms in weights.items()],
            )
            for label, weights in by_label.items()
        }
        return score_array(sums, self.labels)


def _count_of(hits: Column, terms: list[str]) -> Column:
    return F.size(F.filter(hits, lambda h: h.isin(*terms))).cast("bigint")


def score_array(sums: dict[str, Column], labels: Sequence[str]) -> Column:
    # ``place`` falls with the label number, so the greatest struct breaks a tie by the lower one.
    return F.array(*[
        F.struct(sums[label].alias("score"), F.lit(-i).alias("place"), F.lit(label).alias("label"))
        for i, label in enumerate(labels, 1) if label in sums
    ])


def best_label(scores: Column) -> Column:
    """struct<label, score, confidence> of the top label; its fields are NULL where nothing scored."""
    top = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s["score"].cast("double"))
    scored = top["score"] > 0
    return F.struct(
        F.when(scored, top["label"]).alias("label"),
        F.when(scored, top["score"]).alias("score"),
        F.when(scored, F.try_divide(top["score"].cast("double"), total)).alias("confidence"),
    )


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are costly to work out, so that each is worked out once per row.

    A plain projection would be copied into every filter on its result. A generator of exactly one
    row is not: filters on other columns still pass it on their way to the scan, those on its own
    output stay above it.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
