"""One search of a comment for any number of term lists at once.

Lists of up to ``MAX_CHARACTERS`` in all are sent to the executors, and every Python worker makes of them, once, a word
table and an Aho-Corasick automaton. Sentences go there in Arrow batches, and only what was found comes back:
per sentence and list the best label with its score, and for the whole comment the score of each label. So labels,
phrases and feedback rows of all lists need one pass over the text, no join and no shuffle, and a list may have very
many terms.

A list finds what its pattern would: the longest term first, from left to right, without overlap, and whole words
only between characters that are no letters.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.memory import bounded_batches, released
from tallywell.functions.text import LETTERS, SENTENCE_END
from tallywell.schema import CATEGORIES

#: Bound of what is sent: characters of all terms together.
MAX_CHARACTERS = 2_000_000
#: Bytes of text that a worker searches before it gives back what it has found.
SLICE_BYTES = 512 << 10
FOUND = "array<struct<no: int, list: int, label: int, score: bigint>>"
#: Fixed value: number of the whole comment among its sentences.
WHOLE = -1
#: The best of no labels: score 0 of label -1, which any score exceeds.
NOTHING = (0, 1)
Entry = tuple[str, str | None, int]


@dataclass(frozen=True)
class TermList:
    """(term, label, weight) entries in lower case, of any number. A label that is not in ``labels`` does not score."""

    entries: tuple[Entry, ...]
    whole_words: bool = True
    labels: tuple[str, ...] = tuple(CATEGORIES)
    sentence_end: str = SENTENCE_END

    def __post_init__(self) -> None:
        if any(not t or t != t.lower() or w < 1 for t, _, w in self.entries):
            raise ValueError("terms are non-empty and lower case, weights positive")

    @property
    def characters(self) -> int:
        return sum(len(t) for t, _, _ in self.entries)


def table_fits(terms: DataFrame) -> bool:
    """Whether a (term, label, weight) table is small enough to be sent."""
    return (terms.agg(F.sum(F.length("term"))).first()[0] or 0) <= MAX_CHARACTERS


def list_of(terms: DataFrame, **options) -> TermList:
    """Read a whole (term, label, weight) table, which ``table_fits`` has measured."""
    if not table_fits(terms):
        raise ValueError(f"more than {MAX_CHARACTERS} characters: use operators.long_lists")
    return TermList(tuple((r[0], r[1], int(r[2])) for r in terms.select("term", "label", "weight").collect()), **options)


class Finder:
    """The tables of a worker."""

    def __init__(self, lists: Sequence[TermList]) -> None:
        self.run = re.compile(f"[{LETTERS}]+")
        self.letter = re.compile(f"[{LETTERS}]").match
        self.scores: list[dict[str, list[tuple[int, int]]]] = []
        self.words: dict[str, list[int]] = {}
        self.anywhere, self.whole = ahocorasick.Automaton(), [x.whole_words for x in lists]
        by_term: dict[str, list[int]] = defaultdict(list)
        for number, own in enumerate(lists):
            place = {label: i for i, label in enumerate(own.labels)}
            scores: dict[str, list[tuple[int, int]]] = {}
            for term, label, weight in own.entries:
                scores.setdefault(term, []).append((place.get(label, -1), weight))
            self.scores.append(scores)
            # Terms of letters only are runs of letters; others are looked for at every place.
            by_run = own.whole_words and all(self.run.fullmatch(t) for t in scores)
            for term in scores:
                (self.words.setdefault(term, []) if by_run else by_term[term]).append(number)
        for term, numbers in by_term.items():
            self.anywhere.add_word(term, (len(term), numbers))
        self.searched = bool(by_term)
        if self.searched:
            self.anywhere.make_automaton()

    def terms(self, text: str) -> list[tuple[int, str]]:
        """(list, term) of all hits in a text in lower case."""
        out = []
        if self.words:
            known = self.words
            out = [(number, word) for word in self.run.findall(text) if word in known for number in known[word]]
        return out + self._anywhere(text) if self.searched else out

    def _anywhere(self, text: str) -> list[tuple[int, str]]:
        longest: dict[int, dict[int, int]] = {}
        for last, (size, numbers) in self.anywhere.iter(text):
            end = last + 1
            start = end - size
            for number in numbers:
                if not self.whole[number] or self._alone(text, start, end):
                    # Ends come in rising order, so a later one at a start is the longer.
                    longest.setdefault(number, {})[start] = end
        out = []
        for number, found in longest.items():
            free = 0
            for start in sorted(found):
                if start >= free:
                    free = found[start]
                    out.append((number, text[start:free]))
        return out

    def _alone(self, text: str, start: int, end: int) -> bool:
        return not (start and self.letter(text[start - 1])) and not (end < len(text) and self.letter(text[end]))

    def found(self, sentences: list[str]) -> list[tuple[int, int, int, int]]:
        """(sentence, list, best label, score) of each sentence with hits, and (WHOLE, list, label, score) of each label.

        The label is -1 where only terms without a label were found. A tie goes to the lower label.
        """
        out: list[tuple[int, int, int, int]] = []
        total: dict[tuple[int, int], int] = {}
        for no, sentence in enumerate(sentences):
            hits = self.terms(sentence)
            if hits:
                own: dict[tuple[int, int], int] = {}
                for number, term in hits:
                    for label, weight in self.scores[number][term]:
                        own[number, label] = own.get((number, label), 0) + weight
                best: dict[int, tuple[int, int]] = {}
                for (number, label), score in own.items():
                    best[number] = max(best.get(number, NOTHING), (score if label >= 0 else 0, -label))
                    total[number, label] = total.get((number, label), 0) + score
                out += [(no, number, -place, score) for number, (score, place) in best.items()]
        out += [(WHOLE, *key, score) for key, score in total.items()]
        return out


def slices(batch: pa.ListArray, most: int = SLICE_BYTES) -> Iterator[pa.ListArray]:
    """Runs of comments with about ``most`` bytes of text; a comment is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.values), 0).to_numpy(zero_copy_only=False)
    at = np.append(0, np.cumsum(sizes, dtype=np.int64))[batch.offsets.to_numpy()]
    low = 0
    while low < len(batch):
        high = int(np.searchsorted(at, at[low] + most, "right")) - 1
        high = min(max(high, low + 1), len(batch))
        yield batch.slice(low, high - low)
        low = high


def finder(spark: SparkSession, lists: Sequence[TermList]):
    """A column function from the sentences of a comment, in lower case, to what the lists find in them."""
    if sum(x.characters for x in lists) > MAX_CHARACTERS:
        raise ValueError(f"more than {MAX_CHARACTERS} characters: use operators.long_lists")
    shared = spark.sparkContext.broadcast(tuple(lists))
    bounded_batches(spark)

    @F.arrow_udf(FOUND)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = Finder(shared.value)
        for batch in (part for whole in batches for part in slices(whole)):
            offsets, flat, cuts = [0], [], batch.to_pylist()
            for sentences in cuts:
                flat += tables.found(sentences) if sentences else []
                offsets.append(len(flat))
            columns = list(zip(*flat, strict=True)) or [(), (), (), ()]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            fields = pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["no", "list", "label", "score"])
            missing = pa.array([s is None for s in cuts], pa.bool_())
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields, mask=missing)
        released()

    return search


def of_list(found: Column, number: int, whole: bool) -> Column:
    """The entries of one list, of the whole comment or of its sentences in text order."""
    return F.filter(found, lambda x: (x["list"] == number) & ((x["no"] == WHOLE) if whole else (x["no"] != WHOLE)))


def label_scores(found: Column, labels: Sequence[str]) -> Column:
    """Entries to the array<struct<score, place, label>> that ``lexicon.best_label`` chooses from."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(F.filter(found, lambda x: x["label"] >= 0), lambda x: F.struct(
        x["score"].alias("score"), (-x["label"]).alias("place"), F.get(names, x["label"]).alias("label")))
