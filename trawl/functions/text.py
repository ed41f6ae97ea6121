"""Text analysis as Column expressions, and positional phrase matching on token arrays.

Everything here is built from Spark's own array functions, so an analyzed column stays in the
JVM and a document of any length is handled inside its own row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a maximal run of letters and digits.
WORD = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Analyzer:
    """``split`` (words), ``ngram`` (character n-grams) or ``verbatim`` (the whole value)."""

    kind: str = "split"
    lower: bool = True
    min_n: int = 2
    max_n: int = 2

    def __post_init__(self) -> None:
        if self.kind not in ("split", "ngram", "verbatim"):
            raise ValueError(f"unknown analyzer kind: {self.kind}")
        if not 1 <= self.min_n <= self.max_n:
            raise ValueError("n-gram lengths need 1 <= min_n <= max_n")

    def tokens(self, text: Column) -> Column:
        """Ordered tokens of a text column; NULL text gives NULL."""
        if self.kind == "verbatim":
            return F.when(text.isNotNull(), F.array(text))
        text = F.lower(text) if self.lower else text
        if self.kind == "split":
            return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
        grams = [_ngrams(text, n) for n in range(self.min_n, self.max_n + 1)]
        return F.concat(*grams) if len(grams) > 1 else grams[0]

    def terms(self, text: str) -> list[str]:
        """Tokens of one query argument (a plan-time constant, never corpus text)."""
        if self.kind == "verbatim":
            return [text]
        text = text.lower() if self.lower else text
        if self.kind == "ngram":
            return [
                text[i:i + n]
                for n in range(self.min_n, self.max_n + 1)
                for i in range(len(text) - n + 1)
            ]
        spaced = (c if unicodedata.category(c)[0] in "LN" else " " for c in text)
        return "".join(spaced).split()


def _ngrams(text: Column, n: int) -> Column:
    return F.when(text.isNull(), None).when(
        F.length(text) >= n,
        F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: text.substr(i, F.lit(n))),
    ).otherwise(F.array().cast("array<string>"))


SPLIT_LOWER = Analyzer("split")
VERBATIM = Analyzer("verbatim")
BIGRAMS = Analyzer("ngram")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once per row for ``body``, which may use it many times."""
    return F.transform(F.array(value), body).getItem(0)


# -- term predicates ---------------------------------------------------------------------


def edit_budget(word: str) -> int:
    """Automatic edit distance: 0 up to two characters, 1 up to five, 2 beyond."""
    return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2


def any_startswith(terms: Column, prefix: str) -> Column:
    return F.exists(terms, lambda t: t.startswith(prefix))


def any_regex(terms: Column, pattern: str) -> Column:
    return F.exists(terms, lambda t: t.rlike(f"^(?:{pattern})$"))


def any_fuzzy(terms: Column, word: str) -> Column:
    budget = edit_budget(word)
    return F.exists(terms, lambda t: F.levenshtein(t, F.lit(word), budget) >= 0)


def string_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def match_any(terms: Column, words: Sequence[str], min_match: int | None = None) -> Column:
    if min_match is None:
        return F.arrays_overlap(terms, string_array(words))
    return F.size(F.array_intersect(terms, string_array(words))) >= min_match


def ngram_similarity(terms: Column, query_grams: Sequence[str]) -> Column:
    """Share of the query's distinct grams found among the field's grams."""
    distinct = list(dict.fromkeys(query_grams))
    if not distinct:
        return F.when(terms.isNotNull(), F.lit(0.0))
    return F.size(F.array_intersect(terms, string_array(distinct))) / F.lit(float(len(distinct)))


# -- phrases -----------------------------------------------------------------------------

Gap = "int | tuple[int, int]"


def phrase(
    terms: Column,
    segments: Sequence[Sequence[str]],
    gaps: Sequence[int | tuple[int, int]] = (),
    slop: int | None = None,
) -> Column:
    """Whether ``segments`` occur in order with the given token gaps between them.

    A gap is an exact number of tokens, or ``(lo, hi)``.  ``slop`` is a budget for the sum of
    absolute differences between actual and expected gaps; every token then counts as its own
    segment.  Positions are carried as sets, so the cost per row is linear in its length.
    """
    if any(not words for words in segments):
        return F.when(terms.isNotNull(), F.lit(False))
    if slop is not None:
        return let(terms, lambda t: _sloppy(t, segments, gaps, slop))
    return let(terms, lambda t: F.size(_ends(t, segments, gaps)) > 0)


def _starts(t: Column, words: Sequence[str]) -> Column:
    """0-based positions where ``words`` stand next to each other."""
    n, wanted = len(words), string_array(words)
    none = F.array().cast("array<int>")
    if n == 1:
        hit = lambda i: F.get(t, i) == wanted.getItem(0)
    else:
        hit = lambda i: F.slice(t, i + 1, n) == wanted
    return F.when(
        F.size(t) >= n, F.filter(F.sequence(F.lit(0), F.size(t) - n), hit)
    ).otherwise(none)


def _shift(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p + by)


def _span(positions: Column, lo: int, hi: int) -> Column:
    """Every position between ``lo`` and ``hi`` tokens after one of ``positions``."""
    return F.flatten(F.transform(positions, lambda p: F.sequence(p + lo, p + hi)))


def _ends(t: Column, segments, gaps) -> Column:
    """Positions just behind a complete match."""
    ends = _shift(_starts(t, segments[0]), len(segments[0]))
    for gap, words in zip(gaps, segments[1:]):
        lo, hi = (gap, gap) if isinstance(gap, int) else gap
        reach = _shift(ends, lo) if lo == hi else _span(ends, lo, hi)
        ends = _shift(F.array_intersect(_starts(t, words), reach), len(words))
    return ends


def _sloppy(t: Column, segments, gaps, slop: int) -> Column:
    """States are ``position * (slop + 1) + cost``; a step keeps those within the budget."""
    words: list[str] = list(segments[0])
    expected = [0] * (len(words) - 1)
    for gap, segment in zip(gaps, segments[1:]):
        expected += [gap] + [0] * (len(segment) - 1)
        words += segment
    width = slop + 1
    state = F.transform(_starts(t, words[:1]), lambda s: (s + 1) * width)
    for want, word in zip(expected, words[1:]):
        legal = _with_costs(_starts(t, [word]), width)
        state = _shift(F.array_intersect(_moves(state, want, slop), legal), width)
    return F.size(state) > 0


def _moves(state: Column, want: int, slop: int) -> Column:
    """States of the next word for every gap within the budget of each state."""
    width = slop + 1

    def of(p: Column) -> Column:
        steps = [
            F.when((p % width) + abs(d) <= slop, p + ((want + d) * width + abs(d)))
            for d in range(-min(want, slop), slop + 1)
        ]
        return F.array_compact(F.array(*steps))

    return F.flatten(F.transform(state, of))


def _with_costs(starts: Column, width: int) -> Column:
    costs = F.sequence(F.lit(0), F.lit(width - 1))
    return F.flatten(F.transform(
        starts, lambda s: F.transform(costs, lambda c: s * width + c)
    ))
