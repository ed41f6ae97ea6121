"""Terms of an analyzed field, indexed: a dictionary, grams of its terms, and postings.

A term predicate is first answered on the dictionary, which is small beside the rows: a prefix is a
range of it, a misspelt word or a pattern fetches candidate terms by the pairs of characters they must
share with it, and only those are verified. The terms found then name their rows by their postings. No
row is analyzed again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import text as tx
from trawl.functions.text import Analyzer, edit_budget
from trawl.operators.lexical import LexicalIndex

#: Marks before and after a term when it is cut into pairs of characters.
BEGIN, END = "\x02", "\x03"


def pairs_of(marked: str) -> list[str]:
    """Distinct pairs of neighbouring characters, in order."""
    return list(dict.fromkeys(marked[i:i + 2] for i in range(len(marked) - 1)))


def required_texts(pattern: str) -> list[str]:
    """Texts that every match of a regular expression holds, as far as is plain to see.

    Only literals that stand outside of choices and repetitions count. A pattern that Python does not
    read as Java does, or not at all, gives none; it is then verified on every term.
    """
    if re.search(r"\\[^\\.\-+*?()\[\]{}|^$/ dwsDWSbB]|\(\?|[*+?}]\+|&&|\[\[|\\Q", pattern):
        return []
    try:
        parsed = rp.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return []
    found, current = [], []

    def walk(nodes) -> None:
        nonlocal current
        for kind, value in nodes:
            if kind is rc.LITERAL:
                current.append(chr(value))
            elif kind is rc.SUBPATTERN:
                walk(value[-1])
            else:
                found.append("".join(current))
                current = []
                if kind is rc.MAX_REPEAT and value[0] > 0:
                    walk(value[-1])
                    found.append("".join(current))
                    current = []

    walk(parsed)
    found.append("".join(current))
    return [t for t in found if t]


@dataclass
class FieldTerms:
    """Index of one field: ``lexical`` holds postings with positions and the dictionary ``terms``;
    ``pairs`` (``pair, term``) leads from characters to terms."""

    lexical: LexicalIndex
    pairs: DataFrame

    @classmethod
    def build(cls, rows: DataFrame, id: str, value: Column, analyzer: Analyzer, buckets: int = 64) -> FieldTerms:
        """Of ``value``, a text column or a promoted JSON field; a null value has no terms."""
        docs = rows.select(F.col(id).alias("id"), value.cast("string").alias("value"))
        lexical = LexicalIndex.build(docs, "id", "value", analyzer, positions=True, buckets=buckets)
        return cls(lexical, cls.pairs_of_terms(lexical.terms))

    @staticmethod
    def pairs_of_terms(terms: DataFrame) -> DataFrame:
        marked = F.concat(F.lit(BEGIN), "term", F.lit(END))
        places = F.sequence(F.lit(1), F.length("term") + 1)
        pairs = F.array_distinct(F.transform(places, lambda i: marked.substr(i, F.lit(2))))
        return terms.select(F.explode(pairs).alias("pair"), "term")

    def write(self, store) -> FieldTerms:
        lexical = self.lexical.write(store)
        pairs = self.pairs_of_terms(lexical.terms).repartitionByRange("pair", "term").sortWithinPartitions("pair", "term")
        return FieldTerms(lexical, store.save("pairs", pairs))

    @classmethod
    def read(cls, store, analyzer: Analyzer) -> FieldTerms:
        return cls(LexicalIndex.read(store, analyzer), store.load("pairs"))

    # -- terms ----------------------------------------------------------------------------

    def starting(self, prefix: str) -> DataFrame:
        return self.lexical.terms.where(F.col("term").startswith(prefix)).select("term")

    def near(self, word: str) -> DataFrame:
        """Terms within the automatic edit distance of the word.

        An edit touches two neighbouring pairs, so the others are shared; words too short for that to
        leave any are compared with all terms of about their length.
        """
        budget = edit_budget(word)
        fits = F.levenshtein(F.col("term"), F.lit(word), budget) >= 0
        pairs = pairs_of(BEGIN + word + END)
        least = len(pairs) - 2 * budget
        if not budget:
            return self.lexical.terms.where(F.col("term") == word).select("term")
        if least < 1:
            length = F.length("term")
            return self.lexical.terms.where(length.between(len(word) - budget, len(word) + budget) & fits).select("term")
        return self._sharing(pairs, least).where(fits)

    def matching(self, pattern: str) -> DataFrame:
        """Terms that the whole pattern matches."""
        wanted = [p for t in required_texts(pattern) for p in pairs_of(t)]
        terms = self._sharing(wanted, len(set(wanted))) if wanted else self.lexical.terms.select("term")
        return terms.where(F.col("term").rlike(f"^(?:{pattern})$"))

    def _sharing(self, pairs: Sequence[str], least: int) -> DataFrame:
        """Terms with ``least`` of the pairs."""
        chosen = self.pairs.where(F.col("pair").isin(list(dict.fromkeys(pairs))))
        return chosen.groupBy("term").count().where(F.col("count") >= least).select("term")

    # -- rows -----------------------------------------------------------------------------

    def of_terms(self, terms: DataFrame) -> DataFrame:
        """Ids of the rows that hold any of the terms."""
        return self.lexical.narrowed(terms)[0].select("id").distinct()

    def holding(self, words: Sequence[str], least: int) -> DataFrame:
        """Ids of the rows that hold ``least`` of the distinct words."""
        rows, _ = self.lexical.of_many(list(dict.fromkeys(words)))
        if least == 1:
            return rows.select("id").distinct()
        return rows.groupBy("id").count().where(F.col("count") >= least).select("id")

    def phrase(self, segments: Sequence[Sequence[str]], gaps, slop: int | None) -> DataFrame:
        """Ids of the rows in which the segments stand as asked.

        The places of the phrase's own words are laid out again, with nothing between them.
        """
        words = list(dict.fromkeys(w for s in segments for w in s))
        rows, _ = self.lexical.of_many(words)
        at = F.map_from_entries(F.flatten(F.collect_list(
            F.transform("positions", lambda p: F.struct(p.alias("at"), F.col("term").alias("term"))))))
        whole = rows.groupBy("id").agg(F.count("*").alias("n"), F.max(F.array_max("positions")).alias("last"), at.alias("at"))
        laid = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(F.col("at")[i], F.lit("")))
        return (whole.where(F.col("n") == len(words)).withColumn("laid", laid)
                .where(tx.phrase(F.col("laid"), segments, gaps, slop)).select("id"))

    def ids(self, operator: str, argument) -> DataFrame | None:
        """Ids (column ``id``) of the rows a term predicate holds for; None if it does not need a term.

        ``argument`` is that of ``filters.term_argument``.
        """
        if operator == "$startswith":
            return self.of_terms(self.starting(argument))
        if operator == "$regex":
            return self.of_terms(self.matching(argument))
        if operator == "$fuzzy":
            return self.of_terms(self.near(argument))
        if operator == "$match":
            words, least = argument
            return self.holding(words, least or 1)
        if operator == "$ngram":
            grams, threshold = argument
            distinct = list(dict.fromkeys(grams))
            if not distinct or threshold <= 0:
                return None
            # The least count that the share, computed as the row-wise form does, lets pass.
            least = next((n for n in range(1, len(distinct) + 1) if n / float(len(distinct)) >= threshold), None)
            return self.holding(distinct, len(distinct) + 1 if least is None else least)
        segments, gaps, slop = argument
        return None if any(not s for s in segments) else self.phrase(segments, gaps, slop)
