"""Spelling variants: words one edit apart, found over an index of variable-length grams.

A gram starts at every place of a word (with marks before and after it). It has the least length, and goes
on while it is in the dictionary of frequent grams: so common beginnings become longer, rarer grams and no
list of the index is long. An edit touches only the grams around its place. The largest number that one
edit can touch is the word's bound: two words that are one edit apart share all other grams, at places at
most one apart. Merging lists then needs only one more list than the bound, the rarest ones; what
meets there is verified.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of
from trawl.session import cut_lineage, scratch_path

#: Words of fewer code points, and words that occur less often, are no words.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form occurs at least this many times as often as its variant.
FORM_RATIO = 5
#: Lengths of grams. A word of ``LEAST_LENGTH`` has more grams than one edit can touch.
SHORTEST, LONGEST = 2, 6
#: A gram that occurs more often than this goes on. If the words would have more frequent grams than
#: ``MOST_GRAMS``, so that they might not fit a task, it is more: lists get longer, results stay the same.
FREQUENT, MOST_GRAMS = 64, 500_000
#: Distinct entries a task counts before it passes them on.
FLUSH = 200_000
#: Characters of a text that are split at once.
SLICE = 1 << 20

_RUN = re.compile("[a-zÀ-ÿ]+")
#: Marks before and after a word; no word holds them.
_BEGIN, _END = "\x02", "\x03"


def ascii_lowered(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def runs_of(text: str) -> Counter:
    """How often each run of letters occurs in a lower-cased text."""
    if len(text) <= SLICE:
        return Counter(_RUN.findall(text))
    found, place = Counter(), 0
    while place < len(text):
        stop = min(len(text), place + SLICE)
        while stop < len(text) and _RUN.match(text, stop - 1) and _RUN.match(text, stop):
            stop = _RUN.match(text, stop).end()
        found.update(_RUN.findall(text, place, stop))
        place = stop
    return found


def misspelt(run: str, prefix: int, modulus: int) -> str:
    """The run, one code point short if the checksum of ``<doc_id>:<run>`` is a multiple of ``modulus``.

    ``prefix`` is the checksum of ``<doc_id>:``.
    """
    h = zlib.crc32(run.encode("utf-8"), prefix)
    if h % modulus:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1:]


def _counted(rows: DataFrame, counts, name: str) -> DataFrame:
    """``name, n`` summed over what ``counts(batch)`` gives of every batch."""
    schema = pa.schema([(name, pa.string()), ("n", pa.int64())])

    def run(batches):
        total = Counter()
        for batch in batches:
            for part in counts(batch):
                total.update(part)
                if len(total) >= FLUSH:
                    yield batch_of(schema, list(total), list(total.values()))
                    total = Counter()
        yield batch_of(schema, list(total), list(total.values()))

    return rows.mapInArrow(run, f"{name} string, n long").groupBy(name).agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", modulus: int = 199) -> DataFrame:
    """``word, n``: runs of letters of the whole texts, A to Z lower-cased, some with a slip of the pen.

    A run of a document loses a code point where ``modulus`` divides its checksum (see ``misspelt``), so
    that there are variants to find; ``modulus`` 0 leaves all as they are. A null id counts as an empty
    one; null and empty texts have no words.
    """
    def counts(batch):
        for key, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text")):
            runs = runs_of(ascii_lowered(text))
            prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
            part = Counter()
            for run, n in runs.items():
                word = misspelt(run, prefix, modulus) if modulus else run
                if len(word) >= LEAST_LENGTH:
                    part[word] += n
            yield part

    rows = docs.where(F.col(text).isNotNull()).select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    return _counted(rows, counts, "word").where(F.col("n") >= LEAST_COUNT)


class GramDictionary:
    """Frequent grams and their counts; takes words to pieces."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts

    @staticmethod
    def fit(words: DataFrame, frequent: int = FREQUENT, most: int = MOST_GRAMS) -> GramDictionary:
        """From ``word``. A word's every stretch of ``SHORTEST`` to ``LONGEST`` marked characters counts."""
        lengths = range(SHORTEST, LONGEST + 1)

        def counts(batch):
            for word in texts_of(batch, "word"):
                marked = _BEGIN + word + _END
                yield [marked[p:p + q] for q in lengths for p in range(len(marked) - q + 1)]

        places = words.select(F.sum(F.length("word") + 1).alias("n")).collect()[0]["n"] or 0
        # Of the grams of one length no more than ``places / least`` can occur more often than ``least``.
        least = max(frequent, math.ceil(places * len(lengths) / most))
        rows = _counted(words.select("word"), counts, "gram").where(F.col("n") > least).collect()
        return GramDictionary({r["gram"]: r["n"] for r in rows})

    def grams(self, word: str) -> list[tuple[int, str]]:
        """``(place, gram)`` for every place but the last. What a gram is depends on nothing beyond it."""
        marked, out = _BEGIN + word + _END, []
        for p in range(len(marked) - SHORTEST + 1):
            end = p + SHORTEST
            while end < len(marked) and end - p < LONGEST and marked[p:end] in self.counts:
                end += 1
            out.append((p, marked[p:end]))
        return out

    @staticmethod
    def affected(word: str, grams: list[tuple[int, str]]) -> int:
        """How many grams a single edit can touch, at most.

        A code point that is deleted or replaced touches the grams that hold it; one that is inserted,
        those that hold both its neighbours, which are no more.
        """
        change = [0] * (len(word) + 3)
        for p, gram in grams:
            change[p] += 1
            change[p + len(gram)] -= 1
        held, most = change[0], 0
        for place in range(1, len(word) + 1):
            held += change[place]
            most = max(most, held)
        return most

    def signature(self, word: str) -> list[tuple[int, str]]:
        """The rarest grams, one more than an edit can touch, in an order that is the same for all words."""
        grams = self.grams(word)
        counts = self.counts
        grams.sort(key=lambda g: (counts.get(g[1], 0), zlib.crc32(g[1].encode("utf-8")), g[1], g[0]))
        return grams[:self.affected(word, grams) + 1]


def near_pairs(words: DataFrame, dictionary: GramDictionary) -> DataFrame:
    """``a, a_n, b, b_n``: every two words (``word, n``, without repeats) one edit apart, once; ``a`` is
    the longer, or of equally long ones the later."""
    shared = words.sparkSession.sparkContext.broadcast(dictionary)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("gram", pa.string()), ("place", pa.int32())])

    def run(batches):
        for batch in batches:
            at, grams, places = [], [], []
            for number, word in enumerate(texts_of(batch, "word")):
                for place, gram in shared.value.signature(word):
                    at.append(number)
                    grams.append(gram)
                    places.append(place)
            at = pa.array(at, pa.int64())
            yield batch_of(schema, batch.column(0).take(at), batch.column(1).take(at), grams, places)

    lists = words.select("word", "n").mapInArrow(run, "word string, n long, gram string, place int")
    length = F.length("word")
    index = lists.select(F.xxhash64("gram", "place", length).alias("list"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    # A gram before the inserted code point keeps its place in the longer word, one behind it is one further.
    looked_up = F.array(F.xxhash64("gram", "place", length), F.xxhash64("gram", "place", length + 1),
                        F.xxhash64("gram", F.col("place") + 1, length + 1))
    probes = lists.select(F.explode(looked_up).alias("list"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    longer, alike = F.length("a") > F.length("b"), F.col("a") > F.col("b")
    near = (longer | alike) & (F.levenshtein("a", "b", 1) == 1)
    return index.join(probes, (index["list"] == probes["list"]) & near).select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``word, n`` (no word repeated, ``LEAST_LENGTH`` or longer).

    ``n_near`` counts the words one edit apart. The most frequent of them, of several the first, is the
    ``form`` if it occurs ``FORM_RATIO`` times as often; ``root`` is the end of the chain of forms, the
    word itself if it has none. An empty table gives no rows.
    """
    spark = words.sparkSession
    folder = scratch_path(spark, f"spelling-{uuid.uuid4().hex}")
    words.select("word", F.col("n").cast("long").alias("n")).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    pairs = near_pairs(words, GramDictionary.fit(words))
    both = F.inline(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                            F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))))
    best = (pairs.select(both).groupBy("word")
            .agg(F.count("*").alias("n_near"),
                 F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word"))).alias("best")))
    usual = F.coalesce(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.lit(False))
    words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(usual, F.col("best.word")).alias("form"), F.when(usual, -F.col("best.less")).alias("form_n"),
    ).write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    roots = _roots(forms)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form. Counts grow by ``FORM_RATIO`` along a chain, which bounds
    its length; each round doubles the steps taken."""
    roots = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = forms.agg(F.max("n")).collect()[0][0] or 0
    longest, reached = int(math.log(max(most, 1) / LEAST_COUNT, FORM_RATIO)) if most > LEAST_COUNT else 0, 1
    while reached < longest:
        roots = cut_lineage(roots)
        # Most roots go no further, a few words are the root of many: only what goes on is joined.
        inner = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(inner, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        reached *= 2
    return roots
