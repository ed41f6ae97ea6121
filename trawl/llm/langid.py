"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of
from trawl.session import cut_lineage

BITS = 15
#: Languages that the driver or a worker holds at once, 2^15 doubles each: 64 MB. More are learned and
#: scored block by block, with the best so far and the sum so far carried along.
BLOCK_LANGUAGES = 256
#: Characters handled at once, which bounds a worker's memory whatever the rows hold.
CHUNK = 1 << 20
UNKNOWN = "und"


@functools.cache
def _folded() -> np.ndarray:
    """For every code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 2- and 3-grams centred on a letter, and the position of each."""
    mul = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
    padded = np.concatenate([np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)])
    at = np.flatnonzero(codes)
    left, mid, right = padded[at] * mul[0], codes[at] * mul[1], padded[at + 2] * mul[2]
    buckets = []
    for grams, seed in ((left + mid, 1), (left + mid + right, 2)):
        h = grams + np.uint32(seed * 0x9E3779B1 & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        buckets.append(h >> np.uint32(32 - BITS))
    return np.concatenate(buckets), np.concatenate([at, at])


def _chunks(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(folded characters, row of each) for runs of rows; a long text comes in several runs.

    Rows and runs are kept apart by a blank, so that no n-gram spans two of them.
    """
    parts, rows, held = [], [], 0

    def run():
        return (_folded()[np.concatenate(parts)], np.repeat([r for r, _ in rows], [n for _, n in rows]))

    for row, text in enumerate(texts):
        for start in range(0, len(text or ""), CHUNK):
            codes = np.frombuffer((text[start:start + CHUNK] + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
            parts.append(codes)
            rows.append((row, len(codes)))
            held += len(codes)
            if held >= CHUNK:
                yield run()
                parts, rows, held = [], [], 0
    if parts:
        yield run()


def count_ngrams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, bucket, n`` over all rows with a language; bucket -1 counts the documents."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        totals: dict[str, int] = {}

        def flushed():
            for v, total in totals.items():
                n = counts.get(v, np.zeros(1 << BITS, np.int64))
                there = np.flatnonzero(n)
                yield batch_of(schema, [v] * (len(there) + 1), np.append(there, -1).astype(np.int32),
                               np.append(n[there], total))
            counts.clear()
            totals.clear()

        for batch in batches:
            langs, texts = texts_of(batch, "lang"), texts_of(batch)
            names = list(dict.fromkeys(langs))
            for start in range(0, len(names), BLOCK_LANGUAGES):
                known = {v: i for i, v in enumerate(names[start:start + BLOCK_LANGUAGES])}
                if len(totals) + len(known) > 2 * BLOCK_LANGUAGES:
                    yield from flushed()
                mine = [i for i, v in enumerate(langs) if v in known]
                code = np.array([known[langs[i]] for i in mine], np.int64)
                for i in mine:
                    totals[langs[i]] = totals.get(langs[i], 0) + 1
                for codes, rows in _chunks([texts[i] for i in mine]):
                    buckets, at = _features(codes)
                    keys = (code[rows[at]] << BITS) | buckets
                    found = np.bincount(keys, minlength=len(known) << BITS).reshape(len(known), -1)
                    for v, i in known.items():
                        counts[v] = counts.get(v, 0) + found[i]
        yield from flushed()

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))
    return (rows.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class LanguageModel:
    """Log-probabilities of n-gram buckets by language; small, and sent to every worker."""

    def __init__(self, languages: list[str], log_prior: np.ndarray, log_prob: np.ndarray):
        self.languages, self.log_prior, self.log_prob = languages, log_prior, log_prob

    @staticmethod
    def fit(docs: DataFrame, text: str = "text", lang: str = "lang",
            smoothing: float = 0.5) -> LanguageModel | ManyLanguages:
        """Counts every row whose text and language are not null."""
        counts = cut_lineage(count_ngrams(docs, text, lang))
        prior = {r["lang"]: r["n"] for r in counts.where("bucket = -1").select("lang", "n").collect()}
        many = ManyLanguages(counts, sorted(prior), prior, smoothing)
        return next(many.blocks()) if len(prior) <= BLOCK_LANGUAGES else many

    def blocks(self) -> Iterator[LanguageModel]:
        yield self

    def totals(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods of every text by language, and which texts have a letter."""
        total = np.tile(self.log_prior, (len(texts), 1)) if self.languages else np.zeros((len(texts), 0))
        letters = np.zeros(len(texts), bool)
        for codes, rows in _chunks(texts):
            buckets, at = _features(codes)
            if not len(at):
                continue
            order = np.argsort(rows[at], kind="stable")
            owner, buckets = rows[at][order], buckets[order]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            letters[owner[starts]] = True
            for i in range(len(self.languages)):
                total[owner[starts], i] += np.add.reduceat(self.log_prob[i][buckets], starts)
        return total, letters

    def score(self, texts: list) -> tuple[list[str], list[float]]:
        """The likeliest language of every text, ties to the first by name, and its probability."""
        total, letters = self.totals(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)],
                np.where(letters, share, 0.0).tolist())


class ManyLanguages:
    """Counts of more languages than fit a worker; gives models of ``BLOCK_LANGUAGES`` at a time."""

    def __init__(self, counts: DataFrame, languages: list[str], prior: dict[str, int], smoothing: float):
        self.counts, self.languages, self.prior, self.smoothing = counts, languages, prior, smoothing

    def blocks(self) -> Iterator[LanguageModel]:
        """In order of name; the prior is that among all languages."""
        every = max(sum(self.prior.values()), 1)
        for start in range(0, max(1, len(self.languages)), BLOCK_LANGUAGES):
            names = self.languages[start:start + BLOCK_LANGUAGES]
            place = {v: i for i, v in enumerate(names)}
            found = self.counts.where((F.col("bucket") >= 0) & F.col("lang").isin(names)).toArrow()
            grid = np.full((len(names), 1 << BITS), self.smoothing)
            rows = np.array([place[v] for v in found["lang"].to_pylist()], np.int64)
            np.add.at(grid, (rows, found["bucket"].to_numpy()), found["n"].to_numpy())
            yield LanguageModel(names, np.log(np.array([self.prior[v] for v in names], float) / every),
                                np.log(grid / grid.sum(axis=1, keepdims=True)))


def identify(docs: DataFrame, model: LanguageModel | ManyLanguages, text: str = "text", lang_pred: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """Adds the predicted language and its probability to every row.

    A null text, and one without a letter, is ``und`` with score 0. A model that learned nothing
    calls everything ``und``. Whole texts are read, in runs of bounded size. Input columns of the
    added names are replaced.
    """
    docs = docs.drop(lang_pred, score)
    if isinstance(model, ManyLanguages):
        return _identify_by_blocks(docs, model, text, lang_pred, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit("").alias(lang_pred), F.lit(0.0).alias(score)).schema

    def run(batches):
        for batch in batches:
            names, scores = shared.value.score(texts_of(batch, text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, lang_pred, score])

    return docs.mapInArrow(run, schema)


def _identify_by_blocks(docs: DataFrame, model: ManyLanguages, text: str, lang_pred: str, score: str) -> DataFrame:
    """One pass for each block of languages; ``score`` holds the best logarithm until the last."""
    total = score + "_total"
    while total in docs.columns:
        total += "_"
    columns = docs.columns
    docs = docs.select("*", F.lit(UNKNOWN).alias(lang_pred), F.lit(float("-inf")).alias(score),
                       F.lit(float("-inf")).alias(total))

    def scorer(shared):
        def run(batches):
            for batch in batches:
                found, letters = shared.value.totals(texts_of(batch, text))
                names = np.array(texts_of(batch, lang_pred), object)
                best, every = (np.array(texts_of(batch, c), float) for c in (score, total))
                top = found.argmax(axis=1)
                here = found[np.arange(len(found)), top]
                every = np.where(letters, np.logaddexp(every, np.logaddexp.reduce(found, axis=1)), every)
                better = letters & (here > best)
                names[better] = np.array(shared.value.languages, object)[top[better]]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in columns), pa.array(names.tolist(), pa.string()),
                     pa.array(np.where(better, here, best)), pa.array(every)],
                    names=[*columns, lang_pred, score, total])

        return run

    for block in model.blocks():
        docs = docs.mapInArrow(scorer(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    known = F.col(lang_pred) != UNKNOWN
    return docs.withColumn(score, F.when(known, F.exp(F.col(score) - F.col(total))).otherwise(0.0)).drop(total)
