"""Evaluates a batch of text queries range by range of documents.

All postings of a document lie in one range, so a task that has the wanted postings of a range can decide
every kind of query on its documents: required, optional and banned terms are counted by role, phrases
by merging sorted positions, scores summed.  Each wanted posting is read once and shuffled once, however many
queries ask for it, and ranges are even whatever a term's frequency.  The queries, few by a check of
their size, are broadcast.

If the index keeps bounds (greatest frequency and least length of each term in each range), a ranking
query first scores its most promising ranges; the ``k``-th score found there rules out every range
whose bound is below it, and their postings are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents of one length level that share a range, about.
RANGE_DOCS = 4096
#: Queries evaluated so, at most; others are joined.
MAX_QUERIES = 8192
#: Ranges that a query scores before the others are judged by their bounds.
FIRST_RANGES = 4
#: Cells of query by document held at once.
CELLS = 1 << 21
#: Wanted postings from which on bounds are worth the jobs that compare them; below, all are read.
MIN_PRUNED_POSTINGS = 20_000_000
#: Ranges that reach a scan as values, at most.
MAX_PUSHED_RANGES = 2_000
#: Scores of equal documents may differ by this much before they are rounded.
SLACK = 1e-8


def range_of(id: Column, length: Column, n_docs: int) -> Column:
    """Documents of about one length, dealt by a hash of the id; ``RANGE_DOCS`` of a level at most, about.

    Similar lengths make tight bounds.
    """
    splits = max(1, round(n_docs / RANGE_DOCS))
    level = F.floor(2 * F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int")
    return level * F.lit(splits) + F.pmod(F.xxhash64(id), F.lit(splits)).cast("int")


@dataclass
class Asked:
    """A query table that passed the size check. Terms are numbered; roles are lists of query numbers."""

    qids: list
    terms: list[str]
    need: np.ndarray
    required: dict[int, np.ndarray]
    optional: dict[int, np.ndarray]
    banned: dict[int, np.ndarray]
    #: Per query, arrays of term numbers that must stand next to each other.
    phrases: list[list[np.ndarray]]

    @staticmethod
    def of(shape: DataFrame, most: int) -> Asked | None:
        """From ``qid, required, should, must_not`` (distinct terms) and ``phrases``; None if there are
        too many queries, or more than ``most`` terms in all."""
        rows = shape.select("qid", "required", "should", "must_not", "phrases").limit(MAX_QUERIES + 1).collect()
        if len(rows) > MAX_QUERIES:
            return None
        number: dict[str, int] = {}
        roles: list[dict[int, list[int]]] = [{}, {}, {}]
        phrases, need = [], []
        for q, row in enumerate(rows):
            for role, terms in zip(roles, (row["required"], row["should"], row["must_not"])):
                for term in terms or ():
                    role.setdefault(number.setdefault(term, len(number)), []).append(q)
            phrases.append([np.array([number.setdefault(t, len(number)) for t in p]) for p in row["phrases"] or () if p])
            need.append(len(row["required"] or ()))
        if sum(len(q) for role in roles for q in role.values()) > most:
            return None
        arrays = [{c: np.array(q) for c, q in role.items()} for role in roles]
        return Asked([r["qid"] for r in rows], list(number), np.array(need, np.int32), *arrays, phrases)

    def queries_of(self, role: dict[int, np.ndarray], code: int, place: np.ndarray) -> np.ndarray:
        """Rows of the queries that give a term this role, among those with a place."""
        rows = place[role[code]] if code in role else np.empty(0, int)
        return rows[rows >= 0]


def _groups(codes: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(code, slice) of a sorted array of codes."""
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
    for a, b in zip(starts, [*starts[1:], len(codes)]):
        yield int(codes[a]), slice(a, b)


class Block:
    """The wanted postings of one range, sorted by term; documents are numbered in order of id."""

    def __init__(self, table: pa.Table):
        order = np.argsort(table["code"].to_numpy(), kind="stable")
        self.codes = table["code"].to_numpy()[order]
        ids = table["id"].combine_chunks() if isinstance(table["id"], pa.ChunkedArray) else table["id"]
        coded = ids.dictionary_encode()
        names = coded.dictionary
        rank = np.empty(len(names), np.int64)
        by_id = np.array(names.to_pylist(), dtype=object).argsort(kind="stable") if len(names) else np.empty(0, int)
        rank[by_id] = np.arange(len(names))
        self.ids = names.take(pa.array(by_id))
        self.docs = rank[coded.indices.to_numpy(zero_copy_only=False)[order]] if len(ids) else np.empty(0, np.int64)
        self.table, self.order = table, order
        self.weights = table["w"].to_numpy()[order] if "w" in table.column_names else None
        self._at = None

    def positions(self, code: int, doc: int) -> np.ndarray:
        if self._at is None:
            # (code, document) pairs are unique and sorted by code; documents are sorted within.
            self._keys = self.codes.astype(np.int64) * (len(self.ids) + 1) + self.docs
            self._sorted = np.argsort(self._keys, kind="stable")
            lists = self.table["positions"]
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            self._at = (lists.offsets.to_numpy(), lists.values.to_numpy(), self._keys[self._sorted])
        offsets, values, keys = self._at
        place = np.searchsorted(keys, code * (len(self.ids) + 1) + doc)
        row = self.order[self._sorted[place]]
        return values[offsets[row]:offsets[row + 1]]

    def holds_phrase(self, doc: int, phrase: np.ndarray) -> bool:
        """Whether the terms, all in the document, stand next to each other: rarest first, merged."""
        places = sorted(((self.positions(int(c), doc) - i) for i, c in enumerate(phrase)), key=len)
        left = places[0]
        for other in places[1:]:
            if not len(left):
                return False
            at = np.searchsorted(other, left)
            at[at == len(other)] = 0
            left = left[other[at] == left]
        return bool(len(left))

    def evaluate(self, asked: Asked, queries: np.ndarray, phrases: bool, scores: bool):
        """(queries, matches, scores) for pieces of ``queries``, matches by query and document."""
        step = max(1, CELLS // max(1, len(self.ids)))
        for start in range(0, len(queries), step):
            part = queries[start:start + step]
            place = np.full(len(asked.qids), -1)
            place[part] = np.arange(len(part))
            shape = (len(part), len(self.ids))
            met = np.zeros(shape, np.int32)
            loose, out = np.zeros(shape, bool), np.zeros(shape, bool)
            total = np.zeros(shape) if scores else None
            for code, here in _groups(self.codes):
                docs = self.docs[here]
                for role in (asked.required, asked.optional):
                    rows = asked.queries_of(role, code, place)
                    if len(rows):
                        cells = np.ix_(rows, docs)
                        if role is asked.required:
                            met[cells] += 1
                        else:
                            loose[cells] = True
                        if scores:
                            total[cells] += self.weights[here]
                rows = asked.queries_of(asked.banned, code, place)
                if len(rows):
                    out[np.ix_(rows, docs)] = True
            need = asked.need[part][:, None]
            good = (met == need) & ~out & ((need > 0) | loose)
            if phrases:
                for row, q in enumerate(part):
                    if asked.phrases[q]:
                        for doc in np.flatnonzero(good[row]):
                            good[row, doc] = all(self.holds_phrase(doc, p) for p in asked.phrases[q])
            yield part, good, total


def _best(scores: np.ndarray, good: np.ndarray, k: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, document) of the ``k`` best of each row; ties go to the earlier document."""
    if k is None or good.shape[1] <= k:
        return np.nonzero(good)
    keyed = np.where(good, scores, -np.inf)
    order = np.argsort(-keyed, axis=1, kind="stable")[:, :k]
    rows = np.repeat(np.arange(len(good)), k)
    docs = order.ravel()
    keep = good[rows, docs]
    return rows[keep], docs[keep]


class Search:
    """One batch of queries over one index."""

    def __init__(self, index, asked: Asked, keep: DataFrame | None = None):
        self.index, self.asked, self.keep = index, asked, keep
        self.spark = index.postings.sparkSession
        self.postings, stats = index.of_many(asked.terms)
        found = stats.select("term", "df", "ttf").toArrow()
        number = {t: i for i, t in enumerate(asked.terms)}
        codes = [number[t] for t in found["term"].to_pylist()]
        self.n_postings = sum(found["df"].to_pylist())
        # As many rows as the queries have terms, at most.
        self.codes = self.spark.createDataFrame(
            [(t, c, df, ttf) for t, c, df, ttf in zip(
                found["term"].to_pylist(), codes, found["df"].to_pylist(), found["ttf"].to_pylist())],
            "term string, code int, df bigint, ttf bigint")
        self.phrases = "positions" in self.postings.columns and any(asked.phrases)
        self.shared = self.spark.sparkContext.broadcast(asked)

    def _dealt(self) -> DataFrame:
        """Wanted postings with their term's number and statistics and their range."""
        rows = self.postings
        if "range" not in rows.columns:
            rows = rows.withColumn("range", range_of(F.col("id"), F.col("dl"), self.index.sums()[0]))
        if self.keep is not None:
            rows = rows.join(self.keep, "id", "left_semi")
        return rows.join(F.broadcast(self.codes), "term")

    def _with_qids(self, rows: DataFrame, like: T.DataType) -> DataFrame:
        names = self.spark.createDataFrame(
            list(enumerate(self.asked.qids)), T.StructType([T.StructField("q", T.IntegerType()), T.StructField("qid", like)]))
        return rows.join(F.broadcast(names), "q").drop("q")

    def hits(self, like: T.DataType) -> DataFrame:
        """``qid, id, term, tf, dl, df, ttf``: matched documents and each of their scoring terms."""
        columns = ["range", "code", "id", "tf", "dl", *(["positions"] if self.phrases else [])]
        rows = self._dealt().select(*columns)
        shared, phrases = self.shared, self.phrases
        out = T.StructType([T.StructField("q", T.IntegerType()), rows.schema["id"], T.StructField("code", T.IntegerType()),
                            T.StructField("tf", T.IntegerType()), T.StructField("dl", T.IntegerType())])

        def run(table: pa.Table) -> pa.Table:
            asked, block = shared.value, Block(table)
            tf, dl = (table[c].to_numpy()[block.order] for c in ("tf", "dl"))
            found = []
            for part, good, _ in block.evaluate(asked, np.arange(len(asked.qids)), phrases, False):
                place = np.full(len(asked.qids), -1)
                place[part] = np.arange(len(part))
                for code, here in _groups(block.codes):
                    rows = np.concatenate([asked.queries_of(r, code, place) for r in (asked.required, asked.optional)])
                    rows = np.unique(rows)
                    if len(rows):
                        r, d = np.nonzero(good[np.ix_(rows, block.docs[here])])
                        found.append((part[rows[r]], d + here.start, np.full(len(r), code)))
            q, at, code = (np.concatenate(c) if found else np.empty(0, int) for c in (zip(*found) if found else [()] * 3))
            return pa.table({"q": pa.array(q.astype(np.int32)), "id": block.ids.take(pa.array(block.docs[at])),
                             "code": pa.array(code.astype(np.int32)), "tf": pa.array(tf[at]), "dl": pa.array(dl[at])})

        found = rows.groupBy("range").applyInArrow(run, out)
        named = found.join(F.broadcast(self.codes), "code").drop("code")
        return self._with_qids(named, like).select("qid", "id", "term", "tf", "dl", "df", "ttf")

    def top(self, scorer: str, k: int | None, like: T.DataType, decimals: int, prune: bool | None = None) -> DataFrame:
        """``qid, id, score``: the ``k`` best matches of every query in each range that may hold one.

        ``prune`` says whether to compare bounds first; by default if there are many postings to read.
        """
        from trawl.operators.lexical import score_term

        weight = score_term(scorer, *self.index.sums())
        columns = ["range", "code", "id", weight.alias("w"), *(["positions"] if self.phrases else [])]
        prune = self.n_postings >= MIN_PRUNED_POSTINGS if prune is None else prune
        bounds = self.bounds(weight) if prune and k is not None else None
        if bounds is None:
            return self._with_qids(self._scored(self._dealt().select(*columns), None, k, decimals), like)
        first, later = self.waves(bounds, k, lambda ranges, alive: self._scored(
            self._in_ranges(ranges).select(*columns), alive, k, decimals))
        return self._with_qids(first.unionByName(later), like)

    def _in_ranges(self, ranges: list[int] | None) -> DataFrame:
        rows = self._dealt()
        return rows if ranges is None else rows.where(F.col("range").isin(ranges))

    def _scored(self, rows: DataFrame, alive: DataFrame | None, k: int | None, decimals: int) -> DataFrame:
        """``q, id, score``; ``alive`` (``range, q``) names the queries to evaluate in a range, else all."""
        shared, phrases = self.shared, self.phrases
        out = T.StructType([T.StructField("q", T.IntegerType()), rows.schema["id"], T.StructField("score", T.DoubleType())])

        def score(table: pa.Table, queries: np.ndarray) -> pa.Table:
            block, found = Block(table), []
            for part, good, total in block.evaluate(shared.value, queries, phrases, True):
                total = np.round(total, decimals)
                r, d = _best(total, good, k)
                found.append((part[r], d, total[r, d]))
            q, d, s = (np.concatenate(c) if found else np.empty(0) for c in (zip(*found) if found else [()] * 3))
            return pa.table({"q": pa.array(q.astype(np.int32)), "id": block.ids.take(pa.array(d.astype(np.int64))),
                             "score": pa.array(s.astype(float))})

        def whole(table: pa.Table) -> pa.Table:
            return score(table, np.arange(len(shared.value.qids)))

        def chosen(table: pa.Table, queries: pa.Table) -> pa.Table:
            return score(table, np.unique(queries["q"].to_numpy()))

        if alive is None:
            return rows.groupBy("range").applyInArrow(whole, out)
        return rows.groupBy("range").cogroup(alive.select("range", "q").groupBy("range")).applyInArrow(chosen, out)

    def bounds(self, weight: Column) -> DataFrame | None:
        """``range, q, bound``: how much a document of the range can score at most; ranges without a match
        of a query have no row. None if the index keeps no bounds."""
        if self.index.bounds is None:
            return None
        rows = (self.index.bounds.join(F.broadcast(self.codes), "term")
                .select("range", "code", weight.alias("w")))
        shared = self.shared

        def run(table: pa.Table) -> pa.Table:
            asked = shared.value
            order = np.argsort(table["code"].to_numpy(), kind="stable")
            codes, weights = table["code"].to_numpy()[order], table["w"].to_numpy()[order]
            total, met, loose = np.zeros(len(asked.qids)), np.zeros(len(asked.qids), int), np.zeros(len(asked.qids), bool)
            for code, w in zip(codes.tolist(), weights):
                for role in (asked.required, asked.optional):
                    if code in role:
                        total[role[code]] += max(w, 0.0)
                        if role is asked.required:
                            met[role[code]] += 1
                        else:
                            loose[role[code]] = True
            q = np.flatnonzero((met == asked.need) & ((asked.need > 0) | loose))
            return pa.table({"range": pa.array(np.full(len(q), table["range"][0].as_py(), np.int32)),
                             "q": pa.array(q.astype(np.int32)), "bound": pa.array(total[q])})

        return rows.groupBy("range").applyInArrow(run, "range int, q int, bound double")

    def waves(self, bounds: DataFrame, k: int, evaluate) -> tuple[DataFrame, DataFrame]:
        """What the most promising ranges of each query give, and what the others do that may still count."""
        from trawl.session import cut_lineage

        order = Window.partitionBy("q").orderBy(F.col("bound").desc(), "range")
        placed = cut_lineage(bounds.withColumn("place", F.row_number().over(order)))
        first = placed.where(F.col("place") <= FIRST_RANGES)
        found = cut_lineage(evaluate(self._few_ranges(first), first))
        kth = (found.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc())))
               .where(F.col("n") == k).select("q", F.col("score").alias("least")))
        # One row for each query.
        later = (placed.where(F.col("place") > FIRST_RANGES).join(F.broadcast(kth), "q", "left")
                 .where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)))
        self.left_out = (placed, later)
        return found, evaluate(self._few_ranges(later), later)

    def _few_ranges(self, alive: DataFrame) -> list[int] | None:
        """The ranges, if few enough to reach the scan of the postings as values."""
        ranges = [r["range"] for r in alive.select("range").distinct().limit(MAX_PUSHED_RANGES + 1).collect()]
        return ranges if len(ranges) <= MAX_PUSHED_RANGES else None
