"""Full-text postings, term matching and ranking for whole tables of text queries.

The index is three tables: ``postings`` (one row per term and document), ``terms`` (document and
total frequency of each term) and ``totals`` (one row).  At rest the postings are partitioned by a
hash bucket of the term and sorted by term, so a search reads only the buckets of its terms.  A
fourth, ``bounds``, is kept on request: what a document of a range can score at most.

Query tables that pass a size check are evaluated range by range of documents (``ranges``); larger
ones by the joins below.

A frequent term owns a large share of the postings.  Postings are therefore never shuffled by term
alone: the build groups the tokens of a document where its row lies, and the search replicates the
small query side over salts instead of gathering a term in one task.  When all query terms must
match, only the rarest one generates candidates and the others are looked up for those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.text import SPLIT_LOWER, Analyzer, string_array
from trawl.operators import ranges
from trawl.session import cut_lineage

DEFAULT_BUCKETS = 256
#: Documents whose postings of all terms are as many as one file gets, about: a bucket has its share of them.
DOCS_PER_FILE = 2_048
SALTS = 16
MAX_BROADCAST_TERMS = 500_000
#: Terms that reach a scan as values.
MAX_PUSHED_TERMS = 2_000
# Scores are compared at this many decimals, so equal documents tie whatever the sum order.
SCORE_DECIMALS = 9


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_postings(
    docs: DataFrame,
    id: str,
    text: str,
    analyzer: Analyzer = SPLIT_LOWER,
    positions: bool = False,
) -> DataFrame:
    """``term, id, tf, dl[, positions]``: one row per distinct term of each document."""
    tokens = docs.select(F.col(id).alias("id"), analyzer.tokens(F.col(text)).alias("tokens"))
    fields = [
        T.StructField("term", T.StringType()), tokens.schema["id"],
        T.StructField("tf", T.IntegerType()), T.StructField("dl", T.IntegerType()),
    ]
    if positions:
        fields.append(T.StructField("positions", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield group_tokens(batch.column(0), batch.column(1), positions)

    return tokens.where(F.size("tokens") > 0).mapInArrow(run, T.StructType(fields))


def group_tokens(ids: pa.Array, tokens: pa.Array, positions: bool) -> pa.RecordBatch:
    """Group the tokens of each document of a batch: a document is one row, so no shuffle."""
    sizes = np.diff(tokens.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    coded = tokens.flatten().dictionary_encode()
    term = coded.indices.to_numpy()
    # Stable, so the places of a term stay in order.
    order = np.argsort(row * np.int64(len(coded.dictionary)) + term, kind="stable")
    row, term = row[order], term[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    starts = np.nonzero(fresh)[0]
    columns = [
        coded.dictionary.take(pa.array(term[starts])),
        ids.take(pa.array(row[starts])),
        pa.array(np.diff(np.append(starts, len(row))), pa.int32()),
        pa.array(sizes[row[starts]], pa.int32()),
    ]
    names = ["term", "id", "tf", "dl"]
    if positions:
        bounds = pa.array(np.append(starts, len(row)), pa.int32())
        columns.append(pa.ListArray.from_arrays(bounds, pa.array(place[order], pa.int32())))
        names.append("positions")
    return pa.RecordBatch.from_arrays(columns, names=names)


def term_stats(postings: DataFrame) -> DataFrame:
    """``term, df, ttf``: documents holding the term, and its total frequency."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("ttf")
    )


def corpus_totals(docs: DataFrame, text: str, analyzer: Analyzer = SPLIT_LOWER) -> DataFrame:
    """One row: number of documents with a text, and the number of their tokens."""
    return docs.where(F.col(text).isNotNull()).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.size(analyzer.tokens(F.col(text)))), F.lit(0)).cast("bigint").alias("n_tokens"),
    )


@dataclass
class LexicalIndex:
    """The three tables of a full-text index, lazy or read back from Parquet."""

    postings: DataFrame
    terms: DataFrame
    totals: DataFrame
    analyzer: Analyzer = SPLIT_LOWER
    buckets: int = DEFAULT_BUCKETS
    #: ``term, range, tf, dl``: greatest frequency and least length of a term in a range.
    bounds: DataFrame | None = None
    _sums: tuple[int, int] | None = field(default=None, repr=False)

    @classmethod
    def build(cls, docs: DataFrame, id: str, text: str, analyzer: Analyzer = SPLIT_LOWER,
              positions: bool = False, buckets: int = DEFAULT_BUCKETS) -> "LexicalIndex":
        postings = build_postings(docs, id, text, analyzer, positions)
        postings = postings.withColumn("bucket", _bucket(F.col("term"), buckets))
        totals = corpus_totals(docs, text, analyzer)
        return cls(postings, term_stats(postings), totals, analyzer, buckets)

    def with_bucket(self, postings: DataFrame) -> DataFrame:
        return postings.withColumn("bucket", _bucket(F.col("term"), self.buckets))

    def write(self, store, bounds: bool = False, filed: DataFrame | None = None) -> "LexicalIndex":
        """Save the index in a ``Folder`` or ``Tables`` store, with score ``bounds`` on request.

        ``filed`` are postings of further documents from files of another index with as many buckets; they
        are copied file by file, and not shuffled.

        A bucket is cut by document into as many sorted files as keep each at the postings of about
        ``DOCS_PER_FILE`` documents, however frequent a term is, and there are tasks for all of them.
        """
        n_docs = self.totals.select("n_docs").first()[0]
        cuts = max(1, math.ceil(n_docs / (DOCS_PER_FILE * self.buckets)))
        cut = F.pmod(F.xxhash64("id"), F.lit(cuts))
        rows, order = self.postings, ["bucket", "term", "id"]
        if bounds:
            rows = rows.withColumn("range", ranges.range_of(F.col("id"), F.col("dl"), n_docs))
            order = ["bucket", "term", "range", "id"]
        sorted_files = self._in_files(rows, cuts, F.col("bucket"), cut).sortWithinPartitions(*order)
        postings = store.save("postings", sorted_files, partition="bucket")
        if filed is not None:
            filed = filed.select(*postings.columns).sortWithinPartitions(*order)
            postings = store.add("postings", filed, partition="bucket")
        terms = store.save("terms", term_stats(postings).sortWithinPartitions("term"))
        # Only the document count is taken from the rows; tokens are summed from the terms.
        n_tokens = terms.agg(F.coalesce(F.sum("ttf"), F.lit(0))).first()[0]
        row = terms.sparkSession.createDataFrame(
            [(n_docs, n_tokens, self.buckets)], "n_docs bigint, n_tokens bigint, buckets int"
        )
        totals = store.save("totals", row.coalesce(1))
        kept = None
        if bounds:
            # Dealt by a part of what is grouped by: one shuffle, and files as large as those of the postings.
            cut = F.pmod("range", F.lit(cuts)).alias("cut")
            kept = self._in_files(postings.select("bucket", cut, "term", "range", "tf", "dl"), cuts, "bucket", "cut")
            kept = (kept.groupBy("bucket", "cut", "term", "range").agg(F.max("tf").alias("tf"), F.min("dl").alias("dl"))
                    .sortWithinPartitions("bucket", "term", "range").drop("cut"))
            kept = store.save("bounds", kept, partition="bucket")
        return LexicalIndex(postings, terms, totals, self.analyzer, self.buckets, kept)

    def _in_files(self, rows: DataFrame, cuts: int, *by) -> DataFrame:
        """Rows dealt by bucket and cut: to two tasks a file, so that few share one, where the session has fewer."""
        tasks = 2 * cuts * self.buckets
        if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            return rows.repartition(tasks, *by)
        return rows.repartition(*by)

    @classmethod
    def read(cls, store, analyzer: Analyzer = SPLIT_LOWER) -> "LexicalIndex":
        totals = store.load("totals")
        buckets = int(totals.first()["buckets"])
        kept = store.load("bounds") if store.has("bounds") else None
        return cls(store.load("postings"), store.load("terms"), totals, analyzer, buckets, kept)

    def sums(self) -> tuple[int, int]:
        """(documents, tokens), read once from the one-row table."""
        if self._sums is None:
            row = self.totals.first()
            self._sums = (int(row["n_docs"]), int(row["n_tokens"]))
        return self._sums

    def narrowed(self, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Postings and statistics of the given terms (column ``term``) alone.

        Up to ``MAX_PUSHED_TERMS`` of them reach both scans as values; the files are sorted by term,
        so other row groups are not read. More are joined, after the buckets that hold none.
        """
        wanted = terms.select("term").distinct()
        first = [r["term"] for r in wanted.limit(MAX_PUSHED_TERMS + 1).collect()]
        if len(first) <= MAX_PUSHED_TERMS:
            return self.of_terms(first)
        buckets = [r[0] for r in wanted.select(_bucket(F.col("term"), self.buckets)).distinct().collect()]
        wanted = F.broadcast(wanted) if _is_small(wanted) else wanted
        postings = self.postings.where(F.col("bucket").isin(buckets))
        return postings.join(wanted, "term", "left_semi"), self.terms.join(wanted, "term", "left_semi")

    def of_terms(self, terms: list[str]) -> tuple[DataFrame, DataFrame]:
        """As ``narrowed``, of a list of terms that is short by nature."""
        chosen = F.col("term").isin(terms)
        if len(terms) > 8 * self.buckets:  # hardly a bucket is without one
            return self.postings.where(chosen), self.terms.where(chosen)
        spark = self.postings.sparkSession
        rows = spark.createDataFrame([(t,) for t in terms], "term string")
        buckets = [r[0] for r in rows.select(_bucket(F.col("term"), self.buckets)).distinct().collect()]
        return self.postings.where(F.col("bucket").isin(buckets) & chosen), self.terms.where(chosen)


    def of_many(self, terms: list[str]) -> tuple[DataFrame, DataFrame]:
        """As ``narrowed``, of a list of any length that a check allowed on the driver."""
        if len(terms) <= MAX_PUSHED_TERMS:
            return self.of_terms(terms)
        spark = self.postings.sparkSession
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string"))
        return self.postings.join(wanted, "term", "left_semi"), self.terms.join(wanted, "term", "left_semi")


# -- scorers -----------------------------------------------------------------------------

# Published defaults of the ranking formulas.
BM25_K1, BM25_B = 1.2, 0.75
DIRICHLET_MU = 2000.0
JELINEK_MERCER_LAMBDA = 0.1


def score_term(scorer: str, n_docs: int, n_tokens: int) -> Column:
    """Contribution of one matched term, from its ``tf, dl, df, ttf``."""
    tf, dl = F.col("tf").cast("double"), F.col("dl").cast("double")
    df, ttf = F.col("df").cast("double"), F.col("ttf").cast("double")
    name = scorer.lower()
    if name == "bm25":
        average = n_tokens / n_docs if n_docs else 1.0
        idf = F.log(F.lit(1.0) + (F.lit(float(n_docs)) - df + 0.5) / (df + 0.5))
        length = 1.0 - BM25_B + BM25_B * dl / F.lit(average)
        return idf * tf * (BM25_K1 + 1.0) / (tf + BM25_K1 * length)
    if name == "tfidf":
        return F.sqrt(tf) * (1.0 + F.log(F.lit(n_docs + 1.0) / (df + 1.0)))
    if name == "dfi":
        expected = ttf * dl / F.lit(float(n_tokens))
        gain = F.log2(1.0 + (tf - expected) / F.sqrt(expected))
        return F.when(tf <= expected, F.lit(0.0)).otherwise(gain)
    share = ttf / F.lit(float(n_tokens))
    if name == "lm_dirichlet":
        raw = F.log(1.0 + tf / (DIRICHLET_MU * share)) + F.log(DIRICHLET_MU / (dl + DIRICHLET_MU))
        return F.greatest(F.lit(0.0), raw)
    if name == "lm_jm":
        lam = JELINEK_MERCER_LAMBDA
        return F.log(1.0 + ((1.0 - lam) * tf / dl) / (lam * share))
    raise ValueError(f"unknown scorer: {scorer}")


# -- matching ----------------------------------------------------------------------------


def query_tokens(queries: DataFrame, qid: str, text: str, analyzer: Analyzer) -> DataFrame:
    """``qid, tokens``: the analyzed text of each query, in order."""
    return queries.select(F.col(qid).alias("qid"), analyzer.tokens(F.col(text)).alias("tokens"))


def _distinct_terms(tokens: DataFrame) -> DataFrame:
    terms = tokens.withColumn("terms", F.array_distinct("tokens"))
    return terms.select("qid", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))


def _is_small(rows: DataFrame) -> bool:
    """Whether a query-side table may be broadcast."""
    return rows.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS


def join_postings(postings: DataFrame, wanted: DataFrame, small: bool) -> DataFrame:
    """Postings of the wanted terms.

    A small query side is broadcast and the postings stay in place.  Otherwise it is repeated
    over salts, so that a frequent term is met in ``SALTS`` places at once.
    """
    if small:
        return postings.join(F.broadcast(wanted), "term")
    salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    return postings.withColumn("salt", salt).join(salted, ["term", "salt"]).drop("salt")


def _allowed(rows: DataFrame, keep: DataFrame | None) -> DataFrame:
    return rows if keep is None else rows.join(keep, "id", "left_semi")


def tokens_shape(tokens: DataFrame, mode: str) -> DataFrame:
    """``qid, tokens`` as required and optional terms and phrases."""
    if mode not in ("all", "any", "phrase"):
        raise ValueError(f"unknown match mode: {mode}")
    none, words = string_array([]), F.coalesce(F.array_distinct("tokens"), string_array([]))
    phrase = F.array(F.col("tokens")) if mode == "phrase" else F.array().cast("array<array<string>>")
    return tokens.where("tokens IS NOT NULL").select(
        "qid", (none if mode == "any" else words).alias("required"),
        (words if mode == "any" else none).alias("should"), none.alias("must_not"), phrase.alias("phrases"))


def small_search(index: LexicalIndex, tokens: DataFrame, mode: str, keep: DataFrame | None) -> ranges.Search | None:
    """The batch as a search by ranges, or ``None`` if it is too large to broadcast."""
    shape = tokens_shape(tokens, mode)
    if mode == "phrase" and "positions" not in index.postings.columns:
        raise ValueError("phrase queries need an index with positions")
    asked = ranges.Asked.of(shape, MAX_BROADCAST_TERMS)
    return None if asked is None else ranges.Search(index, asked, keep)


def match_terms(
    index: LexicalIndex,
    tokens: DataFrame,
    mode: str = "all",
    keep: DataFrame | None = None,
) -> DataFrame:
    """One row per query, document and matched term, with ``tf, dl, df, ttf`` to score it.

    ``all`` needs every term of the query, ``any`` at least one, ``phrase`` every term in
    order and adjacent.  ``keep`` (column ``id``) restricts the documents.
    """
    search = small_search(index, tokens, mode, keep)
    if search is not None:
        return search.hits(tokens.schema["qid"].dataType)
    asked = _distinct_terms(tokens)
    small = _is_small(asked)
    postings, stats = index.narrowed(asked)
    known = asked.join(stats, "term")
    if mode == "phrase" and "positions" not in postings.columns:
        raise ValueError("phrase queries need an index with positions")
    if mode == "any":
        return _allowed(join_postings(postings, known, small), keep)
    hits = _every_term(postings, known, keep, small)
    return hits if mode == "all" else _adjacent(hits, tokens)


def _every_term(postings: DataFrame, known: DataFrame, keep: DataFrame | None,
                small: bool) -> DataFrame:
    """Rows of the documents holding all ``n_terms`` terms of a query.

    The rarest term of each query proposes documents; the others are only looked up there.
    How many that can be is known from the document frequencies, before any posting is read.
    """
    rarest = (
        known.groupBy("qid")
        .agg(F.min(F.struct("df", "term")).alias("r"), F.count(F.lit(1)).alias("found"),
             F.first("n_terms").alias("n_terms"))
        .where(F.col("found") == F.col("n_terms"))
    )
    most = rarest.agg(F.sum(F.col("r.df") * F.col("n_terms"))).first()[0] or 0
    rarest = rarest.select("qid", F.col("r.term").alias("term"))
    candidates = _allowed(join_postings(postings.select("term", "id"), rarest, small), keep)
    hits = look_up(postings, candidates.select("qid", "id"), known, small,
                   few_pairs=most <= MAX_BROADCAST_TERMS)
    whole = Window.partitionBy("qid", "id")
    return (
        hits.withColumn("matched", F.count(F.lit(1)).over(whole))
        .where(F.col("matched") == F.col("n_terms")).drop("matched")
    )


def look_up(postings: DataFrame, pairs: DataFrame, wanted: DataFrame, small: bool,
            few_pairs: bool = False) -> DataFrame:
    """Postings of the wanted terms of each query in the given documents only."""
    asked = pairs.join(F.broadcast(wanted) if small else wanted, "qid")
    return postings.join(F.broadcast(asked) if few_pairs else asked, ["id", "term"])


def _adjacent(hits: DataFrame, tokens: DataFrame) -> DataFrame:
    """Keep the documents where the query's tokens stand next to each other, in order."""
    found = hits.groupBy("qid", "id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("at"),
        F.collect_list(F.struct("term", "tf", "dl", "df", "ttf")).alias("rows"),
        F.first("n_terms").alias("n_terms"),
    )
    kept = found.join(tokens, "qid").where(_run(F.col("at"), F.col("tokens")))
    return kept.select("qid", "id", "n_terms", F.inline("rows"))


def best_scores(scored: DataFrame, k: int | None) -> DataFrame:
    """``qid, id, rank, score`` by descending score; ties go to the smaller id."""
    window = Window.partitionBy("qid").orderBy(F.col("score").desc(), "id")
    ranked = scored.withColumn("rank", F.row_number().over(window))
    ranked = ranked if k is None else ranked.where(F.col("rank") <= k)
    return ranked.select("qid", "id", "rank", "score")


def score_hits(index: LexicalIndex, hits: DataFrame, scorer: str = "bm25") -> DataFrame:
    return (
        hits.groupBy("qid", "id")
        .agg(F.round(F.sum(score_term(scorer, *index.sums())), SCORE_DECIMALS).alias("score"))
    )


def lexical_topk(
    index: LexicalIndex,
    queries: DataFrame,
    k: int,
    scorer: str = "bm25",
    mode: str = "all",
    *,
    qid: str = "qid",
    text: str = "text",
    keep: DataFrame | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """Best ``k`` matching documents per text query: ``qid, id, rank, score``.

    ``prune`` forces, or forbids, that score bounds rule out ranges of documents first; they change
    no result.
    """
    tokens = query_tokens(queries, qid, text, index.analyzer)
    search = small_search(index, tokens, mode, keep)
    if search is not None:
        return best_scores(search.top(scorer, k, tokens.schema["qid"].dataType, SCORE_DECIMALS, prune), k)
    return best_scores(score_hits(index, match_terms(index, tokens, mode, keep), scorer), k)


# -- Boolean queries ---------------------------------------------------------------------


def web_shape(queries: DataFrame, qid: str) -> DataFrame:
    """``qid, must, should, must_not, phrases, required`` without nulls and repeats."""
    none = string_array([])
    shape = queries.select(
        F.col(qid).alias("qid"),
        F.array_distinct(F.coalesce("must", none)).alias("must"),
        F.array_distinct(F.coalesce("should", none)).alias("should"),
        F.array_distinct(F.coalesce("must_not", none)).alias("must_not"),
        F.coalesce("phrases", F.array().cast("array<array<string>>")).alias("phrases"),
    )
    required = F.array_union("must", F.flatten("phrases"))
    return shape.withColumn("required", required)


def web_match(index: LexicalIndex, queries: DataFrame, *, qid: str = "qid",
              keep: DataFrame | None = None) -> DataFrame:
    """Matched rows of queries given as columns ``must, should, must_not`` and ``phrases``.

    A document needs every ``must`` term and phrase, no ``must_not`` term, and one ``should``
    term when nothing else is required.  Terms are already analyzed; ``phrases`` holds
    token arrays.  A query without a positive part matches nothing.
    """
    shape = web_shape(queries, qid)
    search = small_web_search(index, shape, keep)
    if search is not None:
        return search.hits(shape.schema["qid"].dataType)
    every = F.array_distinct(F.concat("required", "should", "must_not"))
    postings, stats = index.narrowed(shape.select(F.explode(every).alias("term")))

    needed = shape.select("qid", F.size("required").alias("n_terms"), F.explode("required").alias("term"))
    small = _is_small(shape.select(F.explode(F.concat("required", "should", "must_not"))))
    full = _every_term(postings, needed.join(stats, "term"), keep, small)
    if "positions" in postings.columns:
        full = _with_phrases(full, shape)
    loose = shape.where(F.size("required") == 0).select("qid", F.explode("should").alias("term"))
    loose = _allowed(join_postings(postings.select("term", "id"), loose, small), keep)
    found = full.select("qid", "id").unionByName(loose.select("qid", "id")).distinct()
    # Read twice below, and the most work of the query.
    found = cut_lineage(found)
    few = found.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS

    banned = shape.select("qid", F.explode("must_not").alias("term"))
    excluded = look_up(postings.select("term", "id"), found, banned, small, few).select("qid", "id")
    found = found.join(excluded, ["qid", "id"], "left_anti")
    wanted = shape.select("qid", F.explode(F.array_union("required", "should")).alias("term"))
    return look_up(postings, found, wanted.join(stats, "term"), small, few)


def small_web_search(index: LexicalIndex, shape: DataFrame, keep: DataFrame | None) -> ranges.Search | None:
    # A term that is required as well as optional scores once.
    once = shape.withColumn("should", F.array_except("should", "required"))
    asked = ranges.Asked.of(once, MAX_BROADCAST_TERMS)
    return None if asked is None else ranges.Search(index, asked, keep)


def web_topk(index: LexicalIndex, queries: DataFrame, k: int, scorer: str = "bm25", *, qid: str = "qid",
             keep: DataFrame | None = None) -> DataFrame:
    """Best ``k`` matches of web queries (see ``web_match``): ``qid, id, rank, score``."""
    shape = web_shape(queries, qid)
    search = small_web_search(index, shape, keep)
    if search is not None:
        return best_scores(search.top(scorer, k, shape.schema["qid"].dataType, SCORE_DECIMALS), k)
    return best_scores(score_hits(index, web_match(index, queries, qid=qid, keep=keep), scorer), k)


def _with_phrases(hits: DataFrame, shape: DataFrame) -> DataFrame:
    """Keep documents in which every phrase of the query stands word by word."""
    at = F.map_from_entries(F.collect_list(F.struct("term", "positions")))
    found = hits.groupBy("qid", "id").agg(at.alias("at")).join(shape.select("qid", "phrases"), "qid")
    return found.where(F.forall("phrases", lambda words: _run(F.col("at"), words)))


def _run(at: Column, words: Column) -> Column:
    """Whether the words stand next to each other, given the positions of each term."""
    def follows(p: Column) -> Column:
        hits = F.transform(words, lambda t, i: F.array_contains(F.element_at(at, t), p + i))
        return F.forall(hits, lambda hit: hit)

    return F.exists(F.element_at(at, F.get(words, F.lit(0))), follows)


def expression_terms(expr) -> set[str]:
    """All terms of a Boolean expression tree."""
    if isinstance(expr, str):
        return {expr}
    (_, parts), = expr.items()
    parts = parts if isinstance(parts, (list, tuple)) else [parts]
    return set().union(*(expression_terms(p) for p in parts)) if parts else set()


def _holds(expr, at: Column) -> Column:
    """Truth of an expression given the map from matched term to its positions."""
    if isinstance(expr, str):
        return F.map_contains_key(at, expr)
    (kind, parts), = expr.items()
    if kind == "not":
        return ~_holds(parts, at)
    if kind == "phrase":
        first, rest = parts[0], list(enumerate(parts))[1:]
        def follows(p: Column) -> Column:
            tests = [F.array_contains(F.element_at(at, F.lit(t)), p + i) for i, t in rest]
            return F.forall(F.array(*tests), lambda ok: ok) if tests else F.lit(True)
        present = [F.map_contains_key(at, t) for t in parts]
        hit = F.exists(F.element_at(at, F.lit(first)), follows)
        for test in present:
            hit = F.when(test, hit).otherwise(F.lit(False))
        return hit
    if kind not in ("and", "or") or not parts:
        raise ValueError(f"expected and, or, not or phrase, got {kind!r}")
    tests = [_holds(p, at) for p in parts]
    out = tests[0]
    for test in tests[1:]:
        out = out & test if kind == "and" else out | test
    return out


def holds_on_nothing(expr) -> bool:
    """Whether a document with none of the terms satisfies the expression."""
    if isinstance(expr, str):
        return False
    (kind, parts), = expr.items()
    if kind == "phrase":
        return False
    if kind == "not":
        return not holds_on_nothing(parts)
    values = [holds_on_nothing(p) for p in parts]
    return all(values) if kind == "and" else any(values)


def boolean_match(index: LexicalIndex, expr, documents: DataFrame | None = None) -> DataFrame:
    """Ids (column ``id``) satisfying a tree of ``and, or, not, phrase`` over terms.

    ``documents`` (column ``id``) is needed when the expression can hold without any term.
    """
    words = sorted(expression_terms(expr))
    if not words:
        raise ValueError("the expression has no terms")
    rows, _ = index.of_terms(words)
    positions = (
        F.col("positions") if "positions" in rows.columns else F.array().cast("array<int>")
    )
    found = rows.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", positions))).alias("at")
    )
    if holds_on_nothing(expr):
        if documents is None:
            raise ValueError("this expression needs the table of all documents")
        empty = F.create_map().cast("map<string,array<int>>")
        found = documents.select("id").join(found, "id", "left")
        found = found.withColumn("at", F.coalesce("at", empty))
    return found.where(_holds(expr, F.col("at"))).select("id")


__all__ = [
    "LexicalIndex", "best_scores", "boolean_match", "build_postings", "corpus_totals",
    "lexical_topk", "match_terms", "query_tokens", "score_hits", "score_term", "term_stats",
    "web_match", "web_topk",
]
