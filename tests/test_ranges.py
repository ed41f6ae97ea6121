"""Text queries evaluated range by range against plain Python, and what bounds leave out."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trawl import LexicalIndex, lexical_topk, web_match
from trawl.operators import lexical, ranges
from trawl.operators.lexical import web_topk
from trawl.sources.storage import Folder

WORDS = [f"w{i}" for i in range(30)]


def texts(seed, n, rare=0):
    """Random texts of different lengths; the last ``rare`` hold an uncommon word many times."""
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choices(WORDS, [1 / (j + 1) for j in range(30)], k=rnd.randint(1, 60)))) for i in range(n)]
    return rows + [(n + i, "zebra " * (20 + i) + "w0") for i in range(rare)]


@pytest.fixture(scope="module")
def rows():
    return texts(1, 400, 12) + [(900, None), (901, ""), (902, "w1 w2 w3"), (903, "w1 w2 w3")]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    docs = spark.createDataFrame(rows, "id long, text string")
    patch = pytest.MonkeyPatch()
    patch.setattr(ranges, "RANGE_DOCS", 40)
    built = LexicalIndex.build(docs, "id", "text", positions=True, buckets=3)
    yield built.write(Folder(spark, str(tmp_path_factory.mktemp("index"))), bounds=True)
    patch.undo()


def bm25(rows, words, good):
    """id -> score over the distinct words of a query, of the documents that ``good`` admits."""
    docs = {i: t.split() for i, t in rows if t is not None}
    n, average = len(docs), sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, tokens in docs.items():
        if good(tokens):
            score = 0.0
            for w in set(words):
                tf, df = tokens.count(w), sum(w in d for d in docs.values())
                if tf:
                    score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (
                        tf + 1.2 * (0.25 + 0.75 * len(tokens) / average))
            out[i] = round(score, 9)
    return out


def best(scores, k):
    return [(i, n + 1) for n, (i, _) in enumerate(sorted(scores.items(), key=lambda e: (-e[1], e[0]))[:k])]


def stands(tokens, phrase):
    return any(tokens[i:i + len(phrase)] == phrase for i in range(len(tokens)))


@pytest.mark.parametrize("mode", ["any", "all", "phrase"])
@pytest.mark.parametrize("prune", [True, False])
def test_every_mode(spark, rows, index, mode, prune, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_DOCS", 40)
    monkeypatch.setattr(ranges, "CELLS", 64)
    monkeypatch.setattr(ranges, "FIRST_RANGES", 2)
    asked = ["w0 w1", "w2 w3 w2", "w1 w2 w3", "w29", "nowhere", "w0 nowhere", "", "zebra w0", "w0 w0"]
    queries = spark.createDataFrame([*enumerate(asked), (99, None)], "qid long, text string")
    found = {}
    for r in lexical_topk(index, queries, 7, mode=mode, prune=prune).collect():
        found.setdefault(r["qid"], []).append((r["id"], r["rank"]))
    for q, text in enumerate(asked):
        words = text.split()
        good = {"any": lambda t, w=words: any(x in t for x in w), "all": lambda t, w=words: bool(w) and all(x in t for x in w),
                "phrase": lambda t, w=words: bool(w) and stands(t, w)}[mode]
        assert sorted(found.get(q, []), key=lambda e: e[1]) == best(bm25(rows, words, good), 7), text
    assert 99 not in found


def test_bounds_leave_ranges_out(spark, rows, index, monkeypatch):
    """The zebra texts are in few ranges; what is scored first rules the others out, unread."""
    monkeypatch.setattr(ranges, "RANGE_DOCS", 40)
    monkeypatch.setattr(ranges, "FIRST_RANGES", 2)
    queries = spark.createDataFrame([(1, "zebra w0"), (2, "zebra w0 w1 w2")], "qid long, text string")
    tokens = lexical.query_tokens(queries, "qid", "text", index.analyzer)
    search = lexical.small_search(index, tokens, "any", None)
    top = lexical.best_scores(search.top("bm25", 5, tokens.schema["qid"].dataType, 9, True), 5).collect()
    placed, later = search.left_out
    assert placed.count() - 2 * 2 > 10 and later.count() < (placed.count() - 4) / 2
    words = {1: "zebra w0".split(), 2: "zebra w0 w1 w2".split()}
    for q, asked in words.items():
        got = sorted(((r["id"], r["rank"]) for r in top if r["qid"] == q), key=lambda e: e[1])
        assert got == best(bm25(rows, asked, lambda t: any(x in t for x in asked)), 5)
    plan = lexical.lexical_topk(index, queries, 5, mode="any", prune=True)._jdf.queryExecution().toString()
    assert "range" in plan and "In(range" in plan.replace("IN (", "In(").replace("range#", "range")


def test_bounds_bound(spark, index, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_DOCS", 40)
    queries = spark.createDataFrame([(1, "w0 w3 w7 zebra")], "qid long, text string")
    tokens = lexical.query_tokens(queries, "qid", "text", index.analyzer)
    for scorer in ("bm25", "tfidf", "dfi", "lm_dirichlet", "lm_jm"):
        search = lexical.small_search(index, tokens, "any", None)
        weight = lexical.score_term(scorer, *index.sums())
        bounds = {r["range"]: r["bound"] for r in search.bounds(weight).collect()}
        scored = index.postings.join(index.terms, "term").where(F.col("term").isin("w0", "w3", "w7", "zebra"))
        for r in scored.groupBy("range", "id").agg(F.sum(weight).alias("s")).collect():
            assert r["s"] <= bounds[r["range"]] + 1e-9


@pytest.mark.parametrize("limit", [500_000, 0])
def test_web_queries(spark, rows, index, limit, monkeypatch):
    """Required, optional and banned terms and phrases, by ranges and by joins."""
    monkeypatch.setattr(ranges, "RANGE_DOCS", 40)
    monkeypatch.setattr(lexical, "MAX_BROADCAST_TERMS", limit)
    shape = "qid string, must array<string>, should array<string>, must_not array<string>, phrases array<array<string>>"
    asked = [
        ("a", ["w0"], ["w1", "w0"], ["w2"], []), ("b", [], ["w5", "w6"], ["w0"], []), ("c", None, None, ["w1"], None),
        ("d", [], [], [], [["w1", "w2"]]), ("e", ["w3"], ["w4"], [], [["w0", "w0"], ["w1", "w0"]]),
        ("f", ["nowhere"], ["w0"], [], []), ("g", [], ["w0"], ["w0"], []), ("h", ["w1", "w1"], [], ["nowhere"], []),
    ]
    queries = spark.createDataFrame(asked, shape)
    found = {}
    for r in web_match(index, queries).collect():
        found.setdefault(r["qid"], set()).add((r["id"], r["term"]))
    ranked = {}
    for r in web_topk(index, queries, 6).collect():
        ranked.setdefault(r["qid"], []).append((r["id"], r["rank"]))
    for q, must, should, banned, phrases in asked:
        must, should, phrases = must or [], should or [], phrases or []
        words = [*must, *should, *(w for p in phrases for w in p)]

        def good(t):
            required = [*must, *(w for p in phrases for w in p)]
            return (all(w in t for w in required) and not any(w in t for w in banned)
                    and all(stands(t, p) for p in phrases) and bool(required or any(w in t for w in should)))

        wanted = {(i, w) for i, t in rows if t and good(t.split()) for w in set(words) if w in t.split()}
        assert found.get(q, set()) == wanted, q
        assert sorted(ranked.get(q, []), key=lambda e: e[1]) == best(bm25(rows, words, good), 6), q


def test_text_ids_filter_and_one_reading(spark, rows):
    docs = spark.createDataFrame([(f"d{i:03}", t) for i, t in rows], "id string, text string")
    index = LexicalIndex.build(docs, "id", "text", buckets=2)
    keep = docs.where("id < 'd100'").select("id")
    queries = spark.createDataFrame([("q", "w0 w1")], "qid string, text string")
    got = lexical_topk(index, queries, 4, mode="any", keep=keep)
    few = [(i, t) for i, t in rows if f"d{i:03}" < "d100"]
    scores = bm25(rows, ["w0", "w1"], lambda t: "w0" in t or "w1" in t)
    wanted = best({i: s for i, s in scores.items() if i in dict(few)}, 4)
    assert [(r["id"], r["rank"]) for r in got.orderBy("rank").collect()] == [(f"d{i:03}", n) for i, n in wanted]
    plan = web_match(index, queries.select("qid", F.array(F.lit("w0")).alias("must"), F.array(F.lit("w1")).alias("should"),
                                           F.array(F.lit("w2")).alias("must_not"), F.lit(None).cast("array<array<string>>").alias("phrases")))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("MapInArrow") == 1  # the postings, lazily built here, are made once


def test_files_are_as_many_as_the_documents_need(spark, rows, tmp_path, monkeypatch):
    """More files than the session has tasks after a shuffle, each of bounded size."""
    monkeypatch.setattr(lexical, "DOCS_PER_FILE", 10)
    docs = spark.createDataFrame(rows, "id long, text string")
    built = LexicalIndex.build(docs, "id", "text", positions=True, buckets=2).write(Folder(spark, str(tmp_path)), bounds=True)
    sizes = [r["n"] for r in built.postings.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < sum(sizes) / 6
    assert built.bounds.agg(F.sum("tf")).first()[0] > 0
    assert built.terms.where("term = 'zebra'").first()["df"] == 12
