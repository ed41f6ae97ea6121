"""Walks of query tables too large to broadcast against the plain rounds of joins."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trawl import GraphIndex
from trawl.operators import dense, graph, walk
from trawl.session import cut_lineage

ROWS = "id long, embedding array<float>"
ASKED = "qid long, embedding array<float>"


def rows_of(rng, n, dim=6):
    centres = rng.normal(size=(9, dim)) * 3
    return (centres[rng.integers(0, 9, n)] + rng.normal(size=(n, dim))).astype(np.float32)


def listed(pairs):
    return [(key, None if v is None else [None if x is None else float(x) for x in v]) for key, v in pairs]


def found(df):
    def far(d):
        return "null" if d is None else "nan" if math.isnan(d) else round(d, 6)

    return sorted(((r["qid"], r["id"], far(r["distance"])) for r in df.collect()), key=repr)


def both(index, asked, ef, where=None):
    """The beams of the walk and of the rounds of joins."""
    asked = asked.select("qid", F.col("embedding").alias("qv"))
    vectors = index.cells.select("id", F.col("embedding").alias("v"))
    allowed = None if where is None else index.cells.where(where).select("id")
    new = walk.walk_beams(asked, vectors, index.ivf, index.edges, index.entries, ef, graph.ENTRY_CELLS, allowed)
    return found(new), found(index._walk(asked, vectors, ef, None, allowed))


def odd_queries(rng):
    plain = rows_of(rng, 30).tolist()
    odd = [[0.0] * 6, [math.nan] + [1.0] * 5, [None] + [1.0] * 5, [math.inf] + [1.0] * 5]
    pairs = [*enumerate(plain), *enumerate(odd, 100)]
    # The same key again, with its own vector and with another; and no key.
    return listed([*pairs, (0, plain[0]), (1, plain[2]), (1, plain[3]), (None, plain[4])])


@pytest.mark.parametrize("metric, ef, where", [("cosine", 5, None), ("l2", 12, 7)])
def test_same_beams(spark, metric, ef, where):
    """With repeated keys on both sides, odd vectors, and a beam narrower than what walks begin with."""
    rng = np.random.default_rng(5)
    x = rows_of(rng, 150)
    x[7:11], x[5] = x[3], 0
    more = [(i, x[i]) for i in (1, 2, 2, 2, 3)] + [(9, x[50]), (9, x[51])]
    corpus = spark.createDataFrame(listed([*enumerate(x), *more]), ROWS)
    index = GraphIndex.build(corpus, metric, m=6, ef_construction=20, cells=10)
    asked = spark.createDataFrame(odd_queries(rng), ASKED)
    new, plain = both(index, asked, ef, where if where is None else F.col("id") % where < 3)
    assert new == plain and len(new) > 100


def test_text_keys(spark):
    rng = np.random.default_rng(7)
    x = rows_of(rng, 60)
    names = [f"r{i}" for i in range(len(x))]
    index = GraphIndex.build(spark.createDataFrame(listed(zip(names, x)), "id string, embedding array<double>"),
                             "l2", m=6, ef_construction=20, cells=5)
    asked = spark.createDataFrame(listed(zip("abcdef", x)), "qid string, embedding array<float>")
    new, plain = both(index, asked, 10)
    assert new == plain and len(new) == 60


def test_search_ships_no_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    corpus = cut_lineage(spark.createDataFrame(listed(enumerate(rows_of(rng, 200))), ROWS))
    asked = corpus.withColumnRenamed("id", "qid")
    index = GraphIndex.build(corpus, "cosine", m=8, ef_construction=24, cells=10)
    wanted = found(index.search(asked, 5, ef_search=16))
    monkeypatch.setattr(dense, "MAX_BROADCAST_QUERIES", 0)
    monkeypatch.setattr(walk, "_PARTS", 2)
    hops, plain = [], walk._merge

    def merge(walks, reached, *rest, **more):
        hops.append(cut_lineage(reached))
        return plain(walks, hops[-1], *rest, **more)

    monkeypatch.setattr(walk, "_merge", merge)
    assert found(index.search(asked, 5, ef_search=16)) == wanted
    # Distances come back, no vectors; and to a full beam fewer than were scored for it.
    assert len(hops) > 2 and {name for hop in hops for name in hop.columns} == {"qid", "src", "id", "distance", "ok"}
    back = [hop.groupBy("qid", "src").count() for hop in hops[1:]]
    scored = index.edges.select(F.col("id").alias("src"), F.size("neighbours").alias("n"))
    sums = [hop.join(scored, "src").agg(F.sum("count"), F.sum("n")).first() for hop in back]
    assert sum(r[0] for r in sums) < sum(r[1] for r in sums)


def test_graph_stays_where_it_was_dealt(spark):
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    rows = spark.range(1000).repartition(5, "id").sortWithinPartitions("id")
    dealt = cut_lineage(rows, dealt=True)
    assert spark.conf.get("spark.sql.adaptive.enabled") == conf
    plan = spark.range(3000).join(dealt.hint("merge"), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and sorted(dealt.collect()) == sorted(rows.collect())
