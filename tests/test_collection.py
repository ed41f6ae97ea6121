"""A collection end to end, on the small literal corpora the semantics are pinned with."""

import json

import pytest
from pyspark.sql import functions as F

from trawl import (
    Analyzer, Collection, CollectionSchema, Column, Fusion, GraphOptions, GraphQuery, HashModel,
    HybridConfig, IndexedJsonField, IvfOptions, IvfQuery, MetadataIndex, Metric, TextIndexOptions,
    LexicalIndex, from_documents, from_texts, ingest,
)

TEXTS = ["low tide at dawn", "a grey heron", "granite cliffs"]
METAS = [{"kind": "wet", "n": 1}, {"kind": "wet", "n": 2},
         {"kind": "rock", "n": 3}]


def make(spark, name, columns=("kind",), **options):
    schema = CollectionSchema.declare(8, metadata_columns=[Column(c, "TEXT") for c in columns],
                                      **options.pop("schema", {}))
    return Collection.create(spark, name, schema, embedder=HashModel(8), **options)


def contents(df):
    return [r["content"] for r in df.orderBy("qid", "rank").collect()]


@pytest.fixture(scope="module")
def store(spark):
    c = make(spark, "store_main")
    c.add_texts(texts=TEXTS, metadatas=METAS)
    return c


def test_search_returns_content_and_metadata(store):
    row = store.search("low tide at dawn", k=2).orderBy("rank").first()
    assert row["content"] == "low tide at dawn"
    assert json.loads(row["metadata"]) == {"kind": "wet", "n": 1}


def test_score_of_exact_text(store):
    row = store.search_with_score("granite cliffs", k=1).first()
    assert row["content"] == "granite cliffs" and abs(row["distance"]) < 1e-6


@pytest.mark.parametrize("spec, expected", [
    ({"kind": {"$ne": "wet"}}, {"granite cliffs"}),
    ({"n": {"$lt": 3}}, {"low tide at dawn", "a grey heron"}),
    ({"$or": [{"n": 1}, {"kind": "rock"}]}, {"low tide at dawn", "granite cliffs"}),
    ({"kind": "wet", "n": {"$in": [2, 3]}}, {"a grey heron"}),
])
def test_filters(store, spec, expected):
    assert set(contents(store.search("anything", k=10, filter=spec))) == expected


def test_many_queries_equal_single_queries(store):
    batch = store.search(TEXTS, k=2).collect()
    for qid, text in enumerate(TEXTS):
        one = {(r["rank"], r["id"]) for r in store.search(text, k=2).collect()}
        assert one == {(r["rank"], r["id"]) for r in batch if r["qid"] == qid}


def test_relevance_and_threshold(store):
    row = store.search_with_relevance("low tide at dawn", k=1).first()
    assert row["relevance"] == pytest.approx(1.0, abs=1e-3)
    assert "low tide at dawn" in contents(
        store.search_with_relevance("low tide at dawn", k=3, threshold=0.9))


def test_mmr(store):
    found = contents(store.mmr("low tide at dawn", k=2, fetch_k=3))
    assert len(found) == 2 and "low tide at dawn" in found
    scored = store.mmr("low tide at dawn", k=2, fetch_k=3, scored=True)
    d = [r["distance"] for r in scored.orderBy("rank").collect()]
    assert d == sorted(d)


def test_scored_search_refuses_fusion(store):
    with pytest.raises(NotImplementedError):
        store.search_with_score("grey", k=2, fts_query="grey")
    with pytest.raises(NotImplementedError):
        store.search_with_score("grey", k=2, hybrid=HybridConfig())


def test_absent_typed_key_is_null(spark, name):
    c = make(spark, name)
    c.add_texts(texts=["no kind", "with"], metadatas=[{"n": 5}, {"kind": "x"}])
    assert contents(c.search("no kind", k=5, filter={"kind": "x"})) == ["with"]
    row = c.search("no kind", k=1).first()
    assert json.loads(row["metadata"]) == {"n": 5, "kind": None}


def test_upsert_and_last_write_wins(spark, name):
    c = make(spark, name, sync_load=False)
    c.add_texts(texts=["a1", "b1", "a2", "c1", "b2", "a3"], ids=["a", "b", "a", "c", "b", "a"],
                metadatas=[{"n": i} for i in (1, 1, 2, 1, 2, 3)])
    assert {(r["id"], r["content"]) for r in c.rows().collect()} == {
        ("a", "a3"), ("b", "b2"), ("c", "c1")}
    c.refresh()
    c.add_texts(texts=["a4", "d1"], ids=["a", "d"], metadatas=[{"kind": "k"}, {}])
    rows = {r["id"]: r for r in c.rows().collect()}
    assert {i: r["content"] for i, r in rows.items()} == {
        "a": "a4", "b": "b2", "c": "c1", "d": "d1"}
    assert rows["a"]["kind"] == "k" and rows["a"]["metadata"] == "{}"


def test_ids_lists_and_empty_batches(spark, name):
    c = make(spark, name, sync_load=False)
    got = [r["id"] for r in c.add_texts(texts=["x", "y", "z"], ids=["one", None, "three"]).collect()]
    assert got[0] == "one" and got[2] == "three" and len(got[1]) == 36
    assert c.add_texts(texts=[]).count() == 0
    assert c.add_embeddings(texts=["p", "q"], embeddings=[[0.5] * 8], ids=["p", "q"]).count() == 1
    c.refresh()
    found = [r["content"] for r in c.get_by_ids(["three", "nope", "one", "three"]).collect()]
    assert found == ["z", "x", "z"]


def test_wrong_dimension_is_refused(spark, name):
    c = make(spark, name, sync_load=False)
    with pytest.raises(Exception, match="dimensions"):
        c.add_embeddings(texts=["p"], embeddings=[[0.5] * 7], ids=["p"])


def test_delete(spark, name):
    c = make(spark, name, sync_load=False)
    c.add_texts(texts=TEXTS, metadatas=METAS, ids=["1", "2", "3"])
    assert c.delete() is False and c.rows().count() == 3
    assert c.delete(ids=["1", "3"], filter={"kind": "wet"}) is True
    assert {r["id"] for r in c.rows().collect()} == {"2", "3"}
    c.refresh()
    c.delete(filter={"n": {"$gt": 2}})
    assert {r["id"] for r in c.rows().collect()} == {"2"}
    c.delete(ids=["2"])
    c.refresh()
    assert c.rows().count() == 0


def test_lifecycle(spark, name):
    c = make(spark, name)
    c.add_texts(texts=["kept"])
    with pytest.raises(ValueError):
        make(spark, name)
    with pytest.raises(ValueError):
        make(spark, name, overwrite=True, if_not_exists=True)
    assert make(spark, name, if_not_exists=True).rows().count() == 1
    assert make(spark, name, overwrite=True).rows().count() == 0
    c.drop()
    assert not c.exists()
    with pytest.raises(ValueError):
        Collection.open(spark, name)


def test_other_database_and_open(spark, name):
    make(spark, name, database="other_db")
    c = from_texts(spark, name, ["alpha", "beta"], HashModel(8), database="other_db",
                   metadata_columns=["kind"], metadatas=[{"kind": "x"}, {}])
    assert contents(c.search("beta", k=1)) == ["beta"]
    docs = spark.createDataFrame([("ignored", "gamma", '{"kind":"y"}')],
                                 "id string, content string, metadata string")
    c = from_documents(spark, name, docs, HashModel(8), database="other_db",
                       metadata_columns=["kind"])
    assert contents(c.search("gamma", k=1)) == ["gamma"]
    assert "ignored" not in {r["id"] for r in c.rows().collect()}
    ignoring = Collection.open(spark, name, database="other_db", ignore_metadata_columns=["kind"])
    assert "kind" not in ignoring.schema.columns() and "metadata" in ignoring.schema.columns()
    for bad in (dict(metadata_columns=["nope"]), dict(id_column="nope"), dict(content_column="nope"),
                dict(embedding_column="content"), dict(content_column="embedding"),
                dict(metadata_columns=["kind"], ignore_metadata_columns=["kind"])):
        with pytest.raises(ValueError):
            Collection.open(spark, name, database="other_db", **bad)


def test_column_named_distance(spark, name):
    c = make(spark, name, columns=("distance",))
    c.add_texts(texts=["alpha", "beta"], metadatas=[{"distance": "far"}, {"distance": "near"}])
    row = c.search_with_score("beta", k=1).first()
    assert json.loads(row["metadata"])["distance"] == "near"
    assert abs(row["distance_1"]) < 1e-6


# -- hybrid ------------------------------------------------------------------------------

HYBRID_TEXTS = ["the grey tide at dawn", "a patient grey heron", "granite cliffs"]
WIDE = HybridConfig(primary_top_k=10, secondary_top_k=10)


@pytest.fixture(scope="module")
def hybrid_store(spark):
    c = make(spark, "store_hybrid", hybrid=WIDE)
    c.add_texts(texts=HYBRID_TEXTS, ids=["f", "d", "q"],
                metadatas=[{"kind": x} for x in ("wet", "wet", "dry")])
    c.apply_hybrid_index()
    return c


def test_hybrid(hybrid_store):
    found = contents(hybrid_store.search("grey", k=3))
    assert len(found) == 3 and sum("grey" in t for t in found) >= 2
    found = contents(hybrid_store.search("grey", k=5, filter={"kind": "wet"}))
    assert sorted(found) == sorted(HYBRID_TEXTS[:2])
    assert hybrid_store.search_with_score("grey", k=2).count() == 2


@pytest.mark.parametrize("fusion", list(Fusion))
def test_fusions(hybrid_store, fusion):
    config = HybridConfig(fusion=fusion, primary_top_k=10, secondary_top_k=10)
    found = contents(hybrid_store.search("grey heron", k=3, hybrid=config))
    assert "a patient grey heron" in found


def test_dispatch_by_fts_query(hybrid_store):
    dense = contents(hybrid_store.search("granite cliffs", k=1, fts_query=""))
    assert dense == ["granite cliffs"]
    by_vector = hybrid_store._queries("granite cliffs").drop("text")
    assert contents(hybrid_store.search_by_vector(by_vector, k=1)) == ["granite cliffs"]
    fused = contents(hybrid_store.search_by_vector(by_vector, k=3, fts_query="grey"))
    assert len(fused) == 3


def test_windows_bound_the_result(hybrid_store):
    config = HybridConfig(primary_top_k=1, secondary_top_k=1)
    assert len(contents(hybrid_store.search("grey", k=10, hybrid=config))) <= 2


def test_no_text_index(store):
    with pytest.raises(ValueError, match="text index"):
        store.search("grey", hybrid=WIDE)


def test_refresh_publishes_to_the_index(spark, name):
    c = make(spark, name, hybrid=WIDE, sync_load=False, text_index=TextIndexOptions())
    c.add_texts(texts=HYBRID_TEXTS, ids=["f", "d", "q"])
    c.refresh()
    c.add_texts(texts=["grey gull", "new granite"], ids=["b", "q"])
    assert "grey gull" not in contents(c.search("grey", k=10))
    c.refresh()
    found = contents(c.search("grey", k=10))
    assert "grey gull" in found and "new granite" in found and "granite cliffs" not in found
    assert c.text_index().sums() == (4, 5 + 4 + 2 + 2)
    c.delete(ids=["f"])
    c.refresh()
    assert "the grey tide at dawn" not in contents(c.search("grey", k=10))


# -- approximate indexes -----------------------------------------------------------------

STONES = ["slate", "chalk", "flint", "basalt", "gneiss", "marl"]


def stones(spark, name, **options):
    c = make(spark, name, columns=("tag",), schema={"metric": Metric.L2}, **options)
    c.add_texts(texts=STONES, metadatas=[{"tag": ("soft", "hard")[i % 2]} for i in range(6)])
    return c


def test_index_types_and_knobs(spark, name):
    c = stones(spark, name, query_options=IvfQuery(nprobe=4))
    assert contents(c.search("chalk", k=1)) == ["chalk"]
    c.query_options = GraphQuery(ef_search=32)
    c.apply_vector_index(IvfOptions(quant="sq8"))
    assert c.is_valid_index() and c.index_type() == "ivf"
    with pytest.raises(ValueError, match="is IVF"):
        c.search("chalk", k=1)
    c.apply_hybrid_index(GraphOptions())
    assert c.index_type() == "ivf"
    c.query_options = IvfQuery(nprobe=100, rescore_width=1)
    assert contents(c.search("chalk", k=1)) == ["chalk"]
    c.drop_index()
    assert not c.is_valid_index()
    c.apply_vector_index(GraphOptions(m=2, ef_construction=3))
    with pytest.raises(ValueError, match="is HNSW"):
        c.search("chalk", k=1)
    for mode in ("auto", "scan", "walk", "prune", "twohop", "bridge"):
        c.query_options = GraphQuery(ef_search=4, filter_mode=mode)
        assert len(contents(c.search("chalk", k=3, filter={"tag": "soft"}))) == 3
    assert contents(c.search("chalk", k=1)) == ["chalk"]
    with pytest.raises(ValueError):
        c.apply_vector_index(IvfOptions())
    for bad in (GraphQuery(ef_search=0), GraphQuery(rescore_width=-2),
                GraphQuery(filter_mode="bogus"), GraphQuery(column_filter="bogus")):
        c.query_options = bad
        with pytest.raises(ValueError):
            c.search("chalk", k=1)


def test_index_declared_before_rows(spark, name):
    c = make(spark, name, vector_index=IvfOptions())
    assert c.is_valid_index()
    c.add_texts(texts=["alpha", "beta", "gamma"])
    assert contents(c.search("alpha", k=1)) == ["alpha"]
    c.add_texts(texts=["delta"])
    c.query_options = IvfQuery(nprobe=100)
    assert contents(c.search("delta", k=1)) == ["delta"]


def test_option_checks():
    with pytest.warns(DeprecationWarning, match="nb_bits"):
        assert IvfOptions(quant="rabitq", rabitq_bits=4).nb_bits == 4
    with pytest.warns(DeprecationWarning), pytest.raises(ValueError, match="nb_bits"):
        IvfOptions(quant="rabitq", rabitq_bits=4, nb_bits=2)
    for bad in (dict(quant="zip"), dict(quant="sq8", pq_m=2), dict(quant="pq", pq_m=3),
                dict(quant="osq", nb_bits=1.5), dict(quant="tq", query_bits=4)):
        with pytest.raises(ValueError):
            IvfOptions(**bad).check(Metric.L2, 8)
    IvfOptions(quant="tq", nb_bits=1.5).check(Metric.L2, 8)
    with pytest.raises(ValueError):
        GraphOptions(quant="sq8").check(Metric.L1, 8)
    with pytest.raises(ValueError):
        GraphOptions(m=1).check(Metric.L2, 8)


def test_index_of_one_and_two_rows(spark, name):
    c = make(spark, name, vector_index=IvfOptions())
    for n, text in enumerate(["alpha", "beta", "gamma"]):
        c.add_texts(texts=[text])
        assert c.search(text, k=5).count() == n + 1
    c.rebuild_index()
    assert c.search("beta", k=5).count() == 3


def test_pending_deletes_shorten_no_result(spark, name):
    c = stones(spark, name, vector_index=IvfOptions(quant="none"), query_options=IvfQuery(nprobe=100))
    c.sync_load = False
    near = contents(c.search("chalk", k=4))
    gone = {r["content"]: r["id"] for r in c.rows().collect()}
    c.delete(ids=[gone[near[0]], gone[near[2]]])
    left = contents(c.search("chalk", k=4))
    assert len(left) == 4 and left[:2] == [near[1], near[3]]
    assert c.search_with_score("chalk", k=2).where("rank = 1").count() == 1


# -- definition, versions ------------------------------------------------------------------


def test_definition_survives_open(spark, name):
    index = MetadataIndex(json_fields=[IndexedJsonField("n", "INTEGER")])
    schema = CollectionSchema.declare(
        8, id_column=Column("key", "BIGINT"), metadata_columns=[Column("kind", "TEXT", False)],
        metric=Metric.L2, metadata_index=index)
    cased = TextIndexOptions(Analyzer("split", lower=False))
    made = Collection.create(spark, name, schema, embedder=HashModel(8), text_index=cased, hybrid=WIDE)
    made.add_texts(texts=["Heron heron"], ids=["7"], metadatas=[{"kind": "x", "n": 1}])
    c = Collection.open(spark, name, embedder=HashModel(8), hybrid=WIDE)
    assert c.schema == made.schema
    c.add_texts(texts=["Tide"], ids=["8"], metadatas=[{"kind": "y", "n": 2}])
    terms = {r["term"] for r in c.text_index().postings.select("term").distinct().collect()}
    assert terms == {"Heron", "heron", "Tide"}
    assert c.rows().schema["key"].dataType.simpleString() == "bigint"
    assert contents(c.search("Tide", k=5, filter={"n": {"$gte": 2}})) == ["Tide"]
    with pytest.raises(Exception, match="not be null"):
        c.add_texts(texts=["x"], ids=["9"], metadatas=[{}])
    with pytest.raises(Exception, match="dimensions"):
        c.add_embeddings(texts=["x"], embeddings=[[0.5] * 5], ids=["9"], metadatas=[{"kind": "z"}])
    with pytest.raises(ValueError):
        Collection.open(spark, name, id_column="content")


def test_field_promoted_after_the_index_was_written(spark, name):
    c = make(spark, name, vector_index=IvfOptions(quant="none"), query_options=IvfQuery(nprobe=100))
    c.add_texts(texts=TEXTS, metadatas=METAS)
    later = Collection.open(spark, name, embedder=HashModel(8), query_options=IvfQuery(nprobe=100),
                            metadata_index=MetadataIndex(json_fields=[IndexedJsonField("n", "INTEGER")]))
    assert set(contents(later.search("x", k=5, filter={"n": {"$gte": 2}}))) == set(TEXTS[1:])


def test_drop_leaves_other_collections(spark, name):
    kept, dropped = make(spark, name + "_old"), make(spark, name)
    kept.add_texts(texts=["kept"])
    dropped.drop()
    assert kept.rows().count() == 1 and not dropped.exists()
    for bad in ("a__b", "a b", "a`b", "", "a_"):
        with pytest.raises(ValueError):
            make(spark, bad)


def test_vacuum_drops_old_versions_and_their_log(spark, name):
    c = make(spark, name, sync_load=False)
    for n in range(3):
        c.add_texts(texts=[f"text {n}"], ids=[str(n)])
        c.refresh()
    old = spark.table(c._name("rows_1")).count()
    assert old == 1 and spark.table(c._name("log")).count() == 3
    c.add_texts(texts=["pending"], ids=["p"])
    c.vacuum()
    assert spark.table(c._name("log")).count() == 1 and c.rows().count() == 4
    assert not spark.catalog.tableExists(c._name("rows_1"))
    c.compact()
    assert spark.table(c._name("log")).count() == 0 and c.published().count() == 4
    c.add_texts(texts=["after"], ids=["0"])
    assert {r["content"] for r in c.rows().collect()} == {"after", "text 1", "text 2", "pending"}


# -- metadata index ----------------------------------------------------------------------

PARITY = [
    {"kind": {"$eq": "rock"}},
    {"kind": {"$nin": ["rock"]}},
    {"n": 2},
    {"n": {"$lt": 4}},
    {"n": {"$in": [1, 4]}},
    {"tag": {"$ne": "t1"}},
    {"tag": {"$like": "t%"}, "n": {"$gt": 2}},
    {"$or": [{"kind": "wet"}, {"tag": "t0"}]},
    {"$not": {"$and": [{"n": {"$gte": 2}}, {"tag": "t2"}]}},
]


def test_metadata_index_changes_no_result(spark):
    index = MetadataIndex(json_fields=[IndexedJsonField("n", "INTEGER"),
                                       IndexedJsonField("tag", "TEXT")])
    stores = []
    for name, spec in (("parity_plain", None), ("parity_indexed", index)):
        c = make(spark, name, schema={"metadata_index": spec})
        c.add_texts(texts=[*TEXTS, "flint beach"], metadatas=[
            {"kind": a, "n": i + 1, "tag": t} for i, (a, t) in enumerate(
                [("wet", "t0"), ("wet", "t1"), ("rock", "t2"), ("rock", "t0")])])
        stores.append(c)
    assert "json__n" in stores[1].rows().columns
    stores[1].compact()
    found = stores[1].rows().where(F.col("json__n") >= 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(json__n,3)" in plan
    for spec in PARITY:
        plain, indexed = (set(contents(c.search("x", k=10, filter=spec))) for c in stores)
        assert plain == indexed and plain
    assert set(contents(stores[1].search("x", k=9, filter={"n": {"$gte": 3}}))) == {
        "flint beach", "granite cliffs"}


# -- streaming ---------------------------------------------------------------------------


def test_continuous_ingest(spark, name, tmp_path):
    c = make(spark, name, sync_load=False)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    shape = "id string, content string, metadata string"
    rows = [("a", "one", '{"kind":"x"}'), ("b", "two", "{}"), ("a", "three", "{}")]
    spark.createDataFrame(rows, shape).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(shape).parquet(source)
    ingest(stream, c, checkpoint).awaitTermination()
    assert {(r["id"], r["content"]) for r in c.rows().collect()} == {("a", "three"), ("b", "two")}
    spark.createDataFrame([("b", "four", "{}")], shape).write.mode("append").parquet(source)
    ingest(stream, c, checkpoint, refresh_every=1).awaitTermination()
    assert {(r["id"], r["content"]) for r in c.rows().collect()} == {("a", "three"), ("b", "four")}
    assert c.published().count() == 2
    # A replayed batch takes its old place and changes nothing.
    from trawl.streaming.ingest import write_batch
    seq = c.stream_seq(checkpoint, 0)
    write_batch(spark.createDataFrame(rows, shape).coalesce(1), c, seq)
    assert c.rows().count() == 2 and c.rows().where(F.col("content") == "four").count() == 1
    c.compact()
    assert {(r["id"], r["content"]) for r in c.published().collect()} == {
        ("a", "three"), ("b", "four")}
    write_batch(spark.createDataFrame(rows, shape).coalesce(1), c, seq)
    assert c.rows().where(F.col("content") == "four").count() == 1


# -- incremental publishing --------------------------------------------------------------


def _files(spark, c):
    """Every data file of the collection's published tables."""
    found = set()
    for t in spark.catalog.listTables(c.database):
        if t.name.startswith(c.name + "__") and ("rows_" in t.name or "ix_" in t.name):
            found |= set(spark.table(f"{c.database}.{t.name}").inputFiles())
    return found


def test_a_small_publish_writes_its_own_partition_alone(spark, name):
    c = make(spark, name, vector_index=IvfOptions(cells=4, quant="sq8"), text_index=TextIndexOptions(),
             query_options=IvfQuery(nprobe=100), hybrid=WIDE, sync_load=False)
    texts = [f"stone number {n} of the shore" for n in range(40)]
    c.add_texts(texts=texts, ids=[str(n) for n in range(40)])
    c.refresh()
    before = _files(spark, c)
    c.add_texts(texts=["a heron on the shore"], ids=["7"])
    c.refresh()
    after = _files(spark, c)
    assert before <= after and all("/gen=2/" in f for f in after - before) and after > before
    state = c.state()
    assert (state.version, state.base, state.changed, state.base_rows) == (2, 1, 1, 40)
    c.delete(ids=["8", "9"])
    c.add_texts(texts=["a gull at sea"], ids=["7"])
    c.add_texts(texts=["a second gull"], ids=["new"])
    c.refresh()
    assert all("/gen=2/" in f or "/gen=3/" in f for f in _files(spark, c) - before)
    kept = {r["id"] for r in c.published().collect()}
    assert kept == {str(n) for n in range(40) if n not in (8, 9)} | {"new"}
    # Statistics, postings and cells are those of an index built anew.
    index = c.text_index()
    fresh = LexicalIndex.build(c.rows(), "id", "content", positions=True)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(index.terms.select("term", "df", "ttf")) == key(fresh.terms.select("term", "df", "ttf"))
    assert key(index.postings.select("term", "id", "tf", "dl")) == key(fresh.postings.select("term", "id", "tf", "dl"))
    assert index.sums() == (39, c.rows().selectExpr("sum(size(split(content, ' ')))").first()[0])
    assert {r["id"] for r in c.vector_index().cells.collect()} == kept
    assert contents(c.search("gull", k=2))[0].endswith("gull") or "gull" in contents(c.search("gull", k=2))[0]
    assert contents(c.search_with_score("a gull at sea", k=1)) == ["a gull at sea"]
    again = Collection.open(spark, name, embedder=HashModel(8), hybrid=WIDE)
    assert again.rows().count() == 39 and again.text_index().sums() == index.sums()


def test_many_changes_make_a_new_base(spark, name):
    c = make(spark, name, text_index=TextIndexOptions(), sync_load=False)
    bases = []
    for n in range(12):
        c.add_texts(texts=[f"text {n}"], ids=[str(n)])
        c.refresh()
        bases.append(c.state().base)
    assert len(set(bases)) < 9  # not every version is written whole
    assert c.published().count() == 12 and c.text_index().sums() == (12, 24)
    c.compact()
    state = c.state()
    assert state.base == state.version and spark.table(c._name("log")).count() == 0
    assert c.text_index().sums() == (12, 24) and c.published().count() == 12
    # A version that was written but not published is written over.
    for n in range(12, 16):
        c.add_texts(texts=[f"text {n}"], ids=[str(n)])
    dirty = c._log(c.state().upto).select("id").distinct()
    c._extend(c.state(), dirty, 4, 99)
    c.refresh()
    assert c.text_index().sums() == (16, 32) and c.published().count() == 16
