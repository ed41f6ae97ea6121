"""What a collection's writes leave on disk: no contents beside the rows, no shuffles of rows for their ids."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from trawl.functions.embed import HashModel
from trawl.operators import mutate
from trawl.operators.lexical import LexicalIndex, lexical_topk
from trawl.schema import CollectionSchema, Column
from trawl.session import dropping_shuffles
from trawl.sources.collection import Collection
from trawl.sources.options import IvfOptions, IvfQuery, TextIndexOptions
from trawl.sources.storage import Folder


def _rows(spark, numbers, mark=""):
    rows = spark.createDataFrame([(i,) for i in numbers], "n long")
    return rows.select(F.col("n").cast("string").alias("id"), F.concat(
        F.lit(f"{mark}word"), F.col("n") % 7, F.lit(" number"), F.col("n"), F.lit(" other words")).alias("content"),
        F.to_json(F.struct((F.col("n") % 3).cast("string").alias("lang"))).alias("metadata"))


@pytest.fixture
def target(spark):
    schema = CollectionSchema.declare(8, metadata_columns=[Column("lang", "TEXT")], id_column=Column("id", "BIGINT"))
    made = Collection.create(
        spark, "disk_" + uuid.uuid4().hex[:10], schema, embedder=HashModel(8), sync_load=False,
        vector_index=IvfOptions(cells=3, quant="sq8"), text_index=TextIndexOptions(), query_options=IvfQuery(nprobe=99))
    yield made
    made.drop()


def _same_as_built_anew(target, numbers):
    index, rows = target.vector_index(), target.rows()
    for table, key in ((index.cells, "id"), (index.codes, "id"), (rows, "id")):
        assert sorted(r[key] for r in table.select(key).collect()) == sorted(numbers)
    text, anew = target.text_index(), LexicalIndex.build(rows, "id", "content", positions=True)
    for part in ("postings", "terms"):
        names = sorted(getattr(anew, part).columns)
        assert {str(r) for r in getattr(text, part).select(names).collect()} == {
            str(r) for r in getattr(anew, part).select(names).collect()}
    assert text.postings.count() == anew.postings.count()
    assert text.sums()[0] == len(numbers)


def test_indexes_hold_no_contents_and_filters_on_them_work(spark, target):
    target.add_texts(_rows(spark, range(60)))
    target.refresh()
    index = target.vector_index()
    assert "content" not in index.cells.columns and "content" not in index.codes.columns and "lang" in index.codes.columns
    asked = spark.createDataFrame([(1, "word1 number1 other words"), (2, "word")], "qid long, text string")
    found = target.search_with_score(asked, 50, {"$and": [{"content": {"$like": "word3%"}}, {"lang": {"$ne": "0"}}]})
    wanted = {str(i) for i in range(60) if i % 7 == 3 and i % 3}
    assert {r["id"] for r in found.where("qid = 1").collect()} == wanted
    assert found.where("qid = 2").count() == len(wanted)


@pytest.mark.parametrize("again", [[], [5, 11, 44]])
def test_rows_are_not_shuffled_for_ids_that_do_not_repeat(spark, target, monkeypatch, again):
    """Halves of a table, of which the second is as large as the first and so written whole."""
    target.add_texts(_rows(spark, range(0, 60, 2)))
    target.refresh()
    target.add_texts(_rows(spark, range(1, 60, 2)))
    for n in again:
        target.add_texts(_rows(spark, [n], "renewed "))
    asked, last_per_id = [], mutate.last_per_id
    monkeypatch.setattr(mutate, "last_per_id", lambda log, *a: asked.append(log.columns) or last_per_id(log, *a))
    gone, held = [], Collection._held
    monkeypatch.setattr(Collection, "_held", lambda *a: gone.append(held(*a)) or gone[-1])
    filed, write = [], LexicalIndex.write
    monkeypatch.setattr(LexicalIndex, "write", lambda *a, **b: filed.append(b["filed"]) or write(*a, **b))
    target.refresh()
    state = target.state()
    assert state.base == state.version == 2 and filed[0] is not None
    # 5 and 11 are written twice; 44 changes a row of the base. One more is of the version before.
    assert len(asked) == (3 if again else 1) and [g is not None and g.count() for g in gone] == ([1, 1] if again else [False, False])
    monkeypatch.undo()
    _same_as_built_anew(target, range(60))
    best = lexical_topk(target.text_index(), spark.createDataFrame([(1, "renewed")], "qid long, text string"), 9)
    assert sorted(r["id"] for r in best.collect()) == again


def test_deletions_and_a_published_addition_before_a_whole_version(spark, target):
    target.add_texts(_rows(spark, range(40)))
    target.refresh()
    target.add_texts(_rows(spark, [3, 50], "renewed "))
    target.refresh()
    assert target.state().base == 1 and target.state().version == 2
    target.delete(ids=[4, 50])
    target.add_texts(_rows(spark, [3, 5, 60]))
    target.compact()
    assert target.state().base == 3
    _same_as_built_anew(target, sorted({*range(40), 60} - {4}))


def test_shuffles_end_with_the_write(spark, tmp_path):
    def files():
        top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in top for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    before = files()
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 10).alias("k")).count()
    out = Folder(spark, str(tmp_path)).save("rows", rows)
    assert out.count() == 10 and not [f for f in files() - before if f.endswith(".data")][3:]
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with pytest.raises(KeyError), dropping_shuffles(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name, None) == was
