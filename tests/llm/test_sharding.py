import zlib
from collections import defaultdict

from conftest import SF
from trawl.llm.queries import QUERIES
from trawl.llm.sharding import assign_shards


def brute(rows, shards):
    order = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16)
                    for i, t in rows))
    total, done, slots, out = sum(r[3] for r in order), 0, defaultdict(int), []
    for known, i, crc, size in order:
        shard = min(shards - 1, (2 * done + size) * shards // (2 * total))
        out.append((i if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        done += size
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r["id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op7_byte_shards"](spark, SF)
    assert answer(found.withColumnRenamed("doc_id", "id")) == brute(rows, 40)
    assert {(r["law"], r["grown_shard"]) for r in found.collect()} == {("bytes", None)}
    sizes = defaultdict(int)
    for r in found.collect():
        sizes[r["shard"]] += r["size"]
    largest = max(len((t or "").encode()) + 16 for _, t in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_rows_of_every_kind(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "a"), (None, None), (3, "é" * 100), (4, "x" * 200_000), (5, "t"), (5, "t"), (5, "u")]
    rows += [(7, "same")] * 500
    df = docs_of(rows, shard="old", size="old", part="old").repartition(6)
    assert answer(assign_shards(df, 4)) == brute(rows, 4)


def test_fewer_rows_than_shards_and_none(spark, docs_of):
    assert sorted(r["slot"] for r in assign_shards(docs_of([(1, "a"), (2, "b")]), 40).collect()) == [0, 0]
    assert assign_shards(docs_of([]), 40).count() == 0
