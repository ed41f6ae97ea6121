import random

import numpy as np

from conftest import SF
from trawl.llm import decontaminate
from trawl.llm.decontaminate import common_subsequence, find_leaks, randomised_svd, remove_leaking
from trawl.llm.queries import QUERIES


def squeeze(text):
    return " ".join((text or "").lower().split())


def test_query_finds_every_verbatim_item(spark):
    docs = {r["doc_id"]: squeeze(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: squeeze(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    wanted = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_benchmark_leaks"](spark, SF).collect()}
    assert wanted and wanted <= found
    assert len(found - wanted) <= len(wanted) // 10


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def corpus(words, n=60):
    return [(i, " ".join(words(120, i))) for i in range(n)]


def test_reworded_passages_are_found_and_clean_texts_left(spark, docs_of, words):
    item = words(30, 1000)
    rnd = random.Random(1)
    reworded = [w if rnd.random() > 0.2 or i > 25 else "swapped" + str(i) for i, w in enumerate(item)]
    half = item[:10] + words(20, 1001)
    rows = corpus(words)
    rows += [(100, " ".join(words(200, 2) + item + words(300, 3))), (101, " ".join(words(50, 4) + reworded)),
             (102, " ".join(half)), (103, " ".join(item).upper() + "!!"), (104, " ".join(reversed(item)))]
    found = {r["doc_id"]: r for r in find_leaks(docs_of(rows), items_of(spark, [(1, " ".join(item))])).collect()}
    assert set(found) == {100, 101, 103}
    assert found[100]["overlap"] == 1.0 and found[101]["overlap"] < 1.0
    assert found[100]["first_word"] <= 200 and found[100]["last_word"] >= 230
    kept = remove_leaking(docs_of(rows), items_of(spark, [(1, " ".join(item))]))
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {100, 101, 103}


def test_rows_of_every_kind(spark, docs_of, words):
    item = " ".join(words(40, 7007))
    far = " ".join(words(20_000, 8)) + " " + item + " " + " ".join(words(500, 9))
    rows = corpus(words) + [(100, None), (101, ""), (102, " \n"), (103, far), (104, item), (104, item), (None, item)]
    items = items_of(spark, [(1, item), (1, item), (2, None), (3, ""), (4, "!!"), (None, " ".join(words(30, 7050)))])
    found = find_leaks(docs_of(rows, similarity="old", item_id="old"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(103, 1), (104, 1), (None, 1)}
    kept = remove_leaking(docs_of(rows), items)
    assert kept.count() == len(rows) - 3  # the null id cannot be named and stays


def test_long_texts_and_many_items_lose_nothing(spark, docs_of, words, monkeypatch):
    items = [(i, " ".join(words(25, 2000 + i))) for i in range(60)] + [(99, " ".join(words(200, 4000)))]
    rows = corpus(words) + [(1000 + i, " ".join(words(90, 3000 + i)) + " " + t) for i, t in items]
    wanted = {(1000 + i, i) for i, _ in items}
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(docs_of(rows), items_of(spark, items)).collect()} == wanted
    monkeypatch.setattr(decontaminate, "SLICE", 400)
    monkeypatch.setattr(decontaminate, "BLOCK_PASSAGES", 16)
    monkeypatch.setattr(decontaminate, "WAVE_BLOCKS", 2)
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(docs_of(rows), items_of(spark, items)).collect()} == wanted


def test_an_item_in_a_third_of_the_rows_is_found_in_all(spark, docs_of, words):
    item, other = words(29, 1000), words(15, 1100)
    reworded = [w if i % 5 else "swapped" + str(i) for i, w in enumerate(item)]
    rows = [(i, " ".join(words(120, i))) for i in range(400)]
    rows += [(1000 + i, " ".join(words(60, 5000 + i) + (item if i % 2 else reworded) + words(60, 7000 + i)))
             for i in range(200)]
    rows += [(2000, " ".join(words(70, 9000) + other + words(60, 9001)))]
    items = items_of(spark, [(1, " ".join(item)), (2, " ".join(other))])
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs_of(rows), items).collect()}
    assert found == {(1000 + i, 1) for i in range(200)} | {(2000, 2)}
    same = find_leaks(docs_of([(1, " ".join(item))]), items).collect()  # every word in every document
    assert [(r["doc_id"], r["item_id"]) for r in same] == [(1, 1)]


def test_runs_of_words_are_found_without_the_rest(spark, docs_of, words):
    item, long, short = words(45, 1000), words(200, 1200), words(6, 1300)
    pieces = {(100, 1): item[:27], (101, 1): item[:36], (102, 1): item[20:33], (103, 2): long[55:70],
              (104, 2): long[60:73], (105, 3): short, (106, 2): long[187:]}
    less = {110: item[:12], 111: long[58:70]}
    rows = corpus(words)
    rows += [(d, " ".join(words(150, 6000 + d) + part + words(150, 6500 + d))) for (d, _), part in pieces.items()]
    rows += [(d, " ".join(words(150, 6000 + d) + part + words(150, 6500 + d))) for d, part in less.items()]
    items = items_of(spark, [(1, " ".join(item)), (2, " ".join(long)), (3, " ".join(short))])
    found = {(r["doc_id"], r["item_id"]): r for r in find_leaks(docs_of(rows), items).collect()}
    assert set(found) == set(pieces)
    assert (found[102, 1]["first_word"], found[102, 1]["last_word"]) == (150, 163)
    assert found[102, 1]["overlap"] == 13 / 45 and 0 < found[102, 1]["similarity"] < 1


def test_empty_tables(spark, docs_of, words):
    assert find_leaks(docs_of([]), items_of(spark, [(1, "a b c")])).count() == 0
    assert find_leaks(docs_of(corpus(words, 3)), items_of(spark, [])).count() == 0


def test_common_subsequence_equals_table():
    rnd = random.Random(3)
    for _ in range(50):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randint(1, 20))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert common_subsequence(a, b) == best[-1][-1]


def test_svd_spans_the_rows():
    a = np.random.default_rng(0).standard_normal((12, 40))
    basis = randomised_svd(a, 12)
    assert np.allclose(a @ basis @ basis.T, a)
    assert np.allclose(np.sort(np.linalg.norm(a @ randomised_svd(a, 3), axis=0))[::-1],
                       np.linalg.svd(a)[1][:3], rtol=0.02)


def test_only_the_leaking_rows_of_an_id_go(spark, docs_of, words):
    item = " ".join(words(40, 1))
    clean = " ".join(words(60, 2))
    docs = docs_of([(1, clean + " " + item), (1, clean), (2, clean), (None, item), (3, None)], row_key="old")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    left = remove_leaking(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted(
        [(1, clean), (2, clean), (None, item), (3, None)], key=repr)
