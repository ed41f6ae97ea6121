import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF
from trawl.llm import ngram_join
from trawl.llm.ngram_join import components, join_group, keep_first, near_duplicates, shingle_set
from trawl.llm.queries import QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(n, component) of every row by comparing all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    holders, parent = defaultdict(list), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        shared = Counter(j for g in s for j in holders[g])
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(rows)),
                  key=repr)


def answer(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert answer(QUERIES["op4_ngram_jaccard_join"](spark, SF)) == brute(rows)


def chains(words, seed, n=40):
    """Near copies of copies, a shared passage, exact copies and unrelated texts."""
    rnd = np.random.default_rng(seed)
    base, passage = words(80, seed), words(60, 99)
    rows, text = [], list(base)
    for i in range(n):
        text = list(text)
        text[rnd.integers(len(text))] = f"edit{seed}x{i}"
        rows.append((seed * 1000 + i, " ".join(text)))
        rows.append((seed * 1000 + 500 + i, " ".join(passage + words(30, seed * 100 + i))))
    return rows + [(seed * 1000 + 900 + i, rows[i][1].upper()) for i in range(0, n, 5)]


@pytest.mark.parametrize("block, pivot_bytes", [(100_000, 1 << 25), (600, 1 << 25), (600, 0)])
def test_blocks_and_pivots_lose_no_link(spark, docs_of, words, monkeypatch, block, pivot_bytes):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(ngram_join, "PIVOT_SHINGLES", block)
    monkeypatch.setattr(ngram_join, "BROADCAST_BYTES", pivot_bytes)
    monkeypatch.setattr(ngram_join, "SLICE_SHINGLES", 500)
    rows = chains(words, 1) + chains(words, 2)
    assert answer(near_duplicates(docs_of(rows).repartition(5))) == brute(rows)


def test_rows_of_every_kind(spark, docs_of, words):
    long = " ".join(words(30_000, 5))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one\u00a0two"), (7, "one two three"),
            (8, long), (9, long + " end"), (10, long), (10, long), (None, long), (None, None), (11, "é é é é é É"),
            (12, "a b c d e"), (13, "a b c d e"), (14, "a b c d e f")]
    found = near_duplicates(docs_of(rows, component_id="old", n="old", key="old"))
    assert answer(found) == brute(rows)


def test_threshold_is_exact(spark, docs_of):
    # 7 shingles, of which 6 shared with one of 7: 6 of 8 is exactly 0.75.
    rows = [(1, "a b c d e f g h i j k"), (2, "z b c d e f g h i j k"), (3, "y x b c d e f g h i j k")]
    assert answer(near_duplicates(docs_of(rows))) == brute(rows)
    assert answer(near_duplicates(docs_of(rows)))[1][2] == 1


def test_keep_first(spark, docs_of, words):
    text = " ".join(words(50, 3))
    rows = [(1, text), (2, text + " x"), (3, "other"), (3, "other"), (None, text), (4, None), (5, None), (2, text)]
    kept = keep_first(docs_of(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((str(r["doc_id"]) for r in kept.collect())) == ["1", "3", "4", "5", "None"]


def test_keep_first_tells_rows_of_one_id_apart(spark, docs_of, words):
    a, b, c = (" ".join(words(50, n)) for n in (3, 4, 5))
    rows = [(3, a), (7, a), (7, b), (7, b), (8, None), (8, ""), (9, c), (9, c), (10, c), (11, b)]
    kept = sorted((r["doc_id"], r["text"]) for r in keep_first(docs_of(rows, row_set="old")).collect() if r["doc_id"] != 8)
    assert kept == [(3, a), (7, b), (9, c)]


def test_slices_do_not_depend_on_arrow_batches(spark, docs_of, words, monkeypatch):
    docs = docs_of(chains(words, 1)).repartition(2).cache()
    sizes = []
    for rows in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        sizes.append(ngram_join._sliced(docs, 1).selectExpr("count(*)", "sum(length(hashes))").first())
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes[0] == sizes[1] and sizes[0][0] > 0


def test_empty_table(spark, docs_of):
    assert near_duplicates(docs_of([])).count() == 0
    assert keep_first(docs_of([])).count() == 0


def test_group_join_equals_brute_force():
    rnd = np.random.default_rng(0)
    for _ in range(40):
        pool = rnd.integers(0, 40, (6, 12))
        sets = [np.unique(np.where(rnd.random(12) < 0.12, rnd.integers(0, 40, 12), pool[rnd.integers(6)])).astype(
            np.uint64) for _ in range(25)]
        parent = np.arange(25)
        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[parent == parent[i]] = parent[j]
        found = join_group(sets, [None] * 25)
        assert len(np.unique(found)) == len(np.unique(parent)) == len(set(zip(found, parent)))


def test_components_of_chains(spark):
    links = [(i, i - 1) for i in range(1, 40) if i % 13] + [(100, 7), (101, 100), (200, 201)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found[101] == found[12] == 0 and found[38] == found[27] == 26 and found[201] == 200


def test_components_of_random_links(spark):
    rnd = np.random.default_rng(4)
    for nodes, links in ((40, 30), (60, 90), (300, 280)):
        names = rnd.permutation(10 * nodes)[:nodes]
        ends = names[rnd.integers(0, nodes, (links, 2))]
        ends = np.concatenate([ends[ends[:, 0] != ends[:, 1]], np.stack([names[:-1], names[1:]], 1)[:nodes // 3]])
        parent = {int(x): int(x) for x in ends.ravel()}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in ends.tolist():
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        found = components(spark.createDataFrame([tuple(map(int, e)) for e in ends], "a long, b long")).collect()
        assert {r["id"]: r["component"] for r in found} == {x: root(x) for x in parent} and len(found) == len(parent)


def test_long_text_is_split_alike(monkeypatch, words):
    text = "  ".join(words(500, 1)) + "\n"
    whole = shingle_set(text)
    monkeypatch.setattr(ngram_join, "_SLICE_CHARS", 50)
    assert np.array_equal(shingle_set(text), whole)


def test_linked_sets_have_a_mark_in_common():
    rnd = np.random.default_rng(2)
    for n in [1, 2, 3, 4, 5, 7, 8, 9, 16, 40, 64, 100, 103, 240, 300, 420, 1000, 3000]:
        for _ in range(20):
            shared = rnd.integers(0, 2**63, ngram_join.least_overlap(n), np.uint64)
            own = rnd.integers(0, 2**63, n - len(shared), np.uint64)
            # Exactly at the threshold: the rest of one set, or as much of both as it allows.
            most = (len(shared) * 4 // 3) - n
            other = rnd.integers(0, 2**63, max(0, most), np.uint64)
            a, b = np.unique(np.append(shared, own)), np.unique(np.append(shared, other))
            assert ngram_join._linked(len(shared), len(a), len(b))
            levels = rnd.integers(0, 4, 1 << 16).astype(np.uint8)
            bands = [{x, x + 1} for x in (ngram_join._band(len(a)), ngram_join._band(len(b)))]
            assert bands[0] & bands[1]
            for pair in bands[0] & bands[1]:
                for thin in {True, any(ngram_join._thin(s, pair) for s in (a, b))}:
                    marks = [ngram_join._marks(s, levels[(s & np.uint64(0xFFFF)).astype(np.int64)], pair, thin, 5)
                             for s in (a, b)]
                    assert len(np.intersect1d(*marks))


def test_sets_without_enough_parts_are_told():
    one_part = np.arange(2000, dtype=np.uint64)
    one_part = one_part[ngram_join._parts(one_part, 17)[0] == ngram_join._parts(one_part, 17)[0][0]][:3]
    assert len(one_part) == 3 and ngram_join._thin(one_part, 17)
    assert not ngram_join._thin(np.arange(160, dtype=np.uint64), 17)


def test_shingles_shared_by_chance_join_no_groups(spark, docs_of, words, monkeypatch):
    """Pairs of near copies, each of which shares a line with four other pairs."""
    rows, slots = [], np.random.default_rng(7).permutation(np.repeat(np.arange(300), 2)).reshape(150, 4)
    for i, lines in enumerate(slots):
        text = [f"own{i}y{j}" for j in range(140)]
        for at, line in zip((120, 90, 60, 30), lines):
            text[at:at] = [f"line{line}x{j}" for j in range(8)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join([*text[:75], "edit", *text[75:]]))]
    seen, links_within = [], ngram_join._links_within

    def counted(members):
        seen.append(members.groupBy("grp").count().agg({"count": "max"}).first()[0])
        return links_within(members)

    monkeypatch.setattr(ngram_join, "_links_within", counted)
    assert answer(near_duplicates(docs_of(rows))) == brute(rows)
    assert seen[0] < 60  # one group held nearly all of the 300
