import random
import zlib
from collections import Counter

import pytest

from check_queries import compare
from conftest import SF
from trawl.llm import spelling
from trawl.llm.queries import ORACLES, QUERIES
from trawl.llm.spelling import GramDictionary, count_words, group_variants, misspelt, near_pairs, runs_of


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    """form, root, n_near and form_n of every word, by all pairs."""
    near = {w: sorted((-counts[v], v) for v in counts if one_edit(v, w)) for w in counts}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 5 * counts[w] else None for w in counts}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def variants(seed, stems=40):
    """Words in clusters of near words, with counts in chains of ratios about five."""
    rnd, counts = random.Random(seed), {}
    letters = "abcdeé"
    for _ in range(stems):
        stem = "".join(rnd.choice(letters) for _ in range(rnd.randint(6, 11)))
        n = rnd.choice([5, 25, 125, 625, 3125])
        for _ in range(12):
            counts[stem] = n
            place, kind = rnd.randrange(len(stem)), rnd.random()
            stem = stem[:place] + (rnd.choice(letters) if kind < 0.7 else "") + stem[place + (kind < 0.4 or kind >= 0.7):]
            n = rnd.choice([n, n * 5, max(5, n // 5), max(5, n // 5 + 1)])
            if len(stem) < 6:
                break
    return counts


@pytest.mark.parametrize("frequent, seed", [(0, 1), (3, 2), (64, 3)])
def test_variants_equal_all_pairs(spark, monkeypatch, frequent, seed):
    """With every gram frequent, some, and none."""
    monkeypatch.setattr(GramDictionary.fit, "__defaults__", (frequent, spelling.MOST_GRAMS))
    counts = variants(seed)
    rows = group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(rows) == len(counts) and {tuple(r) for r in rows} == brute(counts)


def test_bound_holds_for_every_edit():
    """No edit touches more grams than the bound; the others stay, a place apart at most."""
    rnd = random.Random(4)
    letters = "ab"
    dictionary = GramDictionary({"".join(rnd.choice(letters + "\x02\x03") for _ in range(n)): 9 for n in range(2, 6) for _ in range(40)})
    for _ in range(400):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randint(6, 9)))
        grams = dictionary.grams(word)
        bound = dictionary.affected(word, grams)
        assert len(grams) == len(word) + 1 > bound
        for i in range(len(word) + 1):
            for other in ({word[:i] + c + word[i:] for c in letters} | {word[:i] + word[i + 1:]}
                          | {word[:i] + c + word[i + 1:] for c in letters}) - {word}:
                if len(other) >= 6:
                    shift = len(other) - len(word)
                    theirs = set(dictionary.grams(other))
                    assert sum((p, g) in theirs or (p + shift, g) in theirs for p, g in grams) >= len(grams) - bound
                    kept = dictionary.signature(word)
                    mine = {(p, g) for p, g in dictionary.signature(other)}
                    assert any((p, g) in mine or (p + shift, g) in mine for p, g in kept)


def test_fewer_grams_than_a_third_meet(spark):
    """The dictionary makes lists short: fewer words meet than with grams of the shortest length alone."""
    rnd = random.Random(5)
    words = sorted({"anti" + "".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(3000)})
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    dictionary = GramDictionary.fit(frame, 50)
    assert dictionary.counts and max(map(len, dictionary.counts)) > 3

    def met(d):
        lists = Counter((g, p) for w in words for p, g in d.signature(w))
        return sum(n * n for n in lists.values())

    assert met(dictionary) < met(GramDictionary({})) / 3
    assert len(GramDictionary.fit(frame, 50, 100).counts) <= 100
    assert near_pairs(frame, dictionary).count() == sum(
        one_edit(a, b) for i, a in enumerate(words[:1]) for b in words) + sum(
        one_edit(a, b) for i, a in enumerate(words) if i for b in words[i + 1:])


def test_words_of_texts(spark, docs_of, monkeypatch):
    text = "Straßen STRAßEN Älter__älteren x²abcdef Ünited×States naïve! " * 3
    rows = [(1, text), (1, text), (2, text * 40), (None, text), (3, None), (4, ""), (5, "short é")]
    wanted = Counter()
    import re
    for key, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            word = misspelt(run, zlib.crc32(f"{'' if key is None else key}:".encode()), 7)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            assert word == (run[:h % len(run)] + run[h % len(run) + 1:] if h % 7 == 0 else run)
            wanted[word] += 1
    found = count_words(docs_of(rows, word="old", n="old"), modulus=7)
    assert {r["word"]: r["n"] for r in found.collect()} == {w: n for w, n in wanted.items() if len(w) >= 6 and n >= 5}
    whole = runs_of(text.lower() * 50)
    monkeypatch.setattr(spelling, "SLICE", 7)
    assert runs_of(text.lower() * 50) == whole
    assert count_words(docs_of([])).count() == 0 and group_variants(count_words(docs_of([(1, None)]))).count() == 0


def test_whole_table(spark):
    problem, rows, _ = compare(spark, SF, QUERIES["op12_spelling_variants"], ORACLES["op12_spelling_variants"])
    assert problem is None and rows > 500
