import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF
from trawl.llm.packing import PackingPlan, best_fit, lower_bound, pack, pack_counts, piece_bounds
from trawl.llm.queries import QUERIES, tokenizer_file


def ids_of(text):
    encoder = Tokenizer.from_file(tokenizer_file())
    encoder.encode_special_tokens = True
    return [*encoder.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, found, capacity):
    """Every document's ids are there, in pieces, and every sequence is gapless and within capacity."""
    wanted = sorted(((d, *piece, zlib.crc32(np.array(ids_of(t)[piece[1]:sum(piece[1:])], "<u4").tobytes()))
                     for d, t in rows for piece in
                     [(n, s, k) for n, (s, k) in enumerate(piece_bounds(len(ids_of(t)), capacity))]), key=repr)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=repr) == wanted
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_query_is_an_exact_round_trip(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    assert check(rows, found, 2048) == -(-sum(r["length"] for r in found) // 2048)


def test_rows_of_every_kind(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y"), (4, "word " * 5000), (5, "<|endoftext|> 🙂")]
    rows += [(6, "same text here")] * 300
    found = pack(docs_of(rows, length="old", piece="old").repartition(5), tokenizer_file(), 64).collect()
    check(rows, found, 64)
    assert pack(docs_of([]), tokenizer_file()).count() == 0


def test_pieces():
    assert piece_bounds(1, 10) == [(0, 1)] and piece_bounds(10, 10) == [(0, 10)]
    assert piece_bounds(25, 10) == [(0, 5), (5, 10), (15, 10)] and piece_bounds(20, 10) == [(0, 10), (10, 10)]


def fewest(pieces, capacity):
    """The least number of sequences, by taking the largest piece with every subset of the others."""
    if not pieces:
        return 0
    first, rest = pieces[0], pieces[1:]
    best = len(pieces)
    for size in range(len(rest) + 1):
        for chosen in combinations(range(len(rest)), size):
            if first + sum(rest[i] for i in chosen) <= capacity:
                best = min(best, 1 + fewest([v for i, v in enumerate(rest) if i not in chosen], capacity))
    return best


@pytest.mark.parametrize("seed", range(25))
def test_search_is_optimal_on_small_tables(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 20, 50])
    pieces = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(1, 8))), reverse=True)
    counts = {v: pieces.count(v) for v in pieces}
    least = fewest(pieces, capacity)
    assert sum(n for n, _ in pack_counts(counts, capacity)) == least
    assert lower_bound(counts, capacity) <= least <= sum(n for n, _ in best_fit(counts, capacity))


@pytest.mark.parametrize("seed", range(20))
def test_plan_places_every_piece_once(seed):
    rnd = random.Random(seed)
    counts = {rnd.randint(1, 100): rnd.choice([1, 2, 50, 1000]) for _ in range(rnd.randint(1, 60))}
    plan = PackingPlan(pack_counts(counts, 100))
    lengths = np.concatenate([np.full(n, v) for v, n in counts.items()])
    ranks = np.concatenate([np.arange(n) for n in counts.values()])
    sequences, offsets = plan.place(lengths, ranks)
    order = np.lexsort((offsets, sequences))
    s, o, n = sequences[order], offsets[order], lengths[order]
    first = np.append(True, s[1:] != s[:-1])
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all() and (o + n).max() <= 100


def test_search_beats_best_fit_where_it_can():
    counts = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2}
    assert sum(n for n, _ in pack_counts(counts, 10)) == 4
