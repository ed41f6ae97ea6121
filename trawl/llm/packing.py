"""Packing of tokenized documents into as few sequences as possible, by bin completion.

Only how many pieces there are of each length matters for the packing, and lengths go from 1 to the
capacity, so the search works on a table of ``capacity`` counts whatever the corpus holds. It yields
runs of equal fillings ("n sequences of one piece of 1500 and two of 274"); the k-th piece of a
length then finds its sequence by its rank alone.
"""

from __future__ import annotations

import functools
import heapq
import json
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of
from trawl.session import cut_lineage

END_ID = 0
#: Fillings tried around one piece, extensions looked at to find them, and extensions of the whole
#: search. The best-fit solution is there from the start, so an ended search still packs everything.
FILLINGS, EXTENSIONS, STEPS = 8, 256, 50_000


# -- tokens ------------------------------------------------------------------------------------


@functools.cache
def text_encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file; its vocabulary also serves tiktoken's faster
    implementation, which is used where both agree on a probe text."""
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = True

    def slow(text):
        return exact.encode(text, add_special_tokens=False).ids

    try:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        unicode_of = {b: chr(b) for b in printable}
        unicode_of |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in unicode_of)}
        byte_of = {c: b for b, c in unicode_of.items()}
        special = exact.get_added_tokens_decoder()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i not in special}
        fast = tiktoken.Encoding("from_file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        if all(fast.encode_ordinary(t) == slow(t) for t in _PROBES):
            return fast.encode_ordinary
    except (ImportError, KeyError, ValueError):
        pass
    return slow


#: The published word pattern of byte-level BPE.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PROBES = ("", " ", "a  b\n\n c\t", "It's 12,345 — naïve Ünï 漢字 🙂 <|endoftext|> x", "…!!  ??\r\n")


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; of several, the first may be shorter."""
    first = length - (length - 1) // capacity * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and the piece's rank ``nth`` within ``part, length``."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()),
                        ("nth", pa.int64())])

    def run(batches):
        encode, seen = text_encoder(tokenizer), {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, text in zip(texts_of(batch, "doc_id"), texts_of(batch)):
                ids = np.array([*(encode(text) if text else ()), END_ID], "<u4")
                for piece, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    nth = seen[length] = seen.get(length, -1) + 1
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    rows.append((doc_id, piece, start, length, crc, part, nth))
            yield batch_of(schema, *(zip(*rows) if rows else [[]] * len(schema)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


# -- the search over counts --------------------------------------------------------------------


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best-fit decreasing over counts: runs of (sequences, ((length, pieces), ...))."""
    runs: dict[int, list] = {capacity: []}  # room left -> runs of open sequences
    rooms: list[int] = []  # sorted rooms that have open sequences
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                number, filling = runs[room].pop()
                if not runs[room]:
                    rooms.pop(at)
            else:
                room, filling = capacity, ()
                number = -(-left // (capacity // length))
            # As many of this length as fit, in as many of these sequences as there are pieces for.
            each = min(room // length, left)
            used = min(number, left // each)
            todo = [(used, each)] + ([(1, left - used * each)] if used < number and left - used * each else [])
            rest = number
            for sequences, pieces in todo:
                new = room - pieces * length
                if new not in runs or not runs[new]:
                    rooms.insert(bisect_left(rooms, new), new)
                runs.setdefault(new, []).append((sequences, filling + ((length, pieces),)))
                left -= sequences * pieces
                rest -= sequences
            if rest and filling:
                if not runs.get(room):
                    rooms.insert(bisect_left(rooms, room), room)
                runs.setdefault(room, []).append((rest, filling))
    return [run for room in sorted(runs) for run in runs[room]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by the sum of lengths, and by pieces that exclude each other.

    For a least length ``k``, pieces over ``capacity - k`` stand alone, those over half a sequence
    need one each, and what of the others from ``k`` on does not fit beside these needs more.
    """
    best = -(-sum(v * n for v, n in counts.items()) // capacity)
    for k in [0, *(v for v in counts if 2 * v <= capacity)]:
        alone = sum(n for v, n in counts.items() if v > capacity - k)
        large = [(v, n) for v, n in counts.items() if capacity < 2 * v and v <= capacity - k]
        room = sum(n * (capacity - v) for v, n in large)
        small = sum(v * n for v, n in counts.items() if k <= v and 2 * v <= capacity)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(small - room) // capacity)))
    return best


def undominated(largest: int, counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Fillings around one piece of length ``largest``, fullest first, and the steps it took.

    A filling is dominated if another holds a longer piece in place of one of its pieces, or one
    piece more, and still fits; such a filling need not be tried.
    """
    lengths = sorted((v for v, n in counts.items() if n), reverse=True)
    smallest = lengths[-1] if lengths else capacity + 1
    found: list[tuple[int, tuple]] = []
    steps = 0

    def extend(at: int, room: int, chosen: tuple):
        nonlocal steps
        steps += 1
        if steps > EXTENSIONS:
            return
        used = dict(chosen)
        if room < smallest or all(v > room or used.get(v, 0) >= counts[v] for v in lengths[at:]):
            free = [v for v in lengths if v <= room and used.get(v, 0) < counts[v]]
            swap = any(used.get(v, 0) < counts[v] and w < v <= w + room for w, _ in chosen for v in lengths)
            if not free and not swap:
                found.append((room, chosen))
            return
        for i in range(at, len(lengths)):
            v = lengths[i]
            if v <= room and used.get(v, 0) < counts[v]:
                most = min(room // v, counts[v])
                for n in range(most, 0, -1):
                    extend(i + 1, room - n * v, chosen + ((v, n),))
                    if not room - n * v and n == most:
                        break

    extend(0, capacity - largest, ())
    if not found:
        found = [(capacity - largest, ())]
    return [f for _, f in heapq.nsmallest(FILLINGS, found, key=lambda f: (f[0], len(f[1])))], steps


def pack_counts(counts: dict[int, int], capacity: int, steps: int = STEPS) -> list[tuple[int, tuple]]:
    """Runs of equal fillings that hold every counted piece, in as few sequences as are found.

    Branch and bound: the incumbent is best fit. A node takes the largest piece left, tries its
    undominated fillings from the fullest on, each in as many sequences as the counts allow, and is
    given up once its waste exceeds what a solution better than the incumbent can afford.
    """
    counts = {int(v): int(n) for v, n in counts.items() if n}
    total = sum(v * n for v, n in counts.items())
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    best_size = sum(n for n, _ in best)
    budget = steps
    # Depth first, by hand, as there may be thousands of fillings on a path.
    stack = [(counts, (), 0, 0)] if best_size > least else []
    while stack and budget > 0 and best_size > least:
        left, path, used, waste = stack.pop()
        if waste > (best_size - 1) * capacity - total:
            continue
        if not left:
            best, run = [], path
            while run:
                run, entry = run
                best.append(entry)
            best_size = used
            continue
        largest = max(left)
        one_less = {**left, largest: left[largest] - 1}
        branches = []
        fillings, spent = undominated(largest, one_less, capacity)
        budget -= spent
        for filling in fillings:
            whole: dict[int, int] = {largest: 1}
            for v, n in filling:
                whole[v] = whole.get(v, 0) + n
            times = min(left[v] // n for v, n in whole.items())
            rest = {v: n - times * whole.get(v, 0) for v, n in left.items()}
            lost = capacity - sum(v * n for v, n in whole.items())
            branches.append(({v: n for v, n in rest.items() if n},
                             (path, (times, tuple(sorted(whole.items(), reverse=True)))),
                             used + times, waste + times * lost))
        stack.extend(reversed(branches))
    return best


class PackingPlan:
    """For every length, where its pieces go by rank: sorted first ranks and the run of each."""

    def __init__(self, runs: list[tuple[int, tuple]]):
        self.first: dict[int, list[int]] = {}
        self.run: dict[int, list[tuple[int, int, int]]] = {}
        taken: dict[int, int] = {}
        sequence = 0
        for number, filling in runs:
            offset = 0
            for length, pieces in filling:
                start = taken.get(length, 0)
                self.first.setdefault(length, []).append(start)
                self.run.setdefault(length, []).append((sequence, pieces, offset))
                taken[length] = start + number * pieces
                offset += length * pieces
            sequence += number

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these ranks, counted from 0 within their length."""
        sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            first, runs = np.array(self.first[length]), np.array(self.run[length])
            run = np.searchsorted(first, ranks[at], "right") - 1
            inside = ranks[at] - first[run]
            sequences[at] = runs[run, 0] + inside // runs[run, 1]
            offsets[at] = runs[run, 2] + inside % runs[run, 1] * length
        return sequences, offsets


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs``.

    A document is its text's ids followed by id 0; a null or empty text is that one id. A longer
    one than ``capacity`` is cut into pieces of ``capacity`` ids, the first of which may be shorter.
    Pieces of a length are ranked by the partition that made them and their order in it, so one
    length may hold any share of the rows. Repeated rows are packed each on its own; an empty table
    gives no rows; other columns play no part.
    """
    pieces = cut_lineage(tokenized_pieces(docs, tokenizer, capacity))
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in  # one row for each length, ``capacity`` at most
              by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(PackingPlan(pack_counts(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64())])

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            placed = plan.value.place(columns["length"].to_numpy(), columns["rank"].to_numpy())
            yield batch_of(schema, *(columns[f.name] for f in list(schema)[:5]), *placed)

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")
