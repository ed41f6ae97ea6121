"""Near duplicates by Jaccard similarity of word n-grams: an exact T-occurrence join.

A document is its set of distinct five-word shingles; two link when their sets' similarity is at least
0.75. Only the components of these links are wanted, so the work is kept linear in the copies:

1. Documents with equal sets are one class and go on as one.
2. A linked class shares three quarters of its shingles with others. Blocks of shingles are counted
   by slices of the hash space, and classes with fewer shared shingles drop out: nearly all unique text.
3. One of two linked classes has three quarters of the other's shingles at least, so that they are of
   one or two neighbouring bands of size. For each pair of bands the hash space is cut into parts; as
   linked classes differ in a third of their shingles at most, they hold the same in most parts. What a
   class holds of a part is hashed as a whole, and linked classes have one such hash in common among the
   first third of their own, in any common order. The order puts last what a count sketch knows as
   frequent, and single shingles. Sharing one joins classes into coarse groups; links lie within the groups
   of some pair of bands. Neither shingles that texts share by chance nor a passage joins them all.
4. Within a group, classes search the inverted lists of its shingles (DivideSkip): the lists of rare
   shingles are merged, the documents that could still reach the required overlap are looked up in
   the long lists by binary search. A class that is already in the largest component need not search.
   A large group is first compared with one member, which settles most near copies, and what the
   triangle inequality leaves open is cut into blocks, compared pair by pair in tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of
from trawl.session import cut_lineage

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Shingles in a slice of the hash space, on average, and in a block of a group, at most on average.
SLICE_SHINGLES, BLOCK_SHINGLES = 4_000_000, 2_000_000
#: Shingles of a group that is first compared with a pivot, and of small groups that share a task.
PIVOT_SHINGLES, TASK_SHINGLES = 250_000, 50_000
#: Rows and shingles of a task that are cut into slices together, at most.
PIECE_ROWS, PIECE_SHINGLES = 16_384, 2_000_000
#: Ratio of the sizes at which bands begin; more than 4/3, so that linked classes are at most a band apart.
BAND_RATIO = 1.35
#: Nodes of a class: one for each pair of bands, numbered below this.
BANDS = 128
#: Counters of the frequency sketch, one for so many shingles, between two bounds; tasks that count.
SKETCH_SHINGLES, SKETCH_BITS, SKETCH_TASKS = 8, (16, 24), 64
#: Entries that a task links before it sends them on, and in a slice of them, on average.
LINK_ENTRIES, LINK_SLICE = 2_000_000, 1_000_000
#: Ids, and bytes of sets, up to which one side of a join is sent to every executor.
BROADCAST_IDS, BROADCAST_BYTES = 2_000_000, 32 << 20
_SLICE_CHARS = 1 << 21
_BLANK = " \t\n\r\x0b\x0c"


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words, A to Z lower-cased; split a slice of a long text at a time."""
    parts, at = [], 0
    while at < len(text or ""):
        end = at + _SLICE_CHARS
        while end < len(text) and text[end] not in _BLANK:
            end += 1
        words = text[at:end].encode("utf-8", "surrogatepass").lower().split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one, one of none has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(WORDS, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - size + 1 + i])
    return np.unique(h)


def least_overlap(n):
    """Shingles that a set of ``n`` shares at least with any it links to."""
    return -(-NUMERATOR * n // DENOMINATOR)


def _linked(shared, n, m):
    return DENOMINATOR * shared >= NUMERATOR * (n + m - shared)


# -- classes of equal sets ---------------------------------------------------------------------


def _key(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _key8(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n, key, key8`` of every row; the keys of an empty set are null."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("key8", pa.int64())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in texts_of(batch)]
            keys = [_key(s) if len(s) else None for s in sets]
            yield batch_of(schema, batch.column(0), [len(s) for s in sets], keys, [k and _key8(k) for k in keys])

    return docs.mapInArrow(run, "doc_id long, n long, key binary, key8 long")


# -- classes that share enough shingles --------------------------------------------------------

_SLICED = pa.schema([("slice", pa.int32()), ("batch", pa.int64()), ("hashes", pa.binary()),
                     ("owners", pa.binary()), ("counts", pa.binary()), ("credits", pa.binary()),
                     ("shared", pa.binary()), ("keys", pa.binary())])
_SLICED_DDL = ("slice int, batch long, hashes binary, owners binary, counts binary, credits binary, "
               "shared binary, keys binary")


def _sliced(docs: DataFrame, bits: int) -> DataFrame:
    """The shingles of every batch of rows, by slice of the hash space.

    A shingle that several classes of the batch hold is sent once, as shared, and credited to them
    at once; so a shingle of many documents costs one entry for each batch. The others are sent as
    32 bits within their slice, by class. Classes go by their number in the batch, and their keys
    along with one of its slices. That a class of two batches seems to share with itself only lets
    it stay on for the next step.
    """

    def pieces(batches):
        """The sets of so many rows or shingles at a time, however large Arrow's batches are."""
        sets: dict[bytes, np.ndarray] = {}
        rows = held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                for text in texts_of(batch.slice(start, 1024)):
                    s = shingle_set(text)
                    rows += 1
                    if len(s) and (key := _key(s)[:8]) not in sets:
                        sets[key] = s
                        held += len(s)
                    if rows >= PIECE_ROWS or held >= PIECE_SHINGLES:
                        yield sets
                        sets, rows, held = {}, 0, 0
        if sets:
            yield sets

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for sets in pieces(batches):
            if not sets:
                continue
            keys = np.frombuffer(b"".join(sets), np.int64)
            hashes = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(keys)), [len(s) for s in sets.values()])
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            same = hashes[1:] == hashes[:-1]
            alone = ~(np.append(same, False) | np.append(False, same))
            first = np.append(True, ~same)
            slices = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
            low = (hashes >> np.uint64(32 - bits)).astype(np.uint32)
            edges = np.searchsorted(slices, np.arange((1 << bits) + 1))
            rows = []
            for s in range(1 << bits):
                at = slice(edges[s], edges[s + 1])
                if at.start == at.stop:
                    continue
                one, own = alone[at], owner[at]
                by_owner = np.argsort(own[one], kind="stable")
                total = np.bincount(own[one], minlength=len(keys))
                credit = np.bincount(own[~one], minlength=len(keys))
                there = np.flatnonzero(total + credit)
                rows.append((s, part << 32 | number, low[at][one][by_owner].tobytes(),
                             there.astype(np.uint16).tobytes(), total[there].astype(np.uint32).tobytes(),
                             credit[there].astype(np.uint32).tobytes(), low[at][~one & first[at]].tobytes(),
                             None if rows else keys.tobytes()))
            number += 1
            yield batch_of(_SLICED, *zip(*rows))

    return docs.select("doc_id", "text").mapInArrow(run, _SLICED_DDL)


def _credits(table: pa.Table) -> pa.Table:
    """For one slice, how many of its shingles each class of each batch shares with other classes."""
    columns = {n: table[n].to_pylist() for n in ("hashes", "counts", "credits", "shared")}
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in columns["counts"]])
    hashes = np.concatenate([np.frombuffer(x, np.uint32) for x in columns["hashes"]])
    owner = np.repeat(np.arange(len(counts)), counts)
    known = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in columns["shared"]]))
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    length = np.diff(np.append(starts, len(h)))
    common = length > 1  # a batch sends a shingle once
    if len(known) and len(starts):
        common |= known[np.minimum(np.searchsorted(known, h[starts]), len(known) - 1)] == h[starts]
    total = np.bincount(owner[order][np.repeat(common, length)], minlength=len(counts))
    total += np.concatenate([np.frombuffer(x, np.uint32) for x in columns["credits"]])
    # One row for each batch, whatever the number of its classes.
    parts = np.split(total.astype(np.uint32), np.cumsum([len(x) // 4 for x in columns["counts"]])[:-1])
    return pa.table({"batch": table["batch"], "owners": table["owners"], "keys": table["keys"],
                     "credits": pa.array([x.tobytes() for x in parts], pa.binary())})


def _sum_credits(table: pa.Table) -> pa.Table:
    """The credits of one batch's classes, summed over the slices."""
    keys = next(np.frombuffer(x, np.int64) for x in table["keys"].to_pylist() if x is not None)
    owners = np.concatenate([np.frombuffer(x, np.uint16) for x in table["owners"].to_pylist()])
    credits = np.concatenate([np.frombuffer(x, np.uint32) for x in table["credits"].to_pylist()])
    total = np.bincount(owners, credits, len(keys)).astype(np.int64)
    return pa.table({"key8": keys[total > 0], "credit": total[total > 0]})


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it is known to be small; otherwise Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def sharing_sets(docs: DataFrame, classes: DataFrame, shingles: int) -> DataFrame:
    """``rep, n, band, thin, shingles, node`` of the classes that share enough of their shingles to link at all.

    ``thin`` lists the pairs of bands whose parts hold too few of the class's shingles apart.
    """
    bits = max(0, math.ceil(math.log2(max(1, shingles / SLICE_SHINGLES))))
    credits = _sliced(docs, bits).groupBy("slice").applyInArrow(
        _credits, "batch long, owners binary, keys binary, credits binary")
    shared = (credits.groupBy("batch").applyInArrow(_sum_credits, "key8 long, credit long")
              .groupBy("key8").agg(F.max("credit").alias("credit")))
    kept = cut_lineage(classes.join(shared, "key8")
                       .where(f"{DENOMINATOR} * credit >= {NUMERATOR} * n").select(F.col("rep").alias("doc_id"), "key8"))
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("band", pa.int32()),
                        ("thin", pa.list_(pa.int32())), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in texts_of(batch)]
            own = [(r, len(s), b := _band(len(s)), [p for p in (b, b + 1) if _thin(s, p)], s.tobytes()) for r, k, s in zip(
                texts_of(batch, "doc_id"), texts_of(batch, "key8"), sets) if len(s) and _key8(_key(s)) == k]
            yield batch_of(schema, *(zip(*own) if own else [[]] * 5))

    # Of rows that repeat an id only those with the text of its class; several of them do no harm.
    found = (docs.join(_sized(kept, kept.count()), "doc_id").select("doc_id", "key8", "text")
             .mapInArrow(run, "rep long, n long, band int, thin array<int>, shingles binary"))
    # A class takes part in two pairs of bands: node + band with the one below, node + band + 1 with the one above.
    return cut_lineage(found.withColumn("node", F.monotonically_increasing_id() * BANDS))


# -- coarse groups -----------------------------------------------------------------------------


def _band(n: int) -> int:
    return int(math.log(n) / math.log(BAND_RATIO))


def _most_apart(n: int) -> int:
    """Shingles that one of two linked sets holds and the other does not, at most; one set has ``n``."""
    return (DENOMINATOR - NUMERATOR) * n // NUMERATOR


def _parts(shingles: np.ndarray, pair: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle the part of the hash space it is in, for a pair of bands, and another hash of it.

    Parts hold up to 1.6 shingles, and fewer of small sets.
    """
    most = BAND_RATIO ** (pair + 1)
    parts = max(math.ceil(most / 1.6), math.ceil(4096 / most), 64)
    mixed = _mix(shingles + np.uint64(0x9E3779B97F4A7C15))
    return ((mixed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64), mixed


def _thin(shingles: np.ndarray, pair: int) -> bool:
    """Whether all parts that are not empty may differ in a linked set."""
    return np.count_nonzero(np.bincount(_parts(shingles, pair)[0])) <= _most_apart(len(shingles))


def frequency_levels(sets: DataFrame, shingles: int) -> np.ndarray:
    """For every hash cell the rounded binary logarithm of how many sets have a shingle in it.

    A task counts up to 255 and there are few tasks, so that what they send is bounded.
    """
    low, high = SKETCH_BITS
    cells, segments = 1 << min(high, max(low, math.ceil(math.log2(max(1, shingles / SKETCH_SHINGLES))))), 64
    schema = pa.schema([("segment", pa.int32()), ("counts", pa.binary())])

    def count(batches):
        total = np.zeros(cells, np.uint8)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                held = [np.frombuffer(s, np.uint64) for s in batch.column(0).slice(start, 1024).to_pylist()]
                cell, times = np.unique(np.concatenate(held) & np.uint64(cells - 1), return_counts=True)
                cell = cell.astype(np.int64)
                total[cell] = np.minimum(255, total[cell] + times)
        if total.any():
            yield batch_of(schema, list(range(segments)), [x.tobytes() for x in total.reshape(segments, -1)])

    def add(table: pa.Table) -> pa.Table:
        summed = np.zeros(cells // segments, np.int64)
        for x in table["counts"].to_pylist():
            summed += np.frombuffer(x, np.uint8)
        levels = np.round(np.log2(1 + summed)).astype(np.uint8)
        return pa.table({"segment": table["segment"][:1], "levels": pa.array([levels.tobytes()], pa.binary())})

    rows = (sets.select("shingles").coalesce(SKETCH_TASKS).mapInArrow(count, "segment int, counts binary")
            .groupBy("segment").applyInArrow(add, "segment int, levels binary").collect())  # 16 MB at most
    levels = np.zeros((segments, cells // segments), np.uint8)
    for segment, found in rows:
        levels[segment] = np.frombuffer(found, np.uint8)
    return levels.reshape(-1)


def _marks(shingles: np.ndarray, level: np.ndarray, pair: int, thin: bool, top: int) -> np.ndarray:
    """Hashes of which two linked sets of a pair of bands have one in common at least.

    Where a set of the pair of bands is ``thin``, these are its least frequent shingles alone.
    """
    if thin:
        keep = len(shingles) - least_overlap(len(shingles)) + 1
        return _mix(shingles[np.argsort(level, kind="stable")[:keep]] + np.uint64(pair))
    part, mixed = _parts(shingles, pair)
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    marks = _mix(np.add.reduceat(_mix(mixed[order]), starts) + np.uint64(pair))
    # Rare shingles, and several of them, are seldom held by chance.
    score = np.add.reduceat(top - level[order].astype(np.int64), starts)
    return marks[np.lexsort((marks, -score))[:_most_apart(len(shingles)) + 1]]


def _stars(nodes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every mark with its smallest node, and links of the others to it."""
    order = np.lexsort((nodes, marks))
    nodes, marks = nodes[order], marks[order]
    starts = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
    least = np.repeat(nodes[starts], np.diff(np.append(starts, len(marks))))
    return marks[starts], nodes[starts], np.unique(np.stack([nodes, least])[:, nodes != least], axis=1)


def _coarse_links(sets: DataFrame, levels: np.ndarray, shingles: int) -> DataFrame:
    """``a, b``: pairs of nodes of one pair of bands that share a mark, as stars around the smallest.

    A task links the classes it holds to the smallest with the same mark, and sends on that one
    alone, so that a mark of many classes costs an entry for each task; entries go packed, by slices of
    the marks.
    """
    thin = frozenset(r[0] for r in sets.select(F.explode("thin")).distinct().collect())
    shared = sets.sparkSession.sparkContext.broadcast((levels, thin, int(levels.max(initial=0)) + 1))
    bits = max(0, math.ceil(math.log2(max(1, shingles / LINK_SLICE))))
    schema = pa.schema([("slice", pa.int32()), ("marks", pa.binary()), ("nodes", pa.binary()), ("links", pa.binary())])

    def packed(nodes, marks):
        marks, least, links = _stars(np.concatenate(nodes), np.concatenate(marks))
        edges = np.searchsorted(marks >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else [
            0, len(marks)]
        rows = [(s, marks[lo:hi].tobytes(), least[lo:hi].tobytes(), None)
                for s, (lo, hi) in enumerate(zip(edges, edges[1:])) if lo < hi]
        rows[0] = (*rows[0][:3], links.tobytes())
        return batch_of(schema, *zip(*rows))

    def run(batches):
        levels, thin, top = shared.value
        nodes, marks, held = [], [], 0
        for batch in batches:
            for node, band, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                s = np.frombuffer(raw, np.uint64)
                level = levels[(s & np.uint64(len(levels) - 1)).astype(np.int64)]
                for pair in (band, band + 1):
                    marks.append(_marks(s, level, pair, pair in thin, top))
                    nodes.append(np.full(len(marks[-1]), node + pair, np.int64))
                    held += len(marks[-1])
                if held > LINK_ENTRIES:
                    yield packed(nodes, marks)
                    nodes, marks, held = [], [], 0
        if held:
            yield packed(nodes, marks)

    def link(table: pa.Table) -> pa.Table:
        joined = {n: [np.frombuffer(x, np.uint64 if n == "marks" else np.int64)
                      for x in table[n].to_pylist() if x is not None] for n in ("marks", "nodes", "links")}
        _, _, links = _stars(np.concatenate(joined["nodes"]), np.concatenate(joined["marks"]))
        links = np.concatenate([links, *(x.reshape(2, -1) for x in joined["links"])], axis=1)
        return pa.table({"a": pa.array(links[0]), "b": pa.array(links[1])})

    return (sets.select("node", "band", "shingles").mapInArrow(run, "slice int, marks binary, nodes binary, links binary")
            .groupBy("slice").applyInArrow(link, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in ``a, b``: the smallest id that links lead to.

    Each round moves every end of a link to its smallest neighbour, and on to that one's, and keeps the
    links between different places alone; so the links shrink from round to round. The smallest
    id of a component never moves. What a round builds on is checkpointed.
    """
    links = cut_lineage(links)
    edges = cut_lineage(links.unionAll(links.select("b", "a")).distinct())
    labels = edges.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    while True:
        near = cut_lineage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("near")))
        beyond = near.select(F.col("a").alias("near"), F.col("near").alias("to"))
        moved = cut_lineage(near.join(beyond, "near").select("a", "to"))
        step = moved.select(F.col("a").alias("component"), "to")
        labels = cut_lineage(labels.join(step, "component", "left").select(
            "id", F.coalesce("to", "component").alias("component")))
        edges = edges.join(moved, "a").select(F.col("to").alias("a"), "b")
        edges = edges.join(moved.select(F.col("a").alias("b"), F.col("to").alias("c")), "b").where("a <> c")
        edges = cut_lineage(edges.select("a", F.col("c").alias("b")).distinct())
        if not edges.limit(1).count():
            return labels


# -- the search within a group -----------------------------------------------------------------


class InvertedLists:
    """The shingles of a group's sets, with the sets that hold each."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.tokens = np.split(token, np.cumsum(self.size)[:-1])
        order = np.argsort(token, kind="stable")  # owners ascend within a list
        self.members = owner[order]
        self.length = np.bincount(token)
        self.start = np.cumsum(self.length) - self.length

    def _list(self, token: int) -> np.ndarray:
        return self.members[self.start[token]:self.start[token] + self.length[token]]

    def links_of(self, x: int) -> np.ndarray:
        """The other sets linked to set ``x`` (DivideSkip)."""
        tokens = self.tokens[x][np.argsort(self.length[self.tokens[x]], kind="stable")]
        needed = least_overlap(int(self.size[x]))
        longest = int(self.length[tokens[-1]])
        # Longer lists are worth probing, as long as the merged ones still prove something.
        probed = min(needed - 1, int(needed / (0.01 * math.log2(longest + 1) + 1)))
        merged = tokens[:len(tokens) - probed]
        met = np.sort(np.concatenate([self._list(t) for t in merged]), kind="stable")
        starts = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
        count = np.diff(np.append(starts, len(met)))
        found = met[starts]
        keep = (count >= needed - probed) & (found != x)
        found, count = found[keep], count[keep]
        keep = least_overlap(np.maximum(self.size[found], self.size[x])) <= np.minimum(self.size[found], self.size[x])
        found, count = found[keep], count[keep]
        for i, t in enumerate(tokens[len(tokens) - probed:]):
            if not len(found):
                break
            held = self._list(t)
            place = np.minimum(np.searchsorted(held, found), len(held) - 1)
            count = count + (held[place] == found)
            if i % 16 == 15:  # those that the lists left cannot lift over the bound
                keep = count + (probed - i - 1) >= needed
                found, count = found[keep], count[keep]
        return found[_linked(count, int(self.size[x]), self.size[found])]


def join_group(sets: list[np.ndarray], labels: list) -> np.ndarray:
    """For each set the first set of its component; equal non-null labels are linked beforehand."""
    component, first = np.arange(len(sets)), {}
    for i, label in enumerate(labels):
        if label is not None:
            component[i] = first.setdefault(label, i)
    if len(sets) == 1:
        return component
    lists, unsearched = InvertedLists(sets), np.ones(len(sets), bool)
    while True:
        largest = np.bincount(component[unsearched], minlength=len(sets)).argmax()
        # Those left in one component need not be compared; of any other pair one end has searched.
        outside = np.flatnonzero(unsearched & (component != largest))
        if not len(outside):
            return component
        x = int(outside[0])
        unsearched[x] = False
        joined = np.unique(component[np.append(lists.links_of(x), x)])
        if len(joined) > 1:
            component[np.isin(component, joined)] = joined[0]


def _settle_by_pivot(members: DataFrame, big: DataFrame) -> DataFrame:
    """Members of large groups with their ``distance`` to the group's first member, the ``pivot``."""
    pivots = members.where("node = grp").join(F.broadcast(big), "grp").select("grp", "rep", "shingles").collect()
    shared = members.sparkSession.sparkContext.broadcast(
        {g: (rep, np.frombuffer(s, np.uint64)) for g, rep, s in pivots})  # BROADCAST_BYTES at most, see caller
    schema = pa.schema([("rep", pa.int64()), ("grp", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary()),
                        ("distance", pa.float64()), ("linked", pa.bool_()), ("pivot", pa.int64())])

    def run(batches):
        for batch in batches:
            distances, linked, named = [], [], []
            for grp, raw in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                rep, p = shared.value[grp]
                s = np.frombuffer(raw, np.uint64)
                named.append(rep)
                both = int((p[np.minimum(np.searchsorted(p, s), len(p) - 1)] == s).sum())
                distances.append(1 - both / (len(s) + len(p) - both))
                linked.append(bool(_linked(both, len(s), len(p))))
            yield batch_of(schema, *batch.columns, distances, linked, named)

    return (members.select("rep", "grp", "n", "shingles").join(F.broadcast(big.select("grp")), "grp", "left_semi")
            .select("rep", "grp", "n", "shingles")
            .mapInArrow(run, "rep long, grp long, n long, shingles binary, distance double, linked boolean, pivot long"))


def _solve(table: pa.Table) -> pa.Table:
    """Links ``a, b`` within one task: whole small groups, or two blocks of a large one."""
    # By group, then rep, so that the first set of a component has its smallest rep.
    table = table.sort_by([("grp", "ascending"), ("rep", "ascending")])
    groups, reps = table["grp"].to_numpy(), table["rep"].to_numpy()
    raw, labels = table["shingles"].to_pylist(), table["label"].to_pylist()
    edges = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])).tolist() + [len(groups)]
    a, b = [], []
    for lo, hi in zip(edges, edges[1:]):
        roots = join_group([np.frombuffer(s, np.uint64) for s in raw[lo:hi]], labels[lo:hi])
        apart = np.flatnonzero(roots != np.arange(hi - lo))
        a.append(reps[lo:hi][apart])
        b.append(reps[lo:hi][roots[apart]])
    return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})


def _links_within(members: DataFrame) -> DataFrame:
    """``a, b``: links that span every component of every group."""
    sizes = cut_lineage(members.groupBy("grp").agg(F.sum("n").alias("total"), F.max("n").alias("most")))
    whole = sizes.agg(F.sum("total"), F.sum(F.when(F.col("total") > PIVOT_SHINGLES, F.col("most")))).first()
    # No more rows than all shingles by PIVOT_SHINGLES.
    big = sizes.where(F.col("total") > PIVOT_SHINGLES).select("grp")
    small = members.join(F.broadcast(big), "grp", "left_anti")
    bins = max(1, (whole[0] or 0) // TASK_SHINGLES)
    tasks = small.select("rep", "grp", "shingles", F.lit(None).cast("long").alias("label"),
                         F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(bins))).alias("task"))
    links = None
    if whole[1] is not None:
        if 8 * whole[1] <= BROADCAST_BYTES:
            near = cut_lineage(_settle_by_pivot(members, big))
            links = near.where("linked AND rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
            # d(x, y) >= |d(x, pivot) - d(y, pivot)|: who is near the pivot links to nobody far from it.
            far = near.where("NOT linked").groupBy("grp").agg(F.min("distance").alias("nearest"))
            slack = 1 - NUMERATOR / DENOMINATOR + 1e-9
            left = (near.join(F.broadcast(far), "grp").where(F.col("distance") >= F.col("nearest") - slack)
                    .select("rep", "grp", "n", "shingles", "linked"))
        else:
            left = members.join(F.broadcast(big), "grp", "left_semi").select(
                "rep", "grp", "n", "shingles", F.lit(False).alias("linked"))
        # Blocks of linked members come first; two of them need not be compared.
        parts = left.groupBy("grp").agg(*(
            F.coalesce(F.ceil(F.sum(F.when(F.col("linked") == flag, F.col("n"))) / BLOCK_SHINGLES), F.lit(0))
            .cast("int").alias(name) for flag, name in ((True, "settled"), (False, "open"))))
        own = F.when(F.col("linked"), F.pmod(F.xxhash64("rep"), "settled")).otherwise(
            F.col("settled") + F.pmod(F.xxhash64("rep"), "open")).cast("int")
        others = F.sequence(F.when(F.col("linked"), F.col("settled")).otherwise(0),
                            F.col("settled") + F.col("open") - 1)
        pairs = (left.join(F.broadcast(parts), "grp").withColumns({"block": own, "other": F.explode(others)})
                 .select("rep", "grp", "shingles", F.when(F.col("linked"), F.col("grp")).alias("label"), F.concat_ws(
                     ":", "grp", F.least("block", "other"), F.greatest("block", "other")).alias("task")))
        tasks = tasks.unionAll(pairs)
    solved = tasks.groupBy("task").applyInArrow(_solve, "a long, b long")
    return solved if links is None else solved.unionAll(links)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id that links lead to. A null text, or one without words, has no
    shingles and is its own component; so is a row that links to nothing. A row with a null id takes
    no part and has a null component. Repeated rows are rows of one component; an empty table gives
    no rows; other columns play no part. Links are exact up to collisions of 64-bit hashes.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _labelled(docs).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _labelled(docs: DataFrame) -> DataFrame:
    """``doc_id, n, key, rep, component`` of every row: its class, the class's smallest id, and the
    smallest id that links lead to; null without shingles."""
    rows = cut_lineage(signatures(docs))
    named = rows.where("doc_id IS NOT NULL AND key IS NOT NULL")
    classes = cut_lineage(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                                  F.first("key8").alias("key8")))
    total = classes.agg(F.sum("n")).first()[0] or 0
    by_rep = _components_of(docs.where("doc_id IS NOT NULL"), classes, total)
    labelled = cut_lineage(classes.join(by_rep, classes["rep"] == by_rep["id"], "left")
                           .select("key", "rep", F.coalesce("component", "rep").alias("component")))
    return rows.join(labelled, "key", "left").select("doc_id", "n", "key", "rep", "component")


def _components_of(docs: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    sets = sharing_sets(docs, classes, total)
    held = sets.agg(F.sum("n")).first()[0] or 0
    coarse = components(_coarse_links(sets, frequency_levels(sets, held), held))
    groups = coarse.select(F.col("id").alias("node"), F.col("component").alias("grp"))
    nodes = F.explode(F.array(F.col("node") + F.col("band"), F.col("node") + F.col("band") + 1))
    number = groups.count()
    members = sets.select("rep", "n", "shingles", nodes.alias("node")).join(_sized(groups, number), "node")
    # Beside a broadcast the sets stay where they are, and need not be stored a second and third time.
    return components(_links_within(members if number <= BROADCAST_IDS else cut_lineage(members)))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each component of near duplicates: the row whose id names the component.

    Rows with a null id stay. An id may be repeated: its rows with other texts are classes of their
    own, so that a copy goes and a text unlike all others stays, and of rows that repeat both the id
    and the set of shingles a single one stays, the one of the smallest text hash. (Where an id is
    repeated and one of its texts is a near, not an exact, copy, all its rows are in one component.)
    """
    found = cut_lineage(_labelled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    named = found.where("doc_id IS NOT NULL")
    twice = cut_lineage(named.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    number = twice.count()
    extra = named.where("component IS NOT NULL AND doc_id <> component").select("doc_id").distinct()
    extra = cut_lineage(extra.unionAll(twice).distinct() if number else extra)
    kept = docs.join(_sized(extra, extra.count()), "doc_id", "left_anti").select(*docs.columns)
    if not number:
        return kept
    # The few rows whose id does not name them are told apart by their sets.
    repeated = docs.join(_sized(twice, number), "doc_id", "left_semi").select(*docs.columns)
    mark = "row_set"
    while mark in docs.columns:
        mark += "_"
    keyed = _with_key(repeated, mark)
    first = (named.join(_sized(twice, number), "doc_id", "left_semi")
             .where("key IS NULL OR (doc_id = rep AND rep = component)")
             .select("doc_id", F.coalesce("key", F.lit(b"")).alias(mark)).distinct())
    chosen = (keyed.join(first, ["doc_id", mark], "left_semi").groupBy("doc_id", mark)
              .agg(F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64("text"), F.length("text"))).alias("row")))
    return kept.unionAll(chosen.select("row.*").select(*docs.columns))


def _with_key(docs: DataFrame, name: str) -> DataFrame:
    """Adds the key of the row's set; empty for an empty set."""
    schema = docs.select("*", F.lit(b"").alias(name)).schema

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in texts_of(batch)]
            keys = pa.array([_key(s) if len(s) else b"" for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)
