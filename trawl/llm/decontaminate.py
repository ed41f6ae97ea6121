"""Documents that hold benchmark passages, verbatim or reworded, by latent semantic retrieval.

Benchmark passages become TF-IDF rows over hashed words, with document frequencies from the whole
corpus. Blocks of them are factored by randomised SVD, each block in a task of its own; a block has
no more passages than dimensions, so that its latent space keeps their inner products. The corpus is
then read once per wave of blocks: overlapping windows of words are folded into the latent space, and
windows close to a passage by cosine are candidates. A candidate counts if the longest common
subsequence of content words covers 0.8 of the passage, or 0.6 with half of the passage's answer, its
last quarter. Beside this, ``RUN`` words of an item in a row count wherever they stand, by an index of
all such runs and without any weights.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of

BITS = 16
#: Words of a passage at most, passages and dimensions of a block, blocks sent out at a time.
PASSAGE_WORDS, BLOCK_PASSAGES, WAVE_BLOCKS = 64, 256, 4
#: So many words of an item in a row are a leak; of a shorter item all words, from SHORT_RUN words on.
RUN, SHORT_RUN = 13, 5
#: A window is two segments of this many words.
SEGMENT = 16
#: Characters of a text that are split into words at once.
SLICE = 1 << 21
#: Words in more than this share of the documents count for nothing in cosines and subsequences, unless
#: copies of a passage may have made them so (``word_weights``). No weight is below that of the share.
COMMON = 0.1
LEAST_WEIGHT = -float(np.log(COMMON))

_DROP = b".,;:!?\"'()[]{}"


def _split(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _DROP).split()


def text_slices(text: str | None, carry: int = 0) -> Iterator[tuple[int, list[bytes]]]:
    """(words before, words) of a text in slices, each repeating the last ``carry`` words."""
    at, before, tail = 0, 0, []
    while at < len(text or ""):
        end = min(len(text), at + SLICE)
        while end < len(text) and not text[end].isspace():
            end += 1
        words = tail + _split(text[at:end])
        yield before, words
        tail = words[len(words) - carry:] if carry and end < len(text) else []
        before += len(words) - len(tail)
        at = end


def _crc(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def _hashed(words: list[bytes]) -> np.ndarray:
    return _crc(words) >> np.uint32(32 - BITS)


def _runs_of(crc: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` consecutive words; the last ``length`` - 1 words begin none."""
    count = max(0, len(crc) - length + 1)
    out = np.zeros(count, np.uint64)
    for i in range(length):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += crc[i:i + count]
    return out ^ out >> np.uint64(29)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Documents, and how many of them hold each word bucket; counts cover all rows."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches):
        counts = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for value in texts_of(batch):
                found = [np.unique(_hashed(words)) for _, words in text_slices(value)]
                if found:
                    counts[found[0] if len(found) == 1 else np.unique(np.concatenate(found))] += 1
                counts[-1] += 1
        there = np.flatnonzero(counts)
        yield batch_of(schema, there.astype(np.int32), counts[there])

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())  # 2^16 + 1 rows at most
    counts = np.zeros((1 << BITS) + 1, np.int64)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return int(counts[-1]), counts[:-1]


def word_weights(items: DataFrame, number: int, counts: np.ndarray, text: str = "text") -> np.ndarray:
    """Inverse document frequencies by bucket; common words have none.

    A passage that many documents hold lifts the counts of all its words. About as many documents as
    hold its words of the lower quartile may hold all of it, and these make no word of it common. So at
    least a quarter of a passage's words has a weight, however often the passage is copied.
    """
    # In a few documents every word would be common, so a handful of them never is.
    limit = max(COMMON * number, 20)

    def lifted(batches):
        kept = np.zeros(1 << BITS, bool)
        for batch in batches:
            for value in texts_of(batch):
                words = [w for _, part in text_slices(value) for w in part]
                for start in range(0, len(words), PASSAGE_WORDS):
                    h = _hashed(words[start:start + PASSAGE_WORDS])
                    kept[h[counts[h] <= limit + np.quantile(counts[h], 0.25, method="higher")]] = True
        yield batch_of(pa.schema([("bucket", pa.int32())]), np.flatnonzero(kept).astype(np.int32))

    kept = items.select(F.col(text).alias("text")).mapInArrow(lifted, "bucket int").distinct().toArrow()
    idf = np.where(counts <= limit, np.log((1 + number) / (1 + counts)), 0.0)
    idf[kept["bucket"].to_numpy()] = np.maximum(idf[kept["bucket"].to_numpy()], LEAST_WEIGHT)
    return idf


def randomised_svd(a: np.ndarray, rank: int, rounds: int = 3, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors of ``a`` as columns, by subspace iteration."""
    wide = min(a.shape[0], a.shape[1], rank + 8)
    basis = np.linalg.qr(a.T @ np.random.default_rng(seed).standard_normal((a.shape[0], wide)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(a.T @ (a @ basis))[0]
    _, _, vt = np.linalg.svd(a @ basis, full_matrices=False)
    return (basis @ vt.T)[:, :rank]


def passages(items: DataFrame, text: str = "text") -> DataFrame:
    """``item_id, passage, words, after, item_words``: items cut into passages; null and blank ones have none.

    ``after`` is what follows in the item, as far as runs that begin in the passage go.
    """
    schema = pa.schema([("item_id", pa.int64()), ("passage", pa.int32()), ("words", pa.list_(pa.binary())),
                        ("after", pa.list_(pa.binary())), ("item_words", pa.int64())])

    def cut(batches):
        for batch in batches:
            rows = []
            for item, value in zip(texts_of(batch, "item_id"), texts_of(batch)):
                words = [w for _, part in text_slices(value) for w in part]
                for n, start in enumerate(range(0, len(words), PASSAGE_WORDS)):
                    end = start + PASSAGE_WORDS
                    rows.append((item, n, words[start:end], words[end:end + RUN - 1], len(words)))
            yield batch_of(schema, *(zip(*rows) if rows else [[]] * 5))

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col(text).alias("text")).mapInArrow(
        cut, "item_id long, passage int, words array<binary>, after array<binary>, item_words long")


def latent_blocks(cut: DataFrame, idf: np.ndarray) -> DataFrame:
    """Per block the word buckets' latent vectors, and per passage its unit latent vector."""

    def factor(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["item_id", "passage"], na_position="first")
        hashed = [_hashed(list(w)) for w in rows["words"]]
        buckets = np.unique(np.concatenate(hashed))
        a = np.zeros((len(rows), len(buckets)))
        for i, h in enumerate(hashed):
            np.add.at(a[i], np.searchsorted(buckets, h), idf[h])
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        basis = randomised_svd(a, BLOCK_PASSAGES)
        latent = a @ basis
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({
            "block": rows["block"].iloc[0], "bucket": [None] * len(rows) + buckets.tolist(),
            "item_id": rows["item_id"].tolist() + [None] * len(buckets),
            "passage": rows["passage"].tolist() + [None] * len(buckets),
            "words": rows["words"].tolist() + [None] * len(buckets),
            "after": rows["after"].tolist() + [None] * len(buckets),
            "item_words": rows["item_words"].tolist() + [None] * len(buckets),
            "vector": [*latent.astype(np.float32).tolist(), *basis.astype(np.float32).tolist()]}).astype(
                {"bucket": "Int32", "item_id": "Int64", "passage": "Int32", "item_words": "Int64"})

    return cut.groupBy("block").applyInPandas(
        factor, "block int, bucket int, item_id long, passage int, words array<binary>, after array<binary>, "
                "item_words long, vector array<float>")


def common_subsequence(pattern: list, text: list) -> int:
    """Length of the longest common subsequence, a machine word's worth of rows at a time."""
    masks: dict = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, row = (1 << len(pattern)) - 1, (1 << len(pattern)) - 1
    for w in text:
        hit = row & masks.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


class _Space:
    """One block: its bucket vectors, its passages, and what is needed to confirm them."""

    def __init__(self, rows: pa.Table, idf: np.ndarray):
        names = {n: rows[n].to_pylist() for n in ("bucket", "item_id", "passage", "words", "item_words")}
        vectors = np.stack(rows["vector"].to_numpy(zero_copy_only=False)).astype(np.float32)
        bucket = np.array([-1 if b is None else b for b in names["bucket"]])
        of_words = bucket >= 0
        self.place = np.zeros(1 << BITS, np.int32)
        self.place[bucket[of_words]] = np.arange(1, of_words.sum() + 1)
        self.basis = np.concatenate([np.zeros((1, vectors.shape[1]), np.float32), vectors[of_words]])
        self.latent = np.ascontiguousarray(vectors[~of_words].T)
        self.passages, norms = [], []
        for i in np.flatnonzero(~of_words):
            words = names["words"][i]
            hashed = _hashed(words)
            content = [w for w, h in zip(words, hashed) if idf[h] > 0]
            # Beside words that copies have made cheap, any other outweighs: no cosine, but the share held.
            cheap = np.mean(idf[hashed[idf[hashed] > 0]] <= LEAST_WEIGHT) >= 0.5
            norms.append(np.linalg.norm(np.bincount(hashed, idf[hashed])) if cheap else np.inf)
            answer = content[-max(2, len(content) // 4):]
            self.passages.append((names["item_id"][i], names["passage"][i], content, answer, len(words),
                                  names["item_words"][i]))
        self.norms = np.array(norms, np.float32)


class _Runs:
    """The runs of words of all passages of a wave, by hash; what is found is compared word by word."""

    def __init__(self, rows: pa.Table, idf: np.ndarray):
        rows = rows.filter(rows["bucket"].is_null())
        self.idf, self.texts, self.sizes, self.names, found = idf, [], [], [], {}
        for item, part, words, after, size in zip(*(rows[n].to_pylist() for n in (
                "item_id", "passage", "words", "after", "item_words"))):
            length = min(RUN, size)
            if length < SHORT_RUN:
                continue
            runs = _runs_of(_crc(words + after), length)[:len(words)]
            found.setdefault(length, []).append(
                (runs, np.full(len(runs), len(self.texts)), np.arange(len(runs))))
            self.texts.append(words + after)
            self.sizes.append(len(words))
            self.names.append((item, part, len(words), size))
        self.tables = []
        for length, parts in found.items():
            runs, passage, place = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(runs, kind="stable")
            known = np.zeros(1 << 20, bool)
            known[runs & np.uint64((1 << 20) - 1)] = True
            self.tables.append((length, known, runs[order], passage[order], place[order]))

    def find(self, runs, crc: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple]:
        """What ``LeakFinder.find`` yields, for the longest run of each text slice and passage."""
        best: dict = {}
        for length, known, table, passage, place in self.tables:
            hashes = _runs_of(crc, length)
            at = np.flatnonzero(known[hashes & np.uint64((1 << 20) - 1)])
            low = np.searchsorted(table, hashes[at])
            hit = low < len(table)
            at, low = at[hit], low[hit]
            there = table[low] == hashes[at]
            at, low = at[there], low[there]
            owner = np.searchsorted(starts, at, side="right") - 1
            inside = at - starts[owner] + length <= lengths[owner]
            at, low, owner = at[inside], low[inside], owner[inside]
            high = np.searchsorted(table, hashes[at], side="right")
            open_runs: dict = {}
            for position, lo, hi, run in zip(at.tolist(), low.tolist(), high.tolist(), owner.tolist()):
                begin = position - int(starts[run])
                words = runs[run][2][begin:begin + length]
                for p, q in zip(passage[lo:hi].tolist(), place[lo:hi].tolist()):
                    if self.texts[p][q:q + length] != words:
                        continue
                    # A hit continues the one a word before it, in the text and in the passage.
                    key = run, p, q - begin
                    seen = open_runs.get(key)
                    first = seen[0] if seen and seen[1] == begin - 1 else begin
                    open_runs[key] = first, begin
                    top = best.get((run, p))
                    if top is None or begin + length - first > top[1] - top[0]:
                        best[run, p] = first, begin + length, q - (begin - first)
        for (run, p), (first, last, place) in best.items():
            row, before, words = runs[run]
            item, part, size, item_words = self.names[p]
            text, run_words = self.texts[p], last - first
            whole, held = _hashed(text[:size]), _hashed(text[place:place + run_words])
            a, b = (np.bincount(h, self.idf[h], 1 << BITS) for h in (whole, held))
            answer = max(2, size // 4)
            cosine = a @ b / max(1e-12, np.linalg.norm(a) * np.linalg.norm(b))
            yield (row, item, part, size, item_words, float(cosine), min(1.0, run_words / size),
                   min(1.0, max(0, min(place + run_words, size) - max(place, size - answer)) / answer),
                   int(before + first), int(before + last), True)


class LeakFinder:
    """The blocks of a wave; compares a batch of texts with all their passages."""

    def __init__(self, rows: pa.Table, idf: np.ndarray, similarity: float, overlap: float):
        self.idf, self.similarity, self.overlap = idf.astype(np.float32), similarity, overlap
        block = rows["block"].to_numpy()
        self.runs = _Runs(rows, idf)
        self.spaces = [_Space(rows.filter(pa.array(block == b)), idf) for b in np.unique(block)]

    def find(self, texts: list) -> Iterator[tuple]:
        """(row, item, passage, its words, item's words, cosine, overlap, answer, first, last word, verbatim)."""
        runs, held = [], 0
        for row, text in enumerate(texts):
            for before, words in text_slices(text, carry=4 * PASSAGE_WORDS):
                if words:
                    runs.append((row, before, words))
                    held += len(words)
                if held > 100_000:
                    yield from self._compare(runs)
                    runs, held = [], 0
        if runs:
            yield from self._compare(runs)

    def _compare(self, runs) -> Iterator[tuple]:
        lengths = np.array([len(w) for _, _, w in runs])
        starts = np.cumsum(lengths) - lengths
        crc = np.concatenate([_crc(w) for _, _, w in runs])
        yield from self.runs.find(runs, crc, starts, lengths)
        hashed = crc >> np.uint32(32 - BITS)
        weight = self.idf[hashed]
        segments = -(-lengths // SEGMENT)
        first = np.cumsum(segments) - segments
        segment = np.repeat(first, lengths) + (np.arange(len(hashed)) - np.repeat(starts, lengths)) // SEGMENT
        total = int(segments.sum())
        square = np.bincount(segment, weight * weight, total)
        ends = np.zeros(total, bool)
        ends[first + segments - 1] = True  # the last segment of a run has no next one
        norm = np.sqrt(square + np.where(ends, 0, np.append(square[1:], 0)))
        owner = np.repeat(np.arange(len(runs)), segments)
        for space in self.spaces:
            place = space.place[hashed]
            hits = np.flatnonzero((place > 0) & (weight > 0))
            if not len(hits):
                continue
            at, begin = np.unique(segment[hits], return_index=True)
            sums = np.zeros((total, space.basis.shape[1]), np.float32)
            sums[at] = np.add.reduceat(space.basis[place[hits]] * weight[hits, None], begin, axis=0)
            sums[:-1] += np.where(ends[:-1, None], 0, sums[1:])
            busy = np.flatnonzero((norm > 0) & sums.any(axis=1))
            inner = sums[busy] @ space.latent
            close = inner / norm[busy, None]
            window, passage = np.nonzero((close >= self.similarity) | (inner >= self.overlap / 2 * space.norms))
            if not len(window):
                continue
            cosine, window = close[window, passage], busy[window]
            # Windows of one run and passage that are near each other are looked at together.
            order = np.lexsort((window, passage))
            window, passage, cosine = window[order], passage[order], cosine[order]
            new = np.flatnonzero((np.diff(window, prepend=-9) > 4) | (np.diff(passage, prepend=-1) != 0)
                                 | (np.diff(owner[window], prepend=-1) != 0))
            for lo, hi in zip(new, np.append(new[1:], len(window))):
                run = owner[window[lo]]
                row, before, words = runs[run]
                item, part, content, answer, size, item_words = space.passages[passage[lo]]
                left = max(0, (window[lo] - first[run]) * SEGMENT - PASSAGE_WORDS)
                right = min(len(words), (window[hi - 1] - first[run] + 2) * SEGMENT + PASSAGE_WORDS)
                near = slice(starts[run] + left, starts[run] + right)
                kept = [words[left + i] for i in np.flatnonzero(weight[near] > 0)]
                covered = common_subsequence(content, kept) / len(content)
                answered = common_subsequence(answer, kept) / len(answer)
                if covered >= 0.8 or covered >= self.overlap and answered >= 0.5:
                    yield (row, item, part, size, item_words, float(cosine[lo:hi].max()), covered, answered,
                           int(before + left), int(before + right), False)


def find_leaks(docs: DataFrame, items: DataFrame, similarity: float = 0.3, overlap: float = 0.6,
               id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, overlap, answer, first_word, last_word``: documents with items.

    One row for each document and item, of its best place. An item counts if ``RUN`` words of it stand
    in a row (all of it if it has fewer, from ``SHORT_RUN`` on), or if confirmed passages hold at least
    half of its words. A passage of up to 64 words is confirmed by 0.8 of its content words in order, or
    by ``overlap`` of them and half of its answer, the last quarter; windows are looked at from the cosine
    ``similarity`` on. For runs, the columns tell the cosine with the passage and the shares of the
    passage's and of its answer's words. Null and blank texts hold nothing; rows with a null id, or an
    id given twice, are reported under that id; empty tables give no rows. However many documents
    hold an item, its words keep a weight. Other columns play no part.
    """
    spark = docs.sparkSession
    number, counts = document_frequencies(docs, text)
    idf = word_weights(items, number, counts)
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("passage", pa.int32()),
                     ("size", pa.int64()), ("item_words", pa.int64()), ("similarity", pa.float64()),
                     ("overlap", pa.float64()), ("answer", pa.float64()), ("first_word", pa.int64()),
                     ("last_word", pa.int64()), ("verbatim", pa.bool_())])
    ddl = ("doc_id long, item_id long, passage int, size long, item_words long, similarity double, "
           "overlap double, answer double, first_word long, last_word long, verbatim boolean")
    cut = passages(items)
    blocks = max(1, -(-cut.count() // (BLOCK_PASSAGES * 3 // 4)))
    # By hash, a block gets three quarters of the passages that it has dimensions for.
    cut = cut.withColumn("block", F.pmod(F.xxhash64("item_id", "passage"), F.lit(blocks)).cast("int"))

    def scanner(shared):
        def run(batches):
            for batch in batches:
                ids = texts_of(batch, "doc_id")
                found = [(ids[r], *rest) for r, *rest in shared.value.find(texts_of(batch))]
                yield batch_of(out, *(zip(*found) if found else [[]] * len(out)))

        return run

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hits = spark.createDataFrame([], ddl)
    for start in range(0, blocks, WAVE_BLOCKS):
        wave = latent_blocks(cut.where((F.col("block") >= start) & (F.col("block") < start + WAVE_BLOCKS)),
                             idf).toArrow()  # WAVE_BLOCKS x 256 passages of 64 words at most
        if wave.num_rows:
            finder = spark.sparkContext.broadcast(LeakFinder(wave, idf, similarity, overlap))
            hits = hits.unionAll(rows.mapInArrow(scanner(finder), ddl))
    best = F.struct("similarity", "overlap", "answer", "first_word", "last_word")
    by_passage = hits.groupBy("doc_id", "item_id", "passage", "size", "item_words").agg(
        F.max(F.struct("overlap", best.alias("best"))).alias("top"), F.max("verbatim").alias("verbatim"))
    return (by_passage.groupBy("doc_id", "item_id", "item_words").agg(
                F.sum("size").alias("found"), F.max("top").alias("top"), F.max("verbatim").alias("verbatim"))
            .where("verbatim OR 2 * found >= item_words")
            .select("doc_id", "item_id", "top.best.similarity", "top.best.overlap", "top.best.answer",
                    "top.best.first_word", "top.best.last_word"))


def remove_leaking(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows with a null id stay, as nothing names them.

    A row is named by its id and its text, so of an id given twice only the rows that hold an item go.
    """
    text, id_column = options.pop("text", "text"), options.pop("id_column", "doc_id")
    row = "row_key"
    while row in docs.columns:
        row += "_"
    keyed = docs.withColumn(row, F.when(F.col(id_column).isNotNull(), F.xxhash64(id_column, text)))
    leaking = find_leaks(keyed, items, id_column=row, text=text, **options).select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(leaking, row, "left_anti").select(*docs.columns)
