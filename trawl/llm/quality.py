"""Text quality by a generalised additive model with pairwise interactions.

The model is a sum of lookup tables, one per feature and one per chosen pair of features. They are
learned by cyclic boosting: in every round each feature in turn gets one shallow tree, fitted to
the current gradients and added, shrunk, to the feature's table. Scoring a batch is a binning of its
features and one addition per table.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import texts_of

FEATURES = ("log_words", "word_length", "letters", "capitals", "digits", "stops", "symbols", "breaks",
            "distinct_words", "top_word", "adjacent_repeats", "repeated_lines", "one_character_words",
            "short_words", "lone_symbols", "sentence_ends", "symbol_ends")
#: Labelled rows the tables are fitted to, at most.
SAMPLE_ROWS = 20_000

_KIND = np.full(256, 4, np.int64)  # 0 letter, 1 capital, 2 digit, 3 stop, 4 symbol, 5 blank, 6 break
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 0), (bytes(range(128, 256)), 0),
                      (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b".,;:!?'\"()-", 3),
                      (b" \t", 5), (b"\n\r\f\v", 6)):
    _KIND[list(_chars)] = _kind
_LONE = re.compile(rb"[^\w\x80-\xff]+")


def text_features(text: str | None) -> list[float]:
    """The features of one whole text; all zero for a null or blank one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    # Byte counts by slices, so that a very long text needs no array of its own size.
    kinds = np.zeros(7)
    for start in range(0, len(raw), 1 << 20):
        counts = np.bincount(np.frombuffer(raw[start:start + (1 << 20)], np.uint8), minlength=256)
        kinds += np.bincount(_KIND, weights=counts, minlength=7)
    n, filled = len(words), max(kinds[:5].sum(), 1)
    bag = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        float(np.log1p(n)), float(lengths.mean()), kinds[0] / filled, kinds[1] / filled,
        kinds[2] / filled, kinds[3] / filled, kinds[4] / filled, kinds[6] / n, len(bag) / n,
        max(bag.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), float((lengths == 1).mean()), float((lengths <= 3).mean()),
        sum(c for w, c in bag.items() if _LONE.fullmatch(w)) / n,
        sum(c for w, c in bag.items() if w[-1:] in b".!?") / n,
        sum(c for w, c in bag.items() if _KIND[w[-1]] == 4) / n,
    ]


def featurize(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``features``, an array of doubles in the order of ``FEATURES``."""
    docs = docs.drop("features")
    schema = docs.select("*", F.array().cast("array<double>").alias("features")).schema

    def run(batches):
        for batch in batches:
            found = [text_features(t) for t in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.float64()))],
                names=[*batch.schema.names, "features"])

    return docs.mapInArrow(run, schema)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: float, h: float, shrink: float) -> float:
    return 0.0 if h <= 0 else shrink * g / (h + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, shrink: float) -> np.ndarray:
    """A tree over ordered bins: the values to add to each bin."""
    out = np.full(len(g), _leaf(g.sum(), h.sum(), shrink))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
        cut = int(gain.argmax()) + 1
        if gain[cut - 1] > 1e-9:
            out[:cut] = _tree(g[:cut], h[:cut], depth - 1, shrink)
            out[cut:] = _tree(g[cut:], h[cut:], depth - 1, shrink)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, shrink: float) -> tuple[np.ndarray, float]:
    """One cut along the first feature, then one along the second on either side; and its gain."""
    best, best_gain = np.full(g.shape, _leaf(g.sum(), h.sum(), shrink)), 0.0
    whole = _gain(g.sum(), h.sum())
    for cut in range(1, len(g)):
        out, gain = np.empty(g.shape), -whole
        for part in (slice(0, cut), slice(cut, None)):
            gs, hs = g[part].sum(0), h[part].sum(0)
            out[part] = _tree(gs, hs, 1, shrink)
            gl, hl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
            split = _gain(gl, hl) + _gain(gs.sum() - gl, hs.sum() - hl)
            gain += max(float(split.max(initial=0.0)), _gain(gs.sum(), hs.sum()))
        if gain > best_gain:
            best, best_gain = out, gain
    return best, best_gain


class AdditiveModel:
    """An intercept, a table per feature and a table per pair of features; a few thousand numbers."""

    def __init__(self, n_features: int):
        self.intercept = 0.0
        self.edges = [np.zeros(0)] * n_features
        self.tables = [np.zeros(1)] * n_features
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.coarse = [np.zeros(0)] * n_features

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, shrink: float = 0.15, bins: int = 32,
            pairs: int = 6, pair_bins: int = 8) -> AdditiveModel:
        """Boosts the features in turn, then the pairs whose first tree gains most."""
        model = AdditiveModel(x.shape[1])
        rate = (y.sum() + 1.0) / (len(y) + 2.0)
        model.intercept = float(np.log(rate / (1 - rate)))
        if not len(y):
            return model
        n = x.shape[1]
        model.edges = [_edges(x[:, f], bins) for f in range(n)]
        model.coarse = [_edges(x[:, f], pair_bins) for f in range(n)]
        binned = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
        coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.coarse)]
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        score = np.full(len(y), model.intercept)

        def slopes(cells, size):
            p = 1 / (1 + np.exp(-score))
            return np.bincount(cells, y - p, size), np.bincount(cells, p * (1 - p), size)

        for _ in range(rounds):
            for f in range(n):
                step = _tree(*slopes(binned[f], len(model.tables[f])), 2, shrink)
                model.tables[f] += step
                score += step[binned[f]]
        ranked = []
        for a in range(n):
            for b in range(a + 1, n):
                shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
                g, h = slopes(coarse[a] * shape[1] + coarse[b], shape[0] * shape[1])
                ranked.append((-_pair_tree(g.reshape(shape), h.reshape(shape), shrink)[1], a, b, shape))
        chosen = [(a, b, np.zeros(shape)) for gain, a, b, shape in sorted(ranked)[:pairs] if gain < 0]
        for _ in range(rounds // 2):
            for a, b, grid in chosen:
                g, h = slopes(coarse[a] * grid.shape[1] + coarse[b], grid.size)
                step, _gained = _pair_tree(g.reshape(grid.shape), h.reshape(grid.shape), shrink)
                grid += step
                score += step[coarse[a], coarse[b]]
        model.pairs = chosen
        return model

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, by one addition per table."""
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        cells = {f: np.searchsorted(self.coarse[f], x[:, f], "right")
                 for f in {i for a, b, _ in self.pairs for i in (a, b)}}
        for a, b, grid in self.pairs:
            total += grid[cells[a], cells[b]]
        return 1 / (1 + np.exp(-total))


def fit_quality(docs: DataFrame, sample: DataFrame) -> AdditiveModel:
    """Fits the tables to the labelled rows of ``sample`` (``doc_id, label``, ``SAMPLE_ROWS`` at most).

    The sample's ids are broadcast, its texts are turned into features where they are, and only
    those few numbers per row reach the driver. Without labelled rows every score is 0.5.
    """
    bounded = sample.limit(SAMPLE_ROWS)
    rows = featurize(docs.select("doc_id", "text").join(F.broadcast(bounded), "doc_id")) \
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features")) \
        .select("label", "features").toArrow()
    x = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = np.array(rows["label"].to_pylist(), float)
    # Rows reach the driver in any order; sums must not depend on it.
    order = np.lexsort([*x.T, y])
    return AdditiveModel.fit(x[order], y[order])


def score_quality(docs: DataFrame, model: AdditiveModel, text: str = "text", score: str = "score",
                  predicted: str = "predicted") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more) to every row.

    Null and blank texts have all features zero and are scored as such. Repeated rows score alike;
    an empty table stays empty; input columns of the added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(score, predicted)
    schema = docs.select("*", F.lit(0.0).alias(score), F.lit(0).alias(predicted)).schema

    def run(batches):
        for batch in batches:
            x = np.array([text_features(t) for t in texts_of(batch, text)]).reshape(-1, len(FEATURES))
            p = shared.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=[*batch.schema.names, score, predicted])

    return docs.mapInArrow(run, schema)
