"""Toxicity by a weighted finite-state grammar over clauses.

A clause is read as a string of word classes: insult, threat, target, negation, reporting verb and
others. Small transducers rewrite it: one marks what stands in reported speech, one what is negated,
one which insults and threats have a target. Their composition is one machine that turns a clause
into weighted events. A text is scored by the events of its matched clauses, not by single words.

The insult lexicon and the weights are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, texts_of

#: Labelled rows that lexicon and weights are learned from, at most.
SAMPLE_ROWS = 10_000
#: Toxic texts of the sample that a learned word or word beginning must occur in.
LEAST_TEXTS = 5
#: Share of the sampled texts holding it that are toxic, for an insult and for a weak sign of one.
PRECISION, WEAK_PRECISION = 0.7, 0.35

# Common words of each class in English, French, German and Spanish.
INSULTS = ("idiot idiots moron morons stupid dumb imbecile loser losers scum trash worthless pathetic "
           "disgusting clown filth vermin bastard bitch asshole scumbag degenerate connard salaud "
           "abruti arschloch vollidiot dummkopf cabrón imbécil estúpido").split()
THREATS = "kill hurt destroy murder shoot beat strangle tuer frapper töten schlagen umbringen matar golpear".split()
TARGETS = ("you your yours yourself they them he him she her these those everyone tu toi ton vous votre "
           "du dich dir dein ihr euch tú ti usted ustedes vosotros").split()
NEGATIONS = "not never no isn aren wasn don doesn won cannot pas jamais nicht nie kein keine nunca jamás".split()
REPORTS = ("said says say wrote writes called calls claimed claims quoted quote reported alleged "
           "dit disait écrit sagte sagt schrieb dijo dice escribió").split()

INSULT, WEAK, THREAT, TARGET, NEGATION, REPORT, OTHER = "IWTPNRo"
#: What the composed machine puts out for a clause: events, each with a weight.
EVENTS = ("insult", "aimed_insult", "threat", "quoted", "negated", "weak")
#: The weights before any label is seen.
PRIOR = (2.5, 3.5, 3.5, 0.5, 0.5, 1.0)
#: One over the variance that weights may have around them.
PRIOR_WEIGHT = 0.1


class Transducer:
    """Arcs ``(state, symbol) -> (state, symbols out)``; a symbol without an arc passes unchanged."""

    def __init__(self, arcs: dict, start=0, fallback: dict | None = None):
        self.arcs, self.start, self.fallback = arcs, start, fallback or {}

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol)) or (self.fallback.get(state, state), symbol)

    def compose(self, after: Transducer, symbols: str) -> Transducer:
        """The machine that does this one and then ``after``, over these input symbols."""
        start, arcs = (self.start, after.start), {}
        todo, seen = [start], {start}
        while todo:
            a, b = state = todo.pop()
            for symbol in symbols:
                new_a, middle = self.step(a, symbol)
                new_b, out = b, ""
                for m in middle:
                    new_b, o = after.step(new_b, m)
                    out += o
                arcs[state, symbol] = ((new_a, new_b), out)
                if (new_a, new_b) not in seen:
                    seen.add((new_a, new_b))
                    todo.append((new_a, new_b))
        return Transducer(arcs, start)

    def run(self, symbols: str) -> str:
        state, out = self.start, []
        for symbol in symbols:
            state, o = self.step(state, symbol)
            out.append(o)
        return "".join(out)


@functools.cache
def grammar() -> Transducer:
    """Reported speech, then negation, then target; out come the initials of events and rest."""
    # After a reporting verb insults and threats of the clause are quoted (q).
    reported = Transducer({(0, REPORT): (1, REPORT), (1, INSULT): (1, "q"), (1, THREAT): (1, "q")})
    # A negation reaches two words on (n).
    negated = Transducer(
        {(s, NEGATION): (2, NEGATION) for s in (0, 1, 2)}
        | {(s, x): (s - 1, "n") for s in (1, 2) for x in (INSULT, THREAT)},
        fallback={0: 0, 1: 0, 2: 1})
    # A target before or after an insult in its clause aims it (a); a threat needs one (t).
    aimed = Transducer({
        ("", TARGET): ("P", ""), ("", INSULT): ("I", "i"), ("", THREAT): ("T", ""),
        ("P", INSULT): ("P", "a"), ("P", THREAT): ("P", "t"),
        ("I", TARGET): ("P", "a"), ("I", INSULT): ("I", "i"), ("I", THREAT): ("T", ""),
        ("T", TARGET): ("P", "t"), ("T", INSULT): ("T", "i"), ("T", THREAT): ("T", ""),
        **{(s, WEAK): (s, "w") for s in ("", "P", "I", "T")}}, start="")
    symbols = INSULT + WEAK + THREAT + TARGET + NEGATION + REPORT + OTHER
    return reported.compose(negated, symbols).compose(aimed, symbols)


_EVENT_OF = {"i": 0, "a": 1, "t": 2, "q": 3, "n": 4, "w": 5}
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]")


def word_keys(word: str) -> list[str]:
    """What a lexicon may list of a word: the whole (``w$``), or a beginning that goes on (``w+``)."""
    return [word + "$"] + [word[:n] + "+" for n in range(4, min(len(word), 13))]


class Lexicon:
    """Insult keys and threats; finds the places of a text that a clause must be read around."""

    def __init__(self, insults, weak=()):
        self.insults, self.weak = frozenset(insults), frozenset(weak)
        self.classes = {w: c for words, c in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET),
                                              (THREATS, THREAT)) for w in words}
        self._finder = None

    def __getstate__(self):
        return {**self.__dict__, "_finder": None}

    def class_of(self, word: str) -> str:
        keys = word_keys(word)
        if not self.insults.isdisjoint(keys):
            return INSULT
        if not self.weak.isdisjoint(keys):
            return WEAK
        return self.classes.get(word, OTHER)

    def _triggers(self, text: str):
        """Where a lexicon string ends in the text, in order; its word may yet be another."""
        if self._finder is None:
            import ahocorasick

            self._finder = ahocorasick.Automaton()
            for key in (*self.insults, *self.weak, *(t + "$" for t in THREATS)):
                self._finder.add_word(key[:-1], key[-1])
            self._finder.make_automaton()
        return self._finder.iter(text)

    def clauses(self, text: str | None):
        """(clause, event counts) of every clause with an event."""
        text = (text or "").lower()
        done = -1
        if not text:
            return
        for end, _ in self._triggers(text):
            if end < done:
                continue
            start = max(text.rfind(c, max(done, 0), end) for c in ".!?;:\n") + 1
            stop = _CLAUSE_END.search(text, end + 1)
            done = stop.start() if stop else len(text)
            clause = text[start:done]
            symbols = "".join(map(self.class_of, _WORD.findall(clause)))
            if not {INSULT, WEAK, THREAT}.isdisjoint(symbols):
                counts = [0] * len(EVENTS)
                for o in grammar().run(symbols):
                    if o in _EVENT_OF:
                        counts[_EVENT_OF[o]] += 1
                if any(counts):
                    yield clause.strip(), counts


def _sample_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``label, text`` of the sample, one row for each group of near copies.

    Copies of one toxic text would make its every word look toxic. Texts that share the smallest hash
    of their five-word runs count once.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("text", pa.string()), ("sign", pa.int64())])

    def signed(batches):
        for batch in batches:
            signs = []
            for text in texts_of(batch):
                words = text.lower().encode("utf-8", "surrogatepass").split()
                signs.append(min((zlib.crc32(b" ".join(words[i:i + 5])) for i in range(max(1, len(words) - 4))),
                                 default=0))
            yield batch_of(schema, *(batch.column(i) for i in range(3)), signs)

    rows = (docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(F.broadcast(sample.limit(SAMPLE_ROWS)), "doc_id").select("doc_id", "label", "text"))
    return (rows.mapInArrow(signed, "doc_id long, label int, text string, sign long")
            .groupBy("sign", "label").agg(F.min_by("text", "doc_id").alias("text")).select("label", "text"))


def learn_lexicon(texts: DataFrame) -> Lexicon:
    """Seed insults, and the words and beginnings that toxic texts hold significantly more often.

    Significance is the log-likelihood ratio of text counts, held against the number of keys tried.
    """
    key_schema = pa.schema([("key", pa.string()), ("n", pa.int64())])

    def counter(wanted):
        def run(batches):
            counts = Counter()
            texts = 0
            for batch in batches:
                for text in texts_of(batch):
                    keys = {k for w in set(_WORD.findall(text.lower())) for k in word_keys(w)}
                    counts.update(keys if wanted is None else keys & wanted.value)
                    texts += 1
            yield batch_of(key_schema, [*counts, ""], [*counts.values(), texts])

        return run

    toxic = (texts.where("label = 1").select("text").mapInArrow(counter(None), "key string, n long")
             .groupBy("key").agg(F.sum("n").alias("n")).cache())
    tried = max(toxic.count(), 2)
    often = {r["key"]: r["n"] for r in toxic.where(f"n >= {LEAST_TEXTS} OR key = ''").collect()}
    toxic.unpersist()
    wanted = texts.sparkSession.sparkContext.broadcast(frozenset(often))
    clean = {r["key"]: r["n"] for r in texts.where("label = 0").select("text")
             .mapInArrow(counter(wanted), "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    bad, good = often.pop("", 0), clean.pop("", 0)

    def likelihood(k, n, p):
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    insults, weak = {w + "$" for w in INSULTS}, set()
    for key, n in often.items():
        m = clean.get(key, 0)
        if good and n >= WEAK_PRECISION * (n + m):
            both = (n + m) / (bad + good)
            ratio = 2 * (likelihood(n, bad, n / bad) + likelihood(m, good, m / good)
                         - likelihood(n, bad, both) - likelihood(m, good, both))
            if ratio > 2 * math.log(tried) + 6:
                (insults if n >= PRECISION * (n + m) else weak).add(key)
    return Lexicon(insults, weak)


def _evidence(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


class ToxicityModel:
    """The lexicon, an intercept and a weight for each event."""

    def __init__(self, lexicon: Lexicon, intercept: float, weights: np.ndarray):
        self.lexicon, self.intercept, self.weights = lexicon, intercept, weights

    @staticmethod
    def fit(docs: DataFrame, sample: DataFrame) -> ToxicityModel:
        """Learns from the labelled rows of ``sample`` (``doc_id, label``, ``SAMPLE_ROWS`` at most).

        Without labelled rows the seed lexicon and the prior weights remain.
        """
        texts = _sample_texts(docs, sample).cache()
        lexicon = learn_lexicon(texts)
        schema = pa.schema([("label", pa.int32()), ("events", pa.list_(pa.int64()))])

        def events(batches):
            for batch in batches:
                found = [np.sum([c for _, c in lexicon.clauses(t)] or [[0] * len(EVENTS)], axis=0).tolist()
                         for t in texts_of(batch)]
                yield batch_of(schema, batch.column(0), found)

        rows = (texts.mapInArrow(events, "label int, events array<bigint>")
                .groupBy("label", "events").count().orderBy("label", "events").toArrow())
        texts.unpersist()
        x = _evidence(np.array(rows["events"].to_pylist(), float).reshape(-1, len(EVENTS)))
        y, n = np.array(rows["label"].to_pylist(), float), np.array(rows["count"].to_pylist(), float)
        # Newton steps for the logistic likelihood with a Gaussian prior around PRIOR.
        center = np.array([-3.0, *PRIOR])
        w, z = center.copy(), np.column_stack([np.ones(len(x)), x])
        for _ in range(30):
            p = 1 / (1 + np.exp(-z @ w)) if len(z) else np.zeros(0)
            slope = z.T @ (n * (y - p)) - PRIOR_WEIGHT * (w - center)
            curve = (z.T * (n * p * (1 - p))) @ z + PRIOR_WEIGHT * np.eye(len(w))
            w = w + np.clip(np.linalg.solve(curve, slope), -2, 2)
        return ToxicityModel(lexicon, float(w[0]), w[1:])

    def score(self, text: str | None) -> tuple[float, int, str | None]:
        """Probability, number of matched clauses, and the one of most weight (the first on a tie)."""
        total, matched, best, strongest = np.zeros(len(EVENTS)), 0, -math.inf, None
        for clause, counts in self.lexicon.clauses(text):
            total += counts
            matched += 1
            weight = float(self.weights @ _evidence(np.array(counts, float)))
            if weight > best:
                best, strongest = weight, clause
        logit = self.intercept + float(self.weights @ _evidence(total))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit)))), matched, strongest


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (1 from the threshold on), ``clauses`` (matched) and
    ``strongest`` (the lower-cased clause of most weight) to every row.

    A null, empty or unmatched text has the score of the intercept alone. Repeated rows score alike;
    an empty table stays empty; input columns of the added names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "predicted", "clauses", "strongest")
    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                         F.lit(0).alias("clauses"), F.lit(None).cast("string").alias("strongest")).schema

    def run(batches):
        for batch in batches:
            found = [shared.value.score(t) for t in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p for p, _, _ in found], pa.float64()),
                 pa.array([int(p >= threshold) for p, _, _ in found], pa.int32()),
                 pa.array([n for _, n, _ in found], pa.int32()),
                 pa.array([c for _, _, c in found], pa.string())],
                names=[*batch.schema.names, "score", "predicted", "clauses", "strongest"])

    return docs.mapInArrow(run, schema)
