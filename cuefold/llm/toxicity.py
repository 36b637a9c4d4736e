"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns the words of a clause into symbols: insults and threats with weights, targets,
negations, verbs of reported speech, quotation marks, other words. Four weighted transducers read the
symbols together, and what an insult or a threat emits is its weight times the factors of the one path that
all four accept:

* insult: guesses at the clause's start whether a target will come; an insult emits its whole weight on a
  path where one comes, a tenth (ALONE) on a path where none does, and a path whose guess was wrong ends;
* threat: the same for threats;
* negation: what stands within three words after a negation emits NEGATED of its weight;
* reported speech: after a verb of speech to the clause's end, and between quotation marks, REPORTED.

A clause's score is the sum of what it emits; a document's features are the sum over its clauses, the
largest clause and the sum by length, and a logistic curve with slopes that aren't negative turns these
into a score. Nothing else of a document is an input, so an isolated word counts a tenth of one that is
aimed at somebody, and a negated or reported one less again.

Targets, negations, verbs of speech and threats are fixed words and keep their role whatever is learnt.
Insults are the seeds and the words and word beginnings that labelled training rows tell apart, MAX_TERMS
at most (the ones of greatest odds), words of MAX_WORD characters at most; they enter as weights of the
insult transducer. They and the curve are fitted on FIT_ROWS labelled rows at most, the ones of smallest
hash of doc_id and text; rows that repeat both train once, near copies among the rest count as one. Rows
whose crc32(doc_id as text) mod 4 is 2 are held out and never fitted. Labels, language, source and doc_id
are no inputs of a score.

Defined results: null and empty texts have the features 0; labels that are null, of unknown ids or neither
0 nor 1 are ignored, an id with both is toxic; without usable labels of both kinds the seeds and a fixed
curve score; repeated rows are scored each; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches
from cuefold.llm.storage import written

FIT_ROWS = 20_000
MAX_TERMS = 2_000
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7, 8)
MAX_WEIGHT = 8.0
MAX_WORD = 40
CACHED = 400_000
ALONE, NEGATED, REPORTED = 0.1, 0.3, 0.5
SCOPE = 3

# The grammar's seed words.
INSULTS = "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown fool jerk idiote imbécile connard dummkopf trottel arschloch estúpido imbécil".split()
THREATS = "kill killed hurt destroy murder burn beat tuer détruire töten vernichten matar destruir".split()
TARGETS = "you your yours he his she her they them their ye u tu toi ton ta vous votre il elle ils elles du dich dir dein ihr euch sie tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not no never none nobody don't doesn't isn't aren't wasn't won't cannot can't ne pas jamais aucun nicht kein keine nie niemals nunca jamás tampoco".split()
REPORTS = "said says say told tells quoted quote called wrote reported claimed according dit disait écrit selon sagte sagt schrieb laut dijo dice escribió según".split()
SEED_WEIGHT = 2.0
THREAT_WEIGHT = 1.5

_CLAUSE = re.compile(r"[.!?;|\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
_EDGES = ".,;:!?|\"'()[]{}<>*&%$#@+-=/\\“”«»’‘…—–"

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "ihtnrqo"
_PLAIN = (OTHER, 0.0)  # one object for all cached words


@dataclass(frozen=True)
class Transducer:
    """A path begins in each of `starts`; step gives the next state and a factor for what the symbol emits, or
    None where the path ends; a path counts if it stops in one of `finals` (None: in any)."""

    starts: tuple[int, ...]
    step: Callable[[int, str], tuple[int, float] | None]
    finals: frozenset[int] | None = None


def aimed(kind: str) -> Transducer:
    """Symbols of `kind` whole where the clause has a target, else ALONE. A target right before a verb of speech
    is the speaker and none. State 0: none comes, 1: one will, 2: one came; 3 and 4: 0 and 1 after what may be a speaker."""

    def step(state: int, symbol: str) -> tuple[int, float] | None:
        if state >= 3:
            if symbol == REPORT:
                return state - 3, 1.0
            if state == 3:
                return None
            state = 2
        if symbol == TARGET:
            return (3, 4, 2)[state], 1.0
        return state, ALONE if symbol == kind and state == 0 else 1.0

    return Transducer((0, 1), step, frozenset((0, 2, 4)))


def _negation(state: int, symbol: str) -> tuple[int, float]:
    """State: words that are left of a negation's scope."""
    if symbol == NEGATION:
        return SCOPE, 1.0
    return max(0, state - 1), NEGATED if state and symbol in (INSULT, THREAT) else 1.0


def _report(state: int, symbol: str) -> tuple[int, float]:
    """State: bit 0 after a verb of speech, bit 1 between quotation marks."""
    if symbol == REPORT:
        return state | 1, 1.0
    if symbol == QUOTE:
        return state ^ 2, 1.0
    return state, REPORTED if state and symbol in (INSULT, THREAT) else 1.0


class Composed:
    """The composition of transducers that read the same symbols: their factors multiply, and a path of the
    composition is one of each. Its table of steps fills as it is used."""

    def __init__(self, parts: tuple[Transducer, ...]):
        self.parts, self.starts = parts, tuple(product(*(p.starts for p in parts)))
        self.table: dict[tuple, tuple | None] = {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float] | None:
        at = state, symbol
        if at not in self.table:
            found = [p.step(s, symbol) for p, s in zip(self.parts, state, strict=True)]
            self.table[at] = None if None in found else (tuple(f[0] for f in found), math.prod(f[1] for f in found))
        return self.table[at]

    def _accepts(self, state: tuple) -> bool:
        return all(p.finals is None or s in p.finals for p, s in zip(self.parts, state, strict=True))

    def score(self, symbols: list[tuple[str, float]]) -> float:
        """What the symbols emit on accepted paths; the grammar's guesses leave one."""
        scored = 0.0
        for state in self.starts:
            total = 0.0
            for symbol, weight in symbols:
                step = self.step(state, symbol)
                if step is None:
                    break
                state, factor = step
                total += weight * factor
            else:
                if self._accepts(state):
                    scored += total
        return scored


def grammar() -> Composed:
    return Composed((aimed(INSULT), aimed(THREAT), Transducer((0,), _negation), Transducer((0,), _report)))


@dataclass
class Model:
    """Weights of words and word beginnings, and the curve."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    #: intercept, then for: log of 1 + sum, of 1 + largest clause, of 1 + sum by 100 words
    curve: tuple[float, ...] = (-4.0, 2.0, 2.0, 0.0)

    def __post_init__(self):
        self.roles = {w: (THREAT, THREAT_WEIGHT) for w in THREATS} | {w: (QUOTE, 0.0) for w in '"“”«»'}
        self.roles |= {w: (TARGET, 0.0) for w in TARGETS} | {w: (NEGATION, 0.0) for w in NEGATIONS} | {w: (REPORT, 0.0) for w in REPORTS}
        self.seeds = dict.fromkeys(INSULTS, SEED_WEIGHT)
        self.known: dict[str, tuple[str, float]] = {}
        self.machine = grammar()

    def __getstate__(self):
        return {"words": self.words, "prefixes": self.prefixes, "curve": self.curve}

    def __setstate__(self, state):
        self.__init__(**state)

    def symbol(self, word: str) -> tuple[str, float]:
        """The lexical transducer: a word's symbol and weight."""
        found = self.known.get(word)
        if found is None:
            found = self.roles.get(word)
            if found is None:
                weight = max([self.words.get(word, 0.0), self.seeds.get(word, 0.0), *(self.prefixes.get(word[:n], 0.0) for n in PREFIXES if len(word) >= n)])
                found = (INSULT, weight) if weight > 0 else _PLAIN
            if len(word) <= MAX_WORD:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[word] = found
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Of the whole text. Only clauses that hold an insult or a threat can emit anything."""
        words = (text or "").lower().split()
        known, symbol = self.known.get, self.symbol
        hit = False
        for w in words:
            kind = (known(w) or symbol(w.strip(_EDGES)))[0]
            if kind == INSULT or kind == THREAT:
                hit = True
                break
        # a word glued to others by punctuation is found when clauses are cut
        if not hit and not self._glued(words):
            return 0.0, 0.0, 0.0
        total = most = 0.0
        for clause in _CLAUSE.split(text.lower()):
            symbols = [symbol(w) for w in _WORD.findall(clause)]
            if any(s[0] in (INSULT, THREAT) for s in symbols):
                score = self.machine.score(symbols)
                total, most = total + score, max(most, score)
        return total, most, 100 * total / max(100, len(words))

    def _glued(self, words: list[str]) -> bool:
        return any(self.symbol(p)[0] in (INSULT, THREAT) for w in words if not w.strip(_EDGES).isalpha() for p in _WORD.findall(w))

    def score(self, features) -> np.ndarray:
        x = np.log1p(np.asarray(features, float).reshape(-1, 3))
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ np.array(self.curve[1:]), -30, 30)))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """toxic, text of `most` labelled rows at most that are not held out, the ones of smallest hash of doc_id and text.

    Rows that repeat an id and a text are one. What is broadcast is `most` ids, then `most` hashes of rows."""
    own = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).join(F.broadcast(own), "doc_id")
    hashed = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = hashed.select("row").distinct().orderBy("row").limit(most)
    return hashed.join(F.broadcast(rows), "row").groupBy("row").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")).select("toxic", "text")


def _near_key(words: list[str]) -> int:
    """The least hash of five words in a row: near copies mostly share it."""
    runs = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
    return min(xxhash.xxh64_intdigest(r) for r in runs) >> 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = FIT_ROWS) -> Model:
    """The model of the labelled training rows."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_near_key((t or "").lower().split()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.int64())], ["toxic", "text", "near"])

    rows = training_rows(docs, labels, id_col, text_col, most)
    rows = written(map_batches(rows, keyed, "toxic int, text string, near long"), "training")
    groups = rows.groupBy("near").agg(F.count("*").alias("n"))
    rows = rows.join(F.broadcast(groups), "near").select("toxic", "text", (1 / F.col("n")).alias("weight"))  # `most` rows at most
    sums = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    if set(sums) != {0, 1}:
        return Model()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for toxic, text, weight in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = {w.strip(_EDGES) for w in (text or "").lower().split()}
                terms = {"=" + w for w in words if 1 < len(w) <= MAX_WORD} | {"^" + w[:n] for w in words for n in PREFIXES if len(w) >= n}
                for term in terms:
                    held[term][toxic] += weight
            values = list(held.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *[pa.array([v[k] for v in values], pa.float64()) for k in (0, 1)]], ["term", "clean", "toxic"]
            )

    counts = map_batches(rows, counted, "term string, clean double, toxic double").groupBy("term").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    odds = F.log((F.col("t") + 0.5) / (sums[1] + 1)) - F.log((F.col("c") + 0.5) / (sums[0] + 1))
    usual = (F.col("t") + F.col("c")) * (sums[1] / (sums[0] + sums[1]))
    told = counts.withColumn("odds", odds).where((F.col("t") >= max(4.0, 0.01 * sums[1])) & (F.col("odds") >= 2.5) & (F.col("t") - usual >= 4 * F.sqrt(usual)))
    terms = told.orderBy(F.desc("odds"), "term").limit(MAX_TERMS).select("term", "odds").collect()
    weights = {r.term: min(MAX_WEIGHT, r.odds) for r in terms}
    model = Model({t[1:]: w for t, w in weights.items() if t[0] == "="}, {t[1:]: w for t, w in weights.items() if t[0] == "^"})

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["toxic", "weight", "a", "b", "c"])

    seen = map_batches(rows, measured, "toxic int, weight double, a double, b double, c double").toPandas()  # `most` rows of numbers
    model.curve = _logistic(np.log1p(seen[["a", "b", "c"]].to_numpy()), seen["toxic"].to_numpy(), seen["weight"].to_numpy())
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's steps, with slopes that aren't negative."""
    order = np.lexsort((y, *x.T, weight))  # sums in one order, however the rows came
    x, y, weight = x[order], y[order], weight[order]
    use = list(range(x.shape[1]))
    while True:
        a = np.hstack([np.ones((len(x), 1)), x[:, use]])
        b = np.zeros(a.shape[1])
        penalty = np.diag([1e-3] + [ridge] * len(use))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + penalty, a.T @ (weight * (y - p)) - penalty @ b)
            b = b + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if not use or b[1:].min() >= 0:
            break
        use.pop(int(np.argmin(b[1:])))
    out = [float(b[0]), 0.0, 0.0, 0.0]
    for k, value in zip(use, b[1:], strict=True):
        out[1 + k] = float(value)
    return tuple(out)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = model.score([model.features(t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["doc_id", "score"])

    rows = map_batches(slim, scored, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the documents that the model rejects."""
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found = model.score([model.features(t) for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(found < threshold))

    return map_batches(docs, kept, docs.schema)
