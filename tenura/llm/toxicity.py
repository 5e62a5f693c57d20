"""Toxicity: misspelled lexicon terms by Levenshtein automata over a trie, weighed by their surroundings."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.sampling import labelled_sample
from tenura.llm.texts import CACHE_WORDS, bounded, by_slice, held_out
from tenura.session import checkpointed

WORD = re.compile(r"[^\W_]+")
QUOTES = "\"“”„«»‹›"
# Terms that are toxic in any corpus; all others are learned.
SEEDS = ("idiot", "moron", "imbecile", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting")
REPORTING = frozenset(
    "said says quote quoted called wrote word term phrase dit dire mot sagte schrieb wort dijo palabra escribió".split()
)
ADDRESSING = frozenset("you your are such an tu vous es du ihr sie bist eres tú ustedes".split())
FEATURES = ["any", "exact", "close", "far", "quoted", "addressed", "density", "length"]


@dataclass(frozen=True)
class Toxicity:
    """``sample_rows`` bounds the labelled rows that terms and weights are learned from, ``terms`` the learned lexicon.

    A term needs ``support`` toxic documents and must be ``odds`` times as frequent among them as among the others.
    Words of at least ``one_edit`` and ``two_edits`` letters are also found with that many errors. A term that ends in
    ``*`` is a stem: it is found, with one error less, at the start of any word.
    """

    sample_rows: int = 20_000
    terms: int = 400
    support: int = 4
    odds: float = 30.0
    one_edit: int = 5
    two_edits: int = 9
    window: int = 6

    stems: tuple[int, ...] = (4, 5, 6)

    def edits(self, term: str) -> int:
        letters = len(term.rstrip("*"))
        allowed = (letters >= self.one_edit) + (letters >= self.two_edits)
        return max(0, allowed - 1) if term.endswith("*") else allowed

    def forms(self, word: str) -> list[str]:
        """What a word may be learned as: itself and its stems."""
        return [word, *[f"{word[:n]}*" for n in self.stems if len(word) > n]]


class Automaton:
    """All terms' Levenshtein automata run along their trie at once, made deterministic as words need it.

    A state is the set of (trie node, errors) that a prefix of the word can have reached. Nodes below which no term
    allows that many errors are left out, so states of ordinary words die after a few letters. The table of states is
    emptied when it is full.
    """

    STATES = 40_000

    def __init__(self, terms: Iterable[str], how: Toxicity):
        self.children: list[dict[str, int]] = [{}]
        self.final = [-1]
        self.stem = [-1]
        self.allowed = [-1]
        for term in sorted(set(terms)):
            limit, node = how.edits(term), 0
            self.allowed[0] = max(self.allowed[0], limit)
            for char in term.rstrip("*"):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.final.append(-1)
                    self.stem.append(-1)
                    self.allowed.append(-1)
                node = self.children[node][char]
                self.allowed[node] = max(self.allowed[node], limit)
            (self.stem if term.endswith("*") else self.final)[node] = limit
        self._reset()

    def _reset(self) -> None:
        start = self._closed({0: 0})
        self.sets: list[dict[int, int]] = [start]
        self.numbers: dict[frozenset, int] = {frozenset(start.items()): 0}
        self.steps: list[dict[str, int]] = [{}]
        self.accepted: list[int] = [self._accepts(start, self.final)]
        self.begun: list[int] = [self._accepts(start, self.stem)]

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add what is reached by leaving out letters of terms."""
        todo = sorted(nodes.items(), key=lambda x: x[1])
        for node, errors in todo:
            for child in self.children[node].values():
                if errors + 1 <= self.allowed[child] and errors + 1 < nodes.get(child, 99):
                    nodes[child] = errors + 1
                    todo.append((child, errors + 1))
        return nodes

    @staticmethod
    def _accepts(nodes: dict[int, int], limits: list[int]) -> int:
        """The least number of errors with which the word so far is a term, or -1."""
        return min((e for n, e in nodes.items() if e <= limits[n]), default=-1)

    def _step(self, state: int, char: str) -> int:
        after: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.allowed[node] and errors < after.get(node, 99):
                after[node] = errors

        for node, errors in self.sets[state].items():
            reach(node, errors + 1)
            for letter, child in self.children[node].items():
                reach(child, errors + (letter != char))
        after = self._closed(after)
        key = frozenset(after.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(after)
            self.steps.append({})
            self.accepted.append(self._accepts(after, self.final))
            self.begun.append(self._accepts(after, self.stem))
        self.steps[state][char] = self.numbers[key]
        return self.numbers[key]

    def errors(self, word: str) -> int:
        """The least number of allowed errors between the word and a term; -1 if there is none."""
        if len(self.sets) > self.STATES:
            self._reset()
        state, steps, best = 0, self.steps, 99
        for char in word:
            known = steps[state].get(char)
            state = self._step(state, char) if known is None else known
            if self.begun[state] >= 0:
                best = min(best, self.begun[state])
            if not self.sets[state]:
                break
        if self.accepted[state] >= 0:
            best = min(best, self.accepted[state])
        return best if best < 99 else -1


class Scanner:
    """Features of texts for one lexicon; results for words are kept in a cache of bounded size."""

    def __init__(self, terms: Iterable[str], how: Toxicity):
        self.how, self.automaton = how, Automaton(terms, how)
        self.seen: set[str] = set()
        self.hits: dict[str, int] = {}

    def features(self, text: str | None) -> list[float]:
        lowered = (text or "").lower()
        words = WORD.findall(lowered)
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
            self.hits.clear()
        distinct = set(words)
        for word in distinct.difference(self.seen):
            found = self.automaton.errors(word)
            if found >= 0:
                self.hits[word] = found
        self.seen |= distinct
        if self.hits.keys().isdisjoint(distinct):
            return [0.0] * 7 + [float(np.log1p(len(words)))]
        return self._hits(lowered, words)

    def spans(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(start, end, errors, quotation score) of each hit in the lower-cased text."""
        lowered = (text or "").lower()
        self.features(text)
        return [(m.start(), m.end(), self.hits[m[0]], q) for m, q, _ in self._contexts(lowered)]

    def _contexts(self, lowered: str):
        matches = list(WORD.finditer(lowered))
        size = self.how.window
        for i, match in enumerate(matches):
            if match[0] not in self.hits:
                continue
            near = matches[max(0, i - size) : i + size + 1]
            before = lowered[near[0].start() : match.start()]
            after = lowered[match.end() : near[-1].end() + 2]
            opened = sum(map(before.count, QUOTES))
            closed = sum(map(after.count, QUOTES))
            around = {m[0] for m in near}
            quoted = 1.0 if opened and closed else 0.5 if not REPORTING.isdisjoint(around) else 0.0
            yield match, quoted, not ADDRESSING.isdisjoint(around)

    def _hits(self, lowered: str, words: list[str]) -> list[float]:
        counts = [0.0, 0.0, 0.0]
        quoted = addressed = 0.0
        for match, quotation, addressing in self._contexts(lowered):
            counts[self.hits[match[0]]] += 1.0 - quotation
            quoted += quotation
            addressed += addressing * (1.0 - quotation)
        logs = np.log1p([*counts, quoted, addressed])
        density = sum(counts) / len(words)
        return [float(sum(counts) > 0), *map(float, logs), float(min(1.0, 20 * density)), float(np.log1p(len(words)))]


@dataclass(frozen=True)
class Model:
    """A lexicon and logistic weights over ``FEATURES``."""

    terms: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float
    how: Toxicity = field(default_factory=Toxicity)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features @ np.array(self.weights) + self.intercept, -35, 35)))


def _word_lists(sample: DataFrame, how: Toxicity) -> DataFrame:
    """(label, words): distinct lower-cased words and stems of each sampled text."""
    schema = pa.schema([("label", pa.int32()), ("words", pa.list_(pa.string()))])

    def work(piece: pa.RecordBatch) -> dict[str, object]:
        texts = piece.column("text").to_pylist()
        forms = [{f for w in set(WORD.findall((t or "").lower())) for f in how.forms(w)} for t in texts]
        return {"label": piece.column("label"), "words": [sorted(f) for f in forms]}

    return sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(by_slice(work, schema), "label int, words array<string>")


def learned_terms(sample: DataFrame, how: Toxicity) -> list[str]:
    """Terms that cover the toxic documents of the sample, best first.

    Words far more frequent in toxic documents are candidates. Of these the one found in most toxic documents that
    have no term yet is taken, until all are covered: words that only come from copies of one document add nothing.
    """
    lists = checkpointed(_word_lists(sample, how))
    sizes = {int(r[0] > 0): r[1] for r in lists.groupBy("label").count().collect()}  # labels are 0 and 1
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return []
    counts = lists.select((F.col("label") > 0).alias("t"), F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if("t").alias("toxic"), F.count_if(~F.col("t")).alias("clean")
    )
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    candidates = counts.where((F.col("toxic") >= how.support) & (odds >= how.odds) & (F.char_length("word") >= 4))
    chosen = bounded(candidates.select("word", "clean"))
    pairs = (
        lists.where("label > 0").withColumn("doc", F.monotonically_increasing_id())
        .select("doc", F.explode("words").alias("word")).join(chosen, "word").select("doc", "word", "clean")
    ).toPandas()  # toxic documents of the bounded sample
    terms: list[str] = []
    doc_of = {w: set(g) for w, g in pairs.groupby("word")["doc"]}
    penalty = pairs.groupby("word")["clean"].first().to_dict()
    words_of = {d: list(g) for d, g in pairs.groupby("doc")["word"]}
    open_docs = {w: len(d) for w, d in doc_of.items()}
    left = set(words_of)
    while left and len(terms) < how.terms:
        best = max(sorted(open_docs), key=lambda w: (open_docs[w] - 5 * penalty[w], -len(w)))
        if open_docs[best] <= 0:
            break
        terms.append(best)
        for doc in doc_of[best] & left:
            for word in words_of[doc]:
                open_docs[word] -= 1
        left -= doc_of[best]
        del open_docs[best]
    return terms


def scored_rows(docs: DataFrame, model: Model, extra: str | None = None) -> DataFrame:
    """(doc_id, score, features[, extra]) of whole texts."""
    fields = [("doc_id", pa.int64()), ("score", pa.float64()), ("features", pa.list_(pa.float64()))]
    if extra:
        fields.append((extra, pa.int32()))
    schema = pa.schema(fields)

    def run(batches):
        scanner = Scanner(model.terms, model.how)

        def work(piece: pa.RecordBatch) -> dict[str, object]:
            features = np.array([scanner.features(t) for t in piece.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            out = {"doc_id": piece.column("doc_id"), "score": pa.array(model.score(features)), "features": features.tolist()}
            return out | ({extra: piece.column(extra)} if extra else {})

        yield from by_slice(work, schema)(batches)

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if extra:
        columns.append(F.col(extra).cast("int").alias(extra))
    kinds = "doc_id bigint, score double, features array<double>" + (f", {extra} int" if extra else "")
    return docs.select(*columns).mapInArrow(run, kinds)


def fitted_weights(features: np.ndarray, labels: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a ridge on standardised features."""
    mean, spread = features.mean(axis=0), features.std(axis=0)
    spread[spread == 0] = 1.0
    x = np.column_stack([np.ones(len(features)), (features - mean) / spread])
    beta = np.zeros(x.shape[1])
    prior = np.diag([1e-6] + [ridge] * features.shape[1]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - labels) + prior @ beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + prior + 1e-9 * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    weights = beta[1:] / spread
    return weights, float(beta[0] - weights @ mean)


def fit(docs: DataFrame, labels: DataFrame, how: Toxicity | None = None) -> Model:
    """A model learned from labelled rows that are not held out.

    Without both classes among them the seeds are scored by fixed weights: a term raises a document above one half.
    """
    how = how or Toxicity()
    sample = checkpointed(labelled_sample(docs, labels, "toxic", how.sample_rows))
    terms = tuple(dict.fromkeys([*SEEDS, *learned_terms(sample, how)]))
    plain = Model(terms, (3.0, 1.0, 0.5, 0.0, -0.5, 0.5, 0.0, 0.0), -3.0, how)
    rows = scored_rows(sample, plain, "label").select("features", "label").toPandas()  # the bounded sample
    if rows["label"].nunique() < 2:
        return plain
    weights, intercept = fitted_weights(np.array(rows["features"].tolist()), (rows["label"] > 0).to_numpy(float))
    return Model(terms, tuple(map(float, weights)), intercept, how)


def toxicity(docs: DataFrame, labels: DataFrame, how: Toxicity | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted.

    Texts alone are scored; NULL and empty texts get the score of a text without hits. Repeated rows and NULL ids are
    scored like any other; an empty table gives no rows; other columns are ignored.
    """
    model = fit(docs, labels, how)
    return scored_rows(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
