"""Language identification of words in code-switched text by a linear-chain conditional random field."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.texts import CACHE_WORDS, bounded, by_slice, held_out, mixed
from tenura.session import checkpointed

# Letters with their combining signs.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNKNOWN = "und"
# Features of a word that are not n-grams: itself, its lexicon entry, a prefix and a suffix.
FIXED = 4


@dataclass(frozen=True)
class LanguageField:
    """``languages`` (the most frequent ones), ``docs_per_language``, ``lines`` (of a document) and ``line_words`` bound
    what the field is learned from: lines spread over a text, and of a longer line a run whose place is a hash of the id.

    ``bits`` is the size of the hashed feature space; ``mixed`` is the share of training lines that are made of the
    halves of two lines, so that transitions between languages are learned. A word that was seen ``lexicon_count`` times
    or more, ``lexicon_share`` of them in one language, is in that language's lexicon.
    """

    languages: int = 200
    docs_per_language: int = 1500
    lines: int = 4
    line_words: int = 100
    bits: int = 16
    epochs: int = 5
    batch: int = 128
    rate: float = 0.3
    mixed: float = 0.3
    lexicon_count: int = 3
    lexicon_share: float = 0.9
    seed: int = 11


def word_hashes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each between a start and an end sign; their owner, place in the word, and word hashes."""
    points = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - starts[owner]
    powers = np.cumprod(np.full(int(sizes.max()) if len(sizes) else 0, 0x9E3779B97F4A7C15, np.uint64))
    whole = mixed(np.add.reduceat(points * powers[place], starts)) if len(words) else np.empty(0, np.uint64)
    return points, owner, place, whole


def word_features(words: Sequence[str], bits: int, lexicon: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one word after another, and how many each has.

    They are the word itself, the language whose lexicon has it, its first and last three letters, and all bigrams and
    trigrams with the word's ends. ``lexicon`` has sorted word hashes and the language of each.
    """
    points, owner, place, whole = word_hashes(words)
    sizes = np.bincount(owner, minlength=len(words)) - 2
    counts = FIXED + 2 * sizes + 1
    base = np.cumsum(counts) - counts
    found = np.zeros(int(counts.sum()), np.uint64)

    def grams(n: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(place + n <= (sizes + 2)[owner])
        value = np.full(len(at), n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0xBF58476D1CE4E5B9) + points[at + i]
        return at, mixed(value)

    found[base] = whole
    entry = np.zeros(len(words), np.uint64)
    if lexicon is not None and len(lexicon[0]):
        near = np.minimum(np.searchsorted(lexicon[0], whole), len(lexicon[0]) - 1)
        entry = np.where(lexicon[0][near] == whole, lexicon[1][near].astype(np.uint64) + np.uint64(1), entry)
    found[base + 1] = mixed(entry + np.uint64(0x632BE59BD9B4E019))
    at, value = grams(4)  # a word of one letter has none, one of two letters one with both ends
    first, last = place[at] == 0, place[at] + 4 == (sizes + 2)[owner[at]]
    found[base[owner[at[first]]] + 2] = value[first] + np.uint64(1)
    found[base[owner[at[last]]] + 3] = value[last] + np.uint64(2)
    for n, shift in ((2, 0), (3, 1)):
        at, value = grams(n)
        found[base[owner[at]] + FIXED + place[at] + shift * (sizes[owner[at]] + 1)] = value
    return (mixed(found) >> np.uint64(64 - bits)).astype(np.int64), counts


def learned_lexicon(lines: Sequence[Sequence[str]], tags: Sequence[int], how: LanguageField) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of words that belong to one language, and which."""
    seen: dict[str, Counter] = {}
    for words, tag in zip(lines, tags):
        for word in words:
            seen.setdefault(word, Counter())[tag] += 1
    kept = []
    for word, counts in seen.items():
        tag, most = counts.most_common(1)[0]
        if counts.total() >= how.lexicon_count and most >= how.lexicon_share * counts.total():
            kept.append((word, tag))
    hashes = word_hashes([w for w, _ in kept])[3]
    order = np.argsort(hashes)
    return hashes[order], np.array([t for _, t in kept], np.int64)[order]


def text_lines(text: str | None) -> list[list[str]]:
    """Lower-cased words of the lines that have any."""
    return [words for line in (text or "").lower().split("\n") if (words := WORD.findall(line))]


class Packed:
    """Sequences side by side: step t holds the t-th element of every sequence that has one, longest first."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        long = sizes[self.order]
        starts = (np.cumsum(sizes) - sizes)[self.order]
        steps = int(long[0]) if len(long) else 0
        self.live = np.searchsorted(-long, -np.arange(steps), "left")
        self.at = [starts[: self.live[t]] + t for t in range(steps)]


def forward_backward(
    emission: np.ndarray, sizes: np.ndarray, start: np.ndarray, transition: np.ndarray, expected: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of all labels of all elements, expected transitions and expected first labels.

    Without ``expected`` the transitions, which only training needs, are left at zero.

    ``emission`` has a row of scores for each element of the concatenated sequences. Messages are scaled to sum to one
    at each step, so lengths do not matter.
    """
    packed = Packed(sizes)
    local = np.exp(emission - emission.max(axis=1, keepdims=True))
    move = np.exp(transition - transition.max()).astype(local.dtype)
    begin = np.exp(start - start.max()).astype(local.dtype)
    forward, backward = np.empty_like(local), np.empty_like(local)
    pairs = np.zeros_like(transition)
    for t, at in enumerate(packed.at):
        value = local[at] * (begin if t == 0 else forward[packed.at[t - 1][: len(at)]] @ move)
        forward[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(len(packed.at) - 1, -1, -1):
        at = packed.at[t]
        value = np.ones((len(at), local.shape[1]), local.dtype)
        if t + 1 < len(packed.at):
            after = packed.at[t + 1]
            reached = local[after] * backward[after]
            n = len(after)
            value[:n] = reached @ move.T
            if expected:
                joint = forward[at[:n], :, None] * move[None] * reached[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        backward[at] = value / value.sum(axis=1, keepdims=True)
    posterior = forward * backward
    posterior /= posterior.sum(axis=1, keepdims=True)
    first = posterior[packed.at[0]].sum(axis=0) if packed.at else np.zeros(local.shape[1])
    return posterior, pairs, first


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    weights: np.ndarray
    start: np.ndarray
    transition: np.ndarray
    lexicon: tuple[np.ndarray, np.ndarray]
    how: LanguageField


class Tagger:
    """Posteriors of words; the summed weights of a word's features are kept in a cache of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)), np.float32)

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.place)
        if len(self.place) + len(new) > CACHE_WORDS:
            self._clear()
            new = words
        if not new:
            return
        listed = list(new)
        base = len(self.place)
        self.place.update(zip(listed, range(base, base + len(listed))))
        if base + len(listed) > len(self.scores):
            grown = np.zeros((max(2 * len(self.scores), base + len(listed)), len(self.model.labels)), np.float32)
            grown[:base] = self.scores[:base]
            self.scores = grown
        for start in range(0, len(listed), 20_000):
            some = listed[start : start + 20_000]
            flat, counts = word_features(some, self.model.how.bits, self.model.lexicon)
            sums = np.add.reduceat(self.model.weights[flat], np.cumsum(counts) - counts, axis=0)
            self.scores[base + start : base + start + len(some)] = sums

    def posteriors(self, lines: list[list[str]]) -> np.ndarray:
        """Label probabilities of all words of the lines, one after another."""
        words = [w for line in lines for w in line]
        if not words:
            return np.zeros((0, len(self.model.labels)))
        self._learn(set(words))
        rows = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        return forward_backward(self.scores[rows], sizes, self.model.start, self.model.transition, expected=False)[0]


def trained(lines: list[list[str]], tags: list[int], labels: list[str], how: LanguageField) -> Model:
    """Weights by stochastic gradients of the conditional log-likelihood, scaled by their history (Adagrad)."""
    draw = np.random.default_rng(how.seed)
    size, n = 1 << how.bits, len(labels)
    weights, start, transition = np.zeros((size, n)), np.zeros(n), np.zeros((n, n))
    past = [np.full_like(weights, 1e-2), np.full_like(start, 1e-2), np.full_like(transition, 1e-2)]
    lexicon = learned_lexicon(lines, tags, how)
    listed = sorted({w for line in lines for w in line})
    number = dict(zip(listed, range(len(listed))))
    features, sizes_of = word_features(listed, how.bits, lexicon)
    starts_of = np.cumsum(sizes_of) - sizes_of
    numbered = [np.fromiter(map(number.__getitem__, line), np.int64, len(line)) for line in lines]
    for _ in range(how.epochs):
        order = draw.permutation(len(lines))
        for at in range(0, len(order), how.batch):
            words, gold, sizes = [], [], []
            for i in order[at : at + how.batch]:
                line, tag = numbered[i], tags[i]
                parts = [(line, tag)]
                if draw.random() < how.mixed:
                    j = int(draw.integers(len(lines)))
                    parts = [(line[: len(line) // 2 + 1], tag), (numbered[j][len(numbered[j]) // 2 :], tags[j])]
                words += [p for p, _ in parts]
                gold += [np.full(len(p), t) for p, t in parts]
                sizes.append(sum(len(p) for p, _ in parts))
            words, gold, sizes = np.concatenate(words), np.concatenate(gold), np.array(sizes)
            counts = sizes_of[words]
            ends = np.cumsum(counts)
            flat = features[np.repeat(starts_of[words] - (ends - counts), counts) + np.arange(ends[-1])]
            emission = np.add.reduceat(weights[flat], ends - counts, axis=0)
            posterior, pairs, first = forward_backward(emission, sizes, start, transition)
            firsts = np.cumsum(sizes) - sizes
            inner = np.ones(len(gold), bool)
            inner[firsts] = False
            truth = np.zeros_like(transition)
            np.add.at(truth, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1.0)
            posterior[np.arange(len(gold)), gold] -= 1.0
            used, where = np.unique(flat, return_inverse=True)
            spread = np.repeat(posterior, counts, axis=0)
            slope = np.column_stack([np.bincount(where, spread[:, k], len(used)) for k in range(n)]) / len(sizes)
            past[0][used] += slope**2
            weights[used] -= how.rate * slope / np.sqrt(past[0][used])
            for value, history, step in (
                (start, past[1], (first - np.bincount(gold[firsts], minlength=n)) / len(sizes)),
                (transition, past[2], (pairs - truth) / len(sizes)),
            ):
                history += step**2
                value -= how.rate * step / np.sqrt(history)
    return Model(tuple(labels), weights.astype(np.float32), start, transition, lexicon, how)


def fit(docs: DataFrame, how: LanguageField | None = None) -> Model | None:
    """A field learned from text and language of rows that are not held out; None without any."""
    how = how or LanguageField()
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    # At most ``languages`` rows.
    counts = bounded(known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.col("_n").desc(), "lang").limit(how.languages))
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = known.join(counts, "lang").where(place * F.col("_n") < how.docs_per_language)
    run = F.pmod(F.xxhash64(F.lit("run"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = checkpointed(sample.select("lang", "text", run.alias("run")))
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string()))])

    def work(piece: pa.RecordBatch) -> dict[str, object]:
        out: dict[str, list] = {"lang": [], "words": []}
        for lang, text, run in zip(*(piece.column(i).to_pylist() for i in range(3))):
            lines = text_lines(text)
            for line in lines[:: max(1, len(lines) // how.lines)][: how.lines]:
                begin = int(run * (max(0, len(line) - how.line_words) + 1))
                out["lang"].append(lang)
                out["words"].append(line[begin : begin + how.line_words])
        return out

    rows = sample.mapInArrow(by_slice(work, schema), "lang string, words array<string>").toPandas()  # the bounded sample
    if rows.empty:
        return None
    labels = sorted(rows["lang"].unique())
    rows = rows.assign(key=rows["words"].map(" ".join)).sort_values(["lang", "key"])
    tags = [labels.index(x) for x in rows["lang"]]
    return trained([list(w) for w in rows["words"]], tags, labels, how)


def tagged_words(model: Model, text: str | None) -> list[tuple[str, str, float]]:
    """(word, language, probability) of each word of a text."""
    lines = text_lines(text)
    posterior = Tagger(model).posteriors(lines)
    best = posterior.argmax(axis=1)
    words = [w for line in lines for w in line]
    return [(w, model.labels[b], float(p[b])) for w, b, p in zip(words, best, posterior)]


def text_shares(tagger: Tagger, texts: Sequence[str | None]) -> np.ndarray:
    """Each label's part of the letters of whole texts; zeros for a text without a letter. Equal lines are tagged once."""
    number: dict[str, int] = {}
    owner, line_of = [], []
    for i, text in enumerate(texts):
        for line in (text or "").lower().split("\n"):
            owner.append(i)
            line_of.append(number.setdefault(line, len(number)))
    lines = [WORD.findall(line) for line in number]
    full = [i for i, words in enumerate(lines) if words]
    posterior = tagger.posteriors([lines[i] for i in full])
    shares = np.zeros((len(texts), len(tagger.model.labels)))
    if not full:
        return shares
    letters = np.fromiter((len(w) for i in full for w in lines[i]), np.float64)
    sizes = np.array([len(lines[i]) for i in full])
    sums = np.zeros((len(lines), shares.shape[1]))
    sums[full] = np.add.reduceat(letters[:, None] * posterior, np.cumsum(sizes) - sizes, axis=0)
    np.add.at(shares, np.array(owner), sums[np.array(line_of)])
    total = shares.sum(axis=1, keepdims=True)
    return np.divide(shares, total, out=shares, where=total > 0)


def languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score): the language with the largest share of a text's letters, and that share."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        tagger = Tagger(model) if model else None

        def work(piece: pa.RecordBatch) -> dict[str, object]:
            if tagger is None:
                return {"doc_id": piece.column("doc_id"), "lang_pred": [UNKNOWN] * piece.num_rows, "score": [0.0] * piece.num_rows}
            shares = text_shares(tagger, piece.column("text").to_pylist())
            best, score = shares.argmax(axis=1), np.minimum(shares.max(axis=1), 1.0)
            names = [model.labels[k] if s > 0 else UNKNOWN for k, s in zip(best, score)]
            return {"doc_id": piece.column("doc_id"), "lang_pred": names, "score": score}

        yield from by_slice(work, schema)(batches)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identified(docs: DataFrame, how: LanguageField | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred and score.

    Each line is a sequence; whole texts are labelled, all words alike by their letters. NULL texts and texts without a
    letter are ``und`` with score 0, as is everything when no labelled row is there to learn from. Repeated rows and
    NULL ids are predicted like any other; an empty table gives no rows; lang and source are not looked at, other
    columns are ignored.
    """
    return languages(docs, fit(docs, how)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
