"""Quality: a weak-label model over overlapping heuristic labellers, whose posterior labels train a hashed linear scorer.

Nine labellers look at a text's surface and vote good, bad or nothing. How often each pattern of votes occurs over all
documents (at most 3^9 patterns) is all that expectation-maximisation needs: it estimates, without any label, how each labeller
votes on good and on bad documents, and the share of good ones. A pattern's posterior is the label of its documents. On a
bounded sample these labels train a logistic scorer on hashed words and word shapes, averaged over the text, which then scores
every whole text, also where the labellers say nothing.

Cases: null text or no word: score 0, posterior of its votes (too short), not kept. Texts of one line or few words: labellers
that need more don't vote. Ties and repeated rows: each counts and is scored, alike. Empty table: no row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.llm.common import SpanHashes, bounded_sample, chunks, code_points, mix, runs, segment_sums, table, with_columns_from_text

SPACE, LOWER, UPPER, DIGIT, OTHER = range(5)
#: Each labeller by name: a measure, and (bad below, good from, good to, bad above); None: that side doesn't count.
LABELLERS: dict[str, tuple[float | None, float | None, float | None, float | None]] = {
    "symbols": (None, 0.0, 0.06, 0.12),  # other characters among all but white space
    "capitals": (None, 0.0, 0.2, 0.4),  # upper case among letters
    "word_length": (2.0, 3.0, 9.0, 12.0),  # mean characters of a word
    "repeated_lines": (None, 0.0, 0.1, 0.3),  # lines that an earlier line equals; from 4 lines on
    "common_word": (None, 0.0, 0.12, 0.25),  # share of the most frequent word; from 20 words on
    "sentence_ends": (0.1, 0.5, 1.0, None),  # lines that end as a sentence
    "words": (5.0, 30.0, float("inf"), None),
    "line_words": (2.0, 5.0, float("inf"), None),  # mean words of a line
    "echoes": (None, 0.0, 0.05, 0.15),  # words that equal the word before; from 6 words on
}
NONE, BAD, GOOD = 0, 1, 2
#: Hashed rows of a word; see features().
ROWS = 3

_CLASSES: np.ndarray | None = None


def classes() -> np.ndarray:
    global _CLASSES
    if _CLASSES is None:
        kind = lambda c: SPACE if c.isspace() else UPPER if c.isupper() else LOWER if c.isalpha() else DIGIT if c.isdigit() else OTHER
        _CLASSES = np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)
    return _CLASSES


def measures(texts: list[str]) -> np.ndarray:
    """What each labeller looks at, a row for each text; nan where it can't be measured."""
    out = np.full((len(texts), len(LABELLERS)), np.nan)
    for a, b in chunks(texts):
        cp, at = code_points(texts[a:b])
        kind = classes()[cp]
        n = b - a
        owner = np.repeat(np.arange(n), np.diff(at))
        count = np.bincount(owner * 5 + kind, minlength=5 * n).reshape(n, 5).astype(float)
        start, end = runs(kind != SPACE)
        word_owner = owner[start]
        n_words = np.bincount(word_owner, minlength=n).astype(float)
        ink, alpha = count[:, 1:].sum(1), count[:, LOWER] + count[:, UPPER]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[a:b, 0] = count[:, OTHER] / ink
            out[a:b, 1] = count[:, UPPER] / alpha
            out[a:b, 2] = ink / n_words
            h = SpanHashes(cp)(start, end)
            echo = np.r_[False, (h[1:] == h[:-1]) & (word_owner[1:] == word_owner[:-1])]
            out[a:b, 8] = np.where(n_words >= 6, np.bincount(word_owner, echo[: len(h)], minlength=n) / n_words, np.nan)
            key = np.lexsort((h, word_owner))
            new = np.flatnonzero(np.r_[True, (h[key][1:] != h[key][:-1]) | (word_owner[key][1:] != word_owner[key][:-1])]) if len(key) else key
            size = np.diff(np.r_[new, len(key)])
            most = np.zeros(n)
            np.maximum.at(most, word_owner[key][new], size)
            out[a:b, 4] = np.where(n_words >= 20, most / n_words, np.nan)
            # lines with a word in them
            line_start, line_end = runs(cp != 10)
            first, last = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
            line_start, line_end, first, last = (x[first < last] for x in (line_start, line_end, first, last))
            line_owner = owner[line_start]
            n_lines = np.bincount(line_owner, minlength=n).astype(float)
            h = SpanHashes(cp)(line_start, line_end)
            key = np.lexsort((h, line_owner))
            distinct = np.bincount(line_owner[key][np.flatnonzero(np.r_[True, (h[key][1:] != h[key][:-1]) | (line_owner[key][1:] != line_owner[key][:-1])])], minlength=n) if len(key) else np.zeros(n)
            out[a:b, 3] = np.where(n_lines >= 4, 1 - distinct / n_lines, np.nan)
            final = cp[np.minimum(end[last - 1] - 1, len(cp) - 1)] if len(last) else np.zeros(0, np.uint32)
            out[a:b, 5] = np.bincount(line_owner, np.isin(final, [ord(c) for c in ".!?…。\"')"]), minlength=n) / n_lines
            out[a:b, 6] = n_words
            out[a:b, 7] = n_words / n_lines
    return out


def votes(texts: list[str | None]) -> np.ndarray:
    m = measures([t or "" for t in texts])
    out = np.zeros(m.shape, np.uint8)
    with np.errstate(invalid="ignore"):
        for k, (low, good, to, high) in enumerate(LABELLERS.values()):
            out[:, k][(m[:, k] >= good) & (m[:, k] <= to)] = GOOD
            if low is not None:
                out[:, k][m[:, k] < low] = BAD
            if high is not None:
                out[:, k][m[:, k] > high] = BAD
    return out


def pattern_numbers(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ (3 ** np.arange(v.shape[1]))


@dataclass
class LabelModel:
    """Estimated behaviour of the labellers: chance[y, labeller, vote], and the share of good documents."""

    chance: np.ndarray
    good: float

    def posterior(self, v: np.ndarray) -> np.ndarray:
        log = np.log(np.clip([1 - self.good, self.good], 1e-9, 1))[:, None] + sum(np.where(v[:, k] == NONE, 0, np.log(self.chance[:, k, v[:, k]])) for k in range(v.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))

    @property
    def accuracy(self) -> dict[str, float]:
        """Of each labeller, among its votes."""
        right = (1 - self.good) * self.chance[0, :, BAD] + self.good * self.chance[1, :, GOOD]
        cast = right + (1 - self.good) * self.chance[0, :, GOOD] + self.good * self.chance[1, :, BAD]
        return dict(zip(LABELLERS, (right / np.maximum(cast, 1e-12)).tolist(), strict=True))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """From the majority of votes on, with one vote of each kind added so that no chance is 0."""
    good, bad = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
    p = np.where(bad >= 2, 0.1, np.where(good > bad, 0.9, 0.5)) if len(patterns) else np.zeros(0)
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        cast = np.stack([[np.bincount(patterns[:, k], w, minlength=3)[1:] + 1 for k in range(patterns.shape[1])] for w in weight])
        chance = np.concatenate([np.ones((2, patterns.shape[1], 1)), cast / cast.sum(2, keepdims=True)], 2)  # no vote tells nothing
        new = LabelModel(chance, float((weight[1].sum() + 1) / (counts.sum() + 2)))
        q = new.posterior(patterns)
        if model is not None and np.abs(q - p).max(initial=0) < 1e-7:
            break
        model, p = new, q
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        whole = [t or "" for t in texts]
        for a, b in chunks(whole):
            rows, owner = features(whole[a:b], len(self.weights))
            n = np.bincount(owner, minlength=b - a)
            z = segment_sums(self.weights[rows].sum(1), owner, b - a) / np.maximum(n, 1) + self.bias
            out[a:b] = np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0)
        return out


def features(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each word: its letters, its shape, and whether it equals the word before; and the word's text. Sorted by text."""
    cp, at = code_points(texts)
    kind = classes()[cp]
    start, end = runs(kind != SPACE)
    if not len(start):
        return np.zeros((0, ROWS), np.int64), np.zeros(0, np.int64)
    shape = ((kind[start].astype(np.uint64) * 8 + kind[(start + end) // 2]) * 8 + kind[end - 1]) * 16 + np.minimum(end - start, 15).astype(np.uint64)
    word, owner = SpanHashes(cp)(start, end), np.searchsorted(at, start, side="right") - 1
    again = np.r_[False, (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])]
    rows = np.stack([word, mix(shape + np.uint64(1 << 40)), mix(again + np.uint64(1 << 41))], 1) % np.uint64(buckets)
    return rows.astype(np.int64), owner


@dataclass
class Trainer:
    """``max_fit_rows`` rows of ``max_fit_chars`` characters at most are gathered to train the scorer."""

    max_fit_rows: int = 3000
    max_fit_chars: int = 50_000
    buckets: int = 1 << 15
    epochs: int = 12
    rate: float = 1.0
    seed: int = 5

    def fit(self, texts: list[str], posterior: np.ndarray) -> Scorer:
        rng = np.random.default_rng(self.seed)
        docs = [features([t], self.buckets)[0] for t in texts]
        use = [i for i, d in enumerate(docs) if len(d)]
        w, squares, bias = np.zeros(self.buckets), np.full(self.buckets, 1e-4), 0.0
        if not use:
            return Scorer(w, bias)
        mass = np.array([posterior[use].sum(), (1 - posterior[use]).sum()]) + 1
        for epoch in range(self.epochs):
            for batch in np.array_split(rng.permutation(use), max(1, len(use) // 16)):
                size = np.array([len(docs[i]) for i in batch])
                flat = np.concatenate([docs[i] for i in batch])
                owner = np.repeat(np.arange(len(batch)), size)
                z = np.bincount(owner, w[flat].sum(1), minlength=len(batch)) / size + bias
                p, y = 1 / (1 + np.exp(-np.clip(z, -40, 40))), posterior[batch]
                err = (y * (p - 1) / mass[0] + (1 - y) * p / mass[1]) * mass.sum() / 2 / len(batch)
                rows, inverse = np.unique(flat, return_inverse=True)
                grad = np.bincount(inverse.ravel(), np.repeat(err / size, size * ROWS), minlength=len(rows))
                squares[rows] += grad * grad
                w[rows] -= self.rate * grad / np.sqrt(squares[rows])
                bias -= 0.1 * self.rate * err.sum() / (1 + epoch)
        return Scorer(w, float(bias))


@dataclass
class QualityModel:
    labels: LabelModel
    scorer: Scorer
    threshold: float = 0.5
    fields: list = field(default_factory=lambda: [T.StructField("score", T.DoubleType()), T.StructField("posterior", T.DoubleType()), T.StructField("votes", T.StringType())])

    def score(self, texts: list[str | None]) -> list[list]:
        v = votes(texts)
        return [self.scorer.score(texts).tolist(), self.labels.posterior(v).tolist(), ["".join("-bg"[x] for x in row) for row in v]]


def fit(docs: DataFrame, trainer: Trainer | None = None, text: str = "text", key: str = "doc_id") -> QualityModel:
    """Vote patterns are counted over all rows of ``docs``; the scorer learns from a bounded sample.

    The sample has ``max_fit_rows`` rows at most, whatever is repeated: rows alike in key and text count once.
    """
    trainer = trainer or Trainer()
    names = list(LABELLERS)
    voted = with_columns_from_text(docs.select(F.col(text).alias("text")), "text", [T.StructField("pattern", T.LongType())], lambda texts: [pattern_numbers(votes(texts)).tolist()])
    got = voted.groupBy("pattern").count().collect()  # 3 ^ labellers rows at most
    numbers = np.array([r[0] for r in got], np.int64)
    patterns = (numbers[:, None] // 3 ** np.arange(len(names)) % 3).astype(np.uint8).reshape(-1, len(names))
    labels = expectation_maximisation(patterns, np.array([r[1] for r in got], float))
    usable = docs.where(F.col(text).isNotNull() & (F.length(text) <= trainer.max_fit_chars)).select(*{key: 0, text: 0})
    texts = sorted(r[0] for r in bounded_sample(usable, list({key: 0, text: 0}), trainer.max_fit_rows, trainer.seed).select(text).collect())
    return QualityModel(labels, trainer.fit(texts, labels.posterior(votes(texts))))


def assess(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1), posterior, votes (a letter for each labeller) and keep."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    out = with_columns_from_text(docs, text, model.fields, lambda texts: held.value.score(texts))
    return out.withColumn("keep", F.col("score") >= model.threshold)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return assess(docs, fit(docs)).select("doc_id", "score", "posterior", "votes", "keep")
