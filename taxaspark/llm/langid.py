"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text's subwords are its 2- to 4-character pieces of lower-cased words, word ends included; each is hashed to a row of an
embedding table. The mean row goes through a linear softmax. Both are trained in numpy by stochastic gradient descent.
As mean and softmax weights are linear, the two tables are multiplied once and a piece then costs one row of len(langs) numbers.

Confidences are calibrated by a temperature fitted on a part of the sample that takes no part in training, and the rejection
threshold is set there too: below it fall at most ``reject_quantile`` of the rightly labelled calibration texts.

Cases: null text or no letter: ``und``, score 0, rejected. Very short texts: scored as any other. Equal scores: the first
language by code point. No usable training row: every text is ``und``. Repeated rows: each is scored, alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from taxaspark.llm.common import chunks, code_points, hash_cut, held_out, letters, mix, sample_hash, table, with_columns_from_text

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray  # buckets x langs
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    orders: tuple[int, ...] = (2, 3, 4)

    def score(self, texts: list[str | None]) -> list[list]:
        """lang_pred, score and accepted of each text."""
        n = len(texts)
        pred, conf, ok = ["und"] * n, [0.0] * n, [False] * n
        live = [i for i, t in enumerate(texts) if t and self.langs]
        lowered = [texts[i].lower() for i in live]
        for a, b in chunks(lowered):
            logits, count = self._logits(lowered[a:b])
            p = softmax(logits / self.temperature)
            best = p.argmax(1)
            for j in np.flatnonzero(count):
                i = live[a + j]
                pred[i], conf[i] = self.langs[best[j]], float(p[j, best[j]])
                ok[i] = conf[i] >= self.reject_below
        return [pred, conf, ok]

    def _logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sums, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for bucket, owner in subwords(texts, len(self.weights), self.orders):
            count += np.bincount(owner, minlength=len(texts))
            for k in range(len(self.langs)):
                sums[:, k] += np.bincount(owner, self.weights[bucket, k], minlength=len(texts))
        return sums / np.maximum(count, 1)[:, None] + self.bias, count


def subwords(texts: list[str], buckets: int, orders: tuple[int, ...]):
    """(bucket, text number) of every subword, an array for each order. Texts are lower-cased."""
    cp, at = code_points(texts)
    if not len(cp):
        return
    is_letter = letters()[cp]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one boundary after each word; the last word end starts the next word
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))[keep]
    sym = np.where(is_letter, cp, 0)[keep].astype(np.uint64)
    real = sym != 0
    for n in orders:
        m = len(sym) - n + 1
        if m <= 0:
            continue
        good = owner[:m] == owner[n - 1 :]
        for k in range(1, n - 1):
            good &= real[k : m + k]
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h += sym[k : m + k] * _FACTORS[k] << np.uint64(5 * k)
        yield (mix(h[good]) % np.uint64(buckets)).astype(np.int64), owner[:m][good]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


#: Rows of a language that the fit sample has at least, if there are as many.
LEAST_ROWS = 20
#: Languages of a model at most; its weights (buckets x languages) and LEAST_ROWS rows of each are held by the driver.
MAX_LANGUAGES = 500


@dataclass
class Trainer:
    """Parameters of training, all of them bounds or rates that don't depend on the corpus."""

    max_fit_rows: int = 3000
    max_fit_chars: int = 50_000
    buckets: int = 1 << 15
    dim: int = 16
    segment: int = 300  # subwords of one order in a training segment
    segments: int = 4  # of each text, at most
    epochs: int = 4
    rate: float = 0.5
    calibration: float = 0.2
    reject_quantile: float = 0.001
    seed: int = 7
    orders: tuple[int, ...] = field(default=(2, 3, 4))

    def fit(self, texts: list[str], labels: list[str]) -> LanguageModel:
        """Train on the texts with a letter; the model of no rows knows no language."""
        langs = sorted(set(labels))
        rng = np.random.default_rng(self.seed)
        code = np.array([langs.index(x) for x in labels], np.int64)
        segments = [self._segments(t, rng) for t in texts]
        order = rng.permutation(len(texts))
        n_cal = int(len(texts) * self.calibration) if len(texts) >= 20 else 0
        cal, train = order[:n_cal], order[n_cal:]
        pairs = [(s, code[i]) for i in train for s in segments[i]]
        if not pairs or not langs:
            return LanguageModel([], np.zeros((1, 0)), np.zeros(0))
        # of each language the same weight, so that a common one doesn't drown the rest
        share = np.bincount([y for _, y in pairs], minlength=len(langs))
        weight = len(pairs) / (len(langs) * np.maximum(share, 1))
        table_, out, bias = rng.normal(0, 0.1, (self.buckets, self.dim)), rng.normal(0, 0.1, (self.dim, len(langs))), np.zeros(len(langs))
        for epoch in range(max(self.epochs, -(-1600 * self.epochs // max(len(pairs), 1))) if len(pairs) < 1600 else self.epochs):
            rate = self.rate / (1 + epoch / 4)
            for batch in np.array_split(rng.permutation(len(pairs)), max(1, len(pairs) // 16)):
                bags = [pairs[i][0] for i in batch]
                y = np.array([pairs[i][1] for i in batch])
                size = np.array([len(b) for b in bags])
                flat = np.concatenate(bags)
                mean = np.add.reduceat(table_[flat], np.r_[0, np.cumsum(size)[:-1]], axis=0) / size[:, None]
                p = softmax(mean @ out + bias)
                p[np.arange(len(y)), y] -= 1
                p *= (weight[y] / len(y))[:, None]
                back = (p @ out.T) / size[:, None]
                out -= rate * 4 * (mean.T @ p)
                bias -= rate * p.sum(0)
                np.add.at(table_, flat, -rate * 40 * np.repeat(back, size, axis=0))
        model = LanguageModel(langs, table_ @ out, bias, orders=self.orders)
        return self._calibrate(model, [texts[i] for i in cal], code[cal])

    def _segments(self, text: str, rng: np.random.Generator) -> list[np.ndarray]:
        parts = [b for b, _ in subwords([text.lower()], self.buckets, self.orders)]
        if not parts or not len(parts[0]):
            return []
        n = len(parts[0])
        if n <= self.segment:
            return [np.concatenate(parts)]
        starts = rng.integers(0, n - self.segment + 1, min(self.segments, -(-n // self.segment)))
        return [s for a in starts if len(s := np.concatenate([p[int(a * len(p) / n) :][: self.segment] for p in parts]))]

    def _calibrate(self, model: LanguageModel, texts: list[str], code: np.ndarray) -> LanguageModel:
        if not texts:
            return model
        logits, count = model._logits([t.lower() for t in texts])
        logits, code = logits[count > 0], code[count > 0]
        if not len(code):
            return model
        grid = np.geomspace(0.05, 5, 41)
        loss = [-np.log(softmax(logits / t)[np.arange(len(code)), code] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(logits / model.temperature)
        right = p.max(1)[p.argmax(1) == code]
        if len(right):
            # a margin below the calibration texts, as shorter texts than theirs are less certain
            model.reject_below = float(min(0.5, 0.8 * np.quantile(right, self.reject_quantile)))
        return model


def fit_quotas(counts: dict[str, int], bound: int) -> dict[str, int]:
    """Rows of each language in the sample: half of ``bound`` dealt evenly, the rest by the languages' shares."""
    if sum(counts.values()) <= bound:
        return dict(counts)
    even = max(LEAST_ROWS, bound // (2 * len(counts)))
    first = {x: min(n, even) for x, n in counts.items()}
    left, others = max(0, bound - sum(first.values())), max(1, sum(counts.values()) - sum(first.values()))
    return {x: first[x] + int(left * (n - first[x]) / others) for x, n in counts.items()}


def fit(rows: DataFrame, trainer: Trainer | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Train on a bounded sample of ``rows``: at most ``max_fit_rows`` of those of ``max_fit_chars`` characters at most.

    Half of the sample is dealt evenly to the languages and the rest by their share of the rows, so that each language of
    ``rows`` is learned however rare it is (by ``LEAST_ROWS`` rows or all it has, even if that takes more than the bound). Rows
    alike in key, text and language count once, and the bounds are hard. More than ``MAX_LANGUAGES`` languages raise an error.
    """
    trainer = trainer or Trainer()
    by = [key, text, lang]
    usable = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) <= trainer.max_fit_chars)).select(*by).withColumn("__sample", sample_hash(trainer.seed, by))
    # a row a language, as the model has; the margin covers the estimate's error
    counts = {r[0]: int(1.1 * r[1]) for r in usable.groupBy(F.col(lang)).agg(F.approx_count_distinct("__sample", 0.02)).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return trainer.fit([], [])
    quotas = fit_quotas(counts, trainer.max_fit_rows)
    of = lambda values: F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])[F.col(lang)]
    few = usable.where(F.col("__sample") <= of({x: hash_cut(quotas[x], n) for x, n in counts.items()})).dropDuplicates(["__sample"])
    place = F.row_number().over(Window.partitionBy(lang).orderBy("__sample"))
    sample = sorted((r[0], r[1]) for r in few.withColumn("__place", place).where(F.col("__place") <= of(quotas)).select(lang, text).collect())
    return trainer.fit([t for _, t in sample], [x for x, _ in sample])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and accepted."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: buckets x languages
    return with_columns_from_text(docs, text, FIELDS, lambda texts: held.value.score(texts))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
