"""The three model queries over a whole table, score by score, against loops over characters and words in plain integers and floats."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import langid, quality, toxicity
from taxaspark.llm.common import held_out

SMALL = "/root/testdata/sf0.001"
WORD = (1 << 64) - 1


def mixed(h):
    """The 64-bit finalizer, in plain integers."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> 33)) * factor & WORD
    return h ^ (h >> 33)


def span_hash(text, salt=0):
    total, power = 0, 1
    for c in text:
        total += (ord(c) + 1) * power
        power = power * 0x9E3779B97F4A7C15 & WORD
    return mixed((total + salt * 0x51ED2701) & WORD)


def runs_of(text, inside):
    """Maximal runs of characters for which ``inside`` holds."""
    out, run = [], ""
    for c in text + "\n":
        if inside(c):
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


def logistic(z):
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def test_language_scores_of_a_whole_table(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    rows = langid.op10_language_id(spark, SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        symbols = [s for word in runs_of((documents[r.doc_id] or "").lower(), str.isalpha) for s in (*map(ord, word), 0)]
        sums, n = [0.0] * len(model.langs), 0
        for order in model.orders:
            for at in range(len(symbols) - order + 1):
                piece = symbols[at : at + order]
                if all(piece[1:-1]):
                    h = order + sum(s * int(langid._FACTORS[k]) << 5 * k for k, s in enumerate(piece))
                    row = model.weights[mixed(h & WORD) % len(model.weights)]
                    sums, n = [a + b for a, b in zip(sums, row.tolist(), strict=True)], n + 1
        if not n:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
            continue
        logits = [(s / n + b) / model.temperature for s, b in zip(sums, model.bias.tolist(), strict=True)]
        powers = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(powers)), key=lambda k: (powers[k], -k))
        assert r.lang_pred == model.langs[best] and r.score == pytest.approx(powers[best] / sum(powers), abs=1e-9)
        assert r.accepted == (r.score >= model.reject_below)


def test_toxicity_scores_of_a_whole_table(spark, documents):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    rows = toxicity.op1_toxicity(spark, SMALL).collect()
    assert len(rows) == len(documents) and model.answers is not None
    buckets, n = len(model.answers) - 1, model.filters
    known = {}
    for r in rows:
        answers = []
        for word in runs_of((documents[r.doc_id] or "").lower(), str.isalpha):
            if word not in known:
                at = [span_hash(word[:k] if k else word, j + 1) % buckets for j, k in enumerate(toxicity.PIECES)]
                known[word] = sum(model.answers[a].astype(np.float64) for a in at)
            answers.append(known[word])
        answers += [len(toxicity.PIECES) * model.answers[buckets].astype(np.float64)] * max(toxicity.WIDTHS)
        z, col = model.out_bias, 0
        for i, width in enumerate(toxicity.WIDTHS):
            best = np.full(n, -np.inf)
            for t in range(len(answers) - width + 1):
                best = np.maximum(best, sum(answers[t + o][col + o * n : col + (o + 1) * n] for o in range(width)))
            act = np.maximum(best + model.bias[i * n : (i + 1) * n], 0)
            z += sum(a * b for a, b in zip(act.tolist(), model.out[i * n : (i + 1) * n].tolist(), strict=True))
            col += width * n
        score = logistic(model.platt[0] * z + model.platt[1])
        assert r.score == pytest.approx(score, abs=1e-4)
        assert r.predicted == int(r.score >= 0.3)


def test_quality_scores_of_a_whole_table(spark, documents):
    model = quality.fit(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
    rows = quality.op9_quality(spark, SMALL).collect()
    assert len(rows) == len(documents)
    kinds, weights = quality.classes(), model.scorer.weights
    for r in rows:
        z, words = 0.0, runs_of(documents[r.doc_id] or "", lambda c: kinds[ord(c)] != quality.SPACE)
        for before, word in zip([None, *words], words, strict=False):
            shape = ((int(kinds[ord(word[0])]) * 8 + int(kinds[ord(word[len(word) // 2])])) * 8 + int(kinds[ord(word[-1])])) * 16 + min(len(word), 15)
            z += sum(float(weights[h % len(weights)]) for h in (span_hash(word), mixed(shape + (1 << 40)), mixed((word == before) + (1 << 41))))
        score = logistic(z / len(words) + model.scorer.bias) if words else 0.0
        assert r.score == pytest.approx(score, abs=1e-9) and r.keep == (r.score >= model.threshold)
        # the posterior of the votes by Bayes' rule, labeller by labeller
        odds = [1 - model.labels.good, model.labels.good]
        for k, vote in enumerate(r.votes):
            if vote != "-":
                odds = [p * float(model.labels.chance[y, k, "-bg".index(vote)]) for y, p in enumerate(odds)]
        assert r.posterior == pytest.approx(odds[1] / sum(odds), abs=1e-9)
