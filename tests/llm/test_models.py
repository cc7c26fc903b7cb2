"""Language ID, toxicity and quality: held-out accuracy, calibration, and the odd cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import langid, quality, toxicity
from taxaspark.llm.common import SpanHashes, bounded_sample, held_out, runs

SF = "/root/testdata/sf0.01"
#: Null text, empty text, white space, one word, no letter, repeated rows, null id, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "123 !!"), (6, "the same"), (6, "the same"), (None, "no id"), (7, "über " * 40_000), (8, "日本語 🎉 \x00 x")]


def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id bigint, text string")
    # columns whose names clash with results, in other letters, too
    return rows.withColumns({"score": F.lit("old"), "Accepted": F.lit(1), "lang": F.lit(None).cast("string"), "posterior": F.lit(2), "index": F.lit(3)})


def test_span_hashes_depend_on_values_alone():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 5, 300).astype(np.uint32)
    h = SpanHashes(a)
    start = rng.integers(0, 290, 400)
    end = start + rng.integers(1, 10, 400)
    seen = {}
    for s, e, x in zip(start, end, h(start, end), strict=True):
        assert seen.setdefault(tuple(a[s:e]), x) == x
    assert len(set(seen.values())) == len(seen)


def test_runs():
    s, e = runs(np.array([1, 1, 0, 1, 0, 0, 1], bool))
    assert s.tolist() == [0, 3, 6] and e.tolist() == [2, 4, 7]
    assert [len(x) for x in runs(np.zeros(0, bool))] == [0, 0]


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    first = {r.k for r in bounded_sample(rows, ["k"], 500, 1).collect()}
    assert first == {r.k for r in bounded_sample(rows.repartition(3), ["k"], 500, 1).collect()}
    assert len(first) == 500
    assert bounded_sample(rows, ["k"], 20_000, 1).count() == 20_000
    assert bounded_sample(rows.limit(0), ["k"], 5, 1).count() == 0


def test_sample_of_repeated_and_null_ids(spark):
    """50,000 rows of one id, or of none: alike in text they are one row, else the bound holds, and no sample is empty."""
    for k in (7, None):
        rows = spark.range(50_000).select(F.lit(k).cast("bigint").alias("k"), F.lit("same").alias("text"), F.col("id").cast("string").alias("other"))
        assert bounded_sample(rows, ["k", "text"], 20, 1).count() == 1
        assert [bounded_sample(rows, ["k", "other"], n, 1).count() for n in (20, 1)] == [20, 1]


@pytest.mark.parametrize("k", [7, None])
def test_fits_on_repeated_ids(spark, monkeypatch, k):
    """Every model learns from at most the bound where all rows have one id or none, and learns as much as it may."""
    seen = []
    for module in (langid, toxicity, quality):
        fit = module.Trainer.fit
        monkeypatch.setattr(module.Trainer, "fit", lambda self, texts, *rest, fit=fit: seen.append(len(texts)) or fit(self, texts, *rest))
    text = F.concat(F.when(F.col("id") % 2 == 0, F.lit("some english words ")).otherwise(F.lit("deutsche worte hier ")), F.col("id").cast("string"))
    rows = spark.range(50_000).select(F.lit(k).cast("bigint").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    assert langid.fit(rows, langid.Trainer(max_fit_rows=60, epochs=1)).langs == ["de", "en"]
    quality.fit(rows, quality.Trainer(max_fit_rows=50, epochs=1))
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, toxic int")
    more = rows.unionAll(rows.withColumn("doc_id", F.lit(8).cast("bigint")))
    toxicity.fit(more, labels, toxicity.Trainer(max_fit_rows=40, updates=2))
    assert 58 <= seen[0] <= 60 and seen[1:] == [50, 80 if k else 40]


def test_held_out_fold(spark):
    import zlib

    got = {r.id: r.h for r in spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}
    assert spark.sql("select cast(null as bigint) k").select(held_out(F.col("k"))).first()[0] is False


@pytest.fixture(scope="module")
def language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.fit(docs.where(~held_out(F.col("doc_id"))))


def test_language_on_held_out_documents(spark):
    rows = langid.op10_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    mine = rows.where("held_out")
    assert mine.count() > 200
    assert mine.where("lang = lang_pred").count() > 0.98 * mine.count()
    assert rows.where("score < 0 or score > 1 or (lang_pred <> 'und' and not accepted and score > 0.5)").count() == 0
    assert rows.where("accepted").count() > 0.99 * rows.count()


def test_language_is_the_same_again(spark, language):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    again = langid.fit(docs.where(~held_out(F.col("doc_id"))).repartition(5))
    assert np.array_equal(again.weights, language.weights) and again.reject_below == language.reject_below


def test_language_odd_cases(spark, language):
    out = langid.identify(odd(spark), language)
    assert out.count() == len(ODD) and [c for c in out.columns if c.lower() == "accepted"] == ["accepted"]
    got = {(r.doc_id, r.text): r for r in out.collect()}
    for key in ((1, None), (2, ""), (3, " \n\t"), (5, "123 !!")):
        assert (got[key].lang_pred, got[key].score, got[key].accepted) == ("und", 0.0, False)
    assert got[7, "über " * 40_000].lang_pred == "de"
    assert got[4, "word"].lang_pred in language.langs
    assert langid.identify(odd(spark).limit(0), language).count() == 0


def test_rare_languages_are_learned(spark):
    rows = [(k, f"some plain english words and the number {k}", "en") for k in range(3000)] + [(3000 + k, f"und noch ein deutscher satz {k}", "de") for k in range(40)] + [(5000 + k, f"zzyx qwrt {k} vbnm", "zz") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, langid.Trainer(max_fit_rows=200))
    assert model.langs == ["de", "en", "zz"]
    quotas = langid.fit_quotas({"en": 10**9, "de": 10**6, "zz": 7}, 3000)
    assert quotas["zz"] == 7 and quotas["de"] > 490 and 2990 < sum(quotas.values()) <= 3000
    assert langid.fit_quotas({"en": 5, "de": 6}, 3000) == {"en": 5, "de": 6}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    rows = spark.createDataFrame([(i, f"some words {i}", x) for i, x in enumerate(["en", "de", "fr", None, "en"])], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.fit(rows)
    assert langid.fit(rows.where("lang <> 'fr'")).langs == ["de", "en"]


def test_language_without_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = langid.fit(none)
    assert {r.lang_pred for r in langid.identify(odd(spark), model).collect()} == {"und"}
    one = spark.createDataFrame([(1, "only one", "xx"), (2, None, "yy"), (3, "no label", None)], none.schema)
    assert {r.lang_pred for r in langid.identify(one, langid.fit(one)).collect()} == {"xx", "und"}


def test_mean_of_hashed_subwords():
    model = langid.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(64, 2)), np.zeros(2))
    text = "Ab, cdé"
    want, n = np.zeros(2), 0
    for buckets, _ in langid.subwords([text.lower()], 64, model.orders):
        for b in buckets:
            want += model.weights[b]
            n += 1
    logits, count = model._logits([text.lower()])
    assert count[0] == n and np.allclose(logits[0], want / n)
    # a text alone and among others
    assert model.score([text]) == [x[1:2] for x in model.score(["zz", text, ""])]


@pytest.fixture(scope="module")
def toxic(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return model, docs, labels


def test_toxicity_on_held_out_documents(toxic):
    model, docs, labels = toxic
    rows = toxicity.classify(docs.join(labels.where(held_out(F.col("doc_id"))), "doc_id"), model).select("toxic", "score", "flagged").toPandas()
    y, p = rows["toxic"] == 1, rows["score"]
    assert y.sum() > 80
    assert ((p >= 0.3) & y).sum() > 0.85 * y.sum()
    assert ((p >= 0.3) & ~y).sum() < 0.03 * (~y).sum()
    assert (rows["flagged"] & y).sum() > 0.85 * y.sum() and (rows["flagged"] & ~y).sum() < 0.05 * (~y).sum()
    assert p.between(0, 1).all()


def test_toxicity_thresholds_by_language(toxic):
    """Each language with texts of both labels has its own, and few of its texts draw it little from the common one."""
    model = toxic[0]
    assert set(model.thresholds) == {"de", "en", "es", "fr"}
    assert all(0.05 <= t <= 0.95 for t in model.thresholds.values())
    trainer, fake = toxicity.Trainer(), toxicity.ToxicityModel(filters=1, out=np.ones(1))
    z = np.r_[np.full(40, 3.0), np.full(40, -3.0), 2.0, -2.9, 0.5, -3.1]
    fake.maxima = lambda rows, begin: rows
    y = np.r_[np.ones(40), np.zeros(40), 1, 0, 1, 0]
    langs = ["en"] * 80 + ["fr"] * 2 + [None] * 2
    trainer._calibrate(fake, [np.array([[v]]) for v in z], y, langs, 0.5)
    own = toxicity.best_threshold(toxicity.sigmoid(fake.platt[0] * z[80:82] + fake.platt[1]), y[80:82])
    assert set(fake.thresholds) == {"en", "fr"}
    assert fake.thresholds["fr"] == pytest.approx(own / 11 + fake.threshold * 10 / 11)


def test_toxicity_convolution_against_loops():
    rng = np.random.default_rng(3)
    n, buckets = 4, 50
    model = toxicity.ToxicityModel(rng.normal(size=(buckets + 1, n * 6)).astype(np.float32), n, rng.normal(size=n * 3).astype(np.float32), rng.normal(size=n * 3))
    model.answers[buckets] = 0
    rows, begin = toxicity.word_rows(["one two, three four", "", "x"], buckets)
    got = model.maxima(rows, begin)
    for d in range(3):
        words = [model.answers[r].sum(0) for r in rows[begin[d] : begin[d + 1]]]
        col = 0
        for i, w in enumerate(toxicity.WIDTHS):
            best = np.full(n, -np.inf)
            for t in range(len(words)):
                best = np.maximum(best, sum((words[t + o][col + o * n : col + (o + 1) * n] for o in range(w) if t + o < len(words)), np.zeros(n)))
            assert np.allclose(got[d, i * n : (i + 1) * n], np.maximum(best + model.bias[i * n : (i + 1) * n], 0), atol=1e-4)
            col += w * n


def test_toxicity_of_a_text_does_not_depend_on_others(toxic):
    texts = ["you are an idiot", "", "a fine day", None, "idiot"]
    assert toxic[0].score(texts)[0] == pytest.approx([toxic[0].score([t])[0][0] for t in texts], abs=1e-6)


def test_toxicity_odd_cases(spark, toxic):
    model = toxic[0]
    out = toxicity.classify(odd(spark), model)
    assert out.count() == len(ODD)
    rows = out.collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    assert toxicity.classify(odd(spark).limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, None, None)], "doc_id bigint, text string, lang string")
    for labels in ([], [(1, 1)], [(1, None), (None, 1), (2, 7)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert {(r.score, r.flagged) for r in toxicity.classify(docs, model).collect()} == {(0.0, False)}


def test_threshold_splits_where_f1_is_highest():
    p, y = np.array([0.9, 0.8, 0.7, 0.2, 0.1]), np.array([1, 1, 0, 0, 0])
    assert toxicity.best_threshold(p, y) == pytest.approx(0.75)


def test_quality_against_labels_never_seen(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.op9_quality(spark, SF)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").toPandas()
    good = rows["quality"] == 1
    assert (rows["keep"] & good).sum() > 0.97 * good.sum()
    assert (~rows["keep"] & ~good).sum() > 0.9 * (~good).sum()


def test_em_finds_accuracies():
    rng = np.random.default_rng(7)
    n, right = 20_000, [0.95, 0.9, 0.8, 0.85, 0.7, 0.9, 0.6, 0.75, 0.9]
    y = rng.random(n) < 0.8
    v = np.zeros((n, len(right)), np.uint8)
    for k, a in enumerate(right):
        hit = rng.random(n) < a
        v[:, k] = np.where(rng.random(n) < 0.3, quality.NONE, np.where(hit == y, quality.GOOD, quality.BAD))
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.03
    assert np.allclose(list(model.accuracy.values()), right, atol=0.03)
    assert ((model.posterior(v) > 0.5) == y).mean() > 0.95


def test_measures_against_loops():
    rng = random.Random(2)
    texts = ["", "one", "A B\nA B\nc. d?\nA B", "x " * 30, "É!! ß$ 12\n\n\n y"] + ["".join(rng.choice("ab AB.\n1 ") for _ in range(80)) for _ in range(40)]
    got = quality.measures(texts)
    for t, m in zip(texts, got, strict=True):
        words, lines = t.split(), [x for x in t.split("\n") if x.split()]
        letters = [c for c in t if c.isalpha()]
        ink = [c for c in t if not c.isspace()]
        want = [
            sum(not c.isalpha() and not c.isdigit() for c in ink) / len(ink) if ink else None,
            sum(c.isupper() for c in letters) / len(letters) if letters else None,
            len(ink) / len(words) if words else None,
            1 - len(set(lines)) / len(lines) if len(lines) >= 4 else None,
            max(map(words.count, words)) / len(words) if len(words) >= 20 else None,
            sum(x.split()[-1][-1] in ".!?…。\"')" for x in lines) / len(lines) if lines else None,
            len(words),
            len(words) / len(lines) if lines else None,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words) if len(words) >= 6 else None,
        ]
        for name, a, b in zip(quality.LABELLERS, m, want, strict=True):
            assert (np.isnan(a) and b is None) or a == pytest.approx(b), (name, t)


def test_quality_odd_cases(spark):
    model = quality.fit(odd(spark))
    rows = quality.assess(odd(spark), model).collect()
    assert len(rows) == len(ODD)
    assert all(r.score == 0 and not r.keep for r in rows if r.doc_id in (1, 2, 3))
    none = odd(spark).limit(0)
    assert quality.assess(none, quality.fit(none)).count() == 0
