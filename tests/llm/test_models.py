"""Operators 5 and 8: held-out accuracy, what is learned from, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimwright.llm import language, quality

SF = "/root/testdata/sf0.1"


def bucket(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / ones / (len(label) - ones)


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, quality.quality(docs, labels).cache()


def test_quality_on_held_out_rows(judged):
    docs, labels, scores = judged
    rows = scores.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r.held_out == (bucket(r.doc_id, 3) == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    label = np.array([r.quality for r in held])
    assert auc(np.array([r.score for r in held]), label) > 0.98
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert scores.count() == docs.count()


def test_held_out_labels_and_other_columns_change_nothing(judged):
    docs, labels, scores = judged
    lies = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = quality.quality(other, lies)
    assert scores.join(again.withColumnRenamed("score", "s"), "doc_id").filter("score <> s").count() == 0


def test_few_learned_rows_suffice_and_the_bound_holds(judged):
    docs, labels, scores = judged
    model = quality.learn(docs, labels, ~quality.held_out(), per_label=60)
    again = quality.scored(docs, model).join(labels, "doc_id").filter(quality.held_out()).select("score", "quality").toArrow()
    assert auc(again["score"].to_numpy(), again["quality"].to_numpy()) > 0.97


def test_ranking_minimises_the_pairwise_loss():
    """At the optimum the gradient of the mean logistic loss over the pairs vanishes, here by finite differences."""
    rng = np.random.default_rng(1)
    x, label = rng.normal(size=(300, len(quality.FEATURES))), rng.integers(0, 2, 300)
    x[:, 3] += 2 * label
    x[:, -1] = 1
    model = quality.fit(x, label, ridge=0.1)
    good, poor = quality.standard(x[label == 1], model.mean, model.spread), quality.standard(x[label == 0], model.mean, model.spread)
    n = 8 * max(len(good), len(poor))
    draw = np.random.default_rng(5)
    i, j = (np.concatenate([draw.permutation(len(a)) for _ in range(-(-n // len(a)))])[:n] for a in (good, poor))

    def loss(w):
        return np.log1p(np.exp(-(good[i] - poor[j]) @ w)).mean() + 0.05 * w @ w

    for k in range(5):
        e = np.zeros(len(model.weights))
        e[k] = 1e-5
        assert abs(loss(model.weights + e) - loss(model.weights - e)) / 2e-5 < 1e-5
    assert abs((model.ranked(x) < model.threshold).mean() - (label == 0).mean()) < 0.01


def test_quality_of_odd_rows(spark, odd, odd_rows, nothing):
    labels = spark.createDataFrame([(10, 1), (11, 0), (12, 1), (13, None), (None, 0), (7, 0), (2, 1), (1, 0), (10, 0), (8, 1)], "doc_id bigint, quality int")
    rows = quality.quality(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out is not None for r in rows)
    assert quality.accepted(odd, labels).columns == odd.columns
    assert quality.accepted(odd, labels).count() == sum(r.predicted for r in rows)
    assert quality.quality(nothing, labels).collect() == [] and quality.accepted(nothing, labels).collect() == []
    for none in (labels.limit(0), labels.filter("quality = 1")):
        assert {(r.score, r.predicted) for r in quality.quality(odd, none).collect()} == {(0.5, 1)}


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (bucket(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    lies = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    sample = docs.filter("doc_id < 500")
    models = [language.learn(d, ~language.held_out(), per_language=50) for d in (docs, lies)]
    both = [{r.doc_id: (r.lang_pred, r.score) for r in language.predicted(sample, m).collect()} for m in models]
    assert both[0] == both[1]


def test_family_comes_first_then_pairs():
    rng = random.Random(2)
    syllables = {"en": "th ing wh ly", "de": "sch ung ich ß", "fr": "eau ou ç é", "es": "ción ll ñ ó", "ru": "ста ов ий", "xx": "qz zq kx"}
    texts = [(lang, " ".join("".join(rng.choice(s.split()) for _ in range(3)) for _ in range(30))) for lang, s in syllables.items() for _ in range(30)]
    x = np.stack([language.features(t) for _, t in texts])
    model = language.fit(x, [a for a, _ in texts])
    assert model.families == {"germanic": ("de", "en"), "romance": ("es", "fr"), "slavic": ("ru",), "xx": ("xx",)}
    assert set(model.of_family) == set(model.families) and set(model.of_pair) == {("de", "en"), ("es", "fr")}
    found, score = model.predict(x)
    assert found == [a for a, _ in texts] and (score > 0.5).all()


def test_languages_of_odd_rows(odd, odd_rows, nothing):
    rows = language.languages(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)
    for r in rows:
        texts = [t for d, t, *_ in odd_rows if d == r.doc_id]
        lettered = {t is not None and any(c.isalpha() for c in t) for t in texts}
        if len(lettered) == 1:
            assert (r.lang_pred == "und") != lettered.pop()
        assert 0 <= r.score <= 1 and r.held_out is not None
    assert language.languages(nothing).collect() == []
    unnamed = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.languages(unnamed).collect()} == {("und", 0.0)}
    one = odd.withColumn("lang", F.lit("nl"))
    assert {r.lang_pred for r in language.languages(one).collect()} == {"und", "nl"}


def arriving(monkeypatch, module, learn):
    """Rows that a learner is given."""
    seen, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda x, label, **kw: seen.extend(map(str, label)) or fit(x, label, **kw))
    learn()
    return seen


def test_one_id_on_a_third_of_all_rows_stays_one_row(spark, documents, monkeypatch):
    rng = random.Random(3)
    rows = [(7, f"Hot text number {i % 40} of many.", "en") for i in range(400)]
    rows += [(i, " ".join(rng.choice(["wort", "und", "the", "house"]) for _ in range(30)), rng.choice(["en", "de"])) for i in range(10, 800)]
    docs = documents(rows, 6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(800)] + [(7, 1)] * 50, "doc_id bigint, quality int")
    seen = arriving(monkeypatch, quality, lambda: quality.learn(docs, labels, F.lit(True), per_label=40))
    assert {c: seen.count(c) for c in "01"} == {"0": 40, "1": 40}
    seen = arriving(monkeypatch, language, lambda: language.learn(docs, F.lit(True), per_language=30))
    assert {c: seen.count(c) for c in ("en", "de")} == {"en": 30, "de": 30}
    # The row that stands for an id does not depend on the order of rows.
    models = [quality.learn(d, labels, F.lit(True), per_label=600) for d in (docs, documents(rows[::-1], 3))]
    assert np.allclose(models[0].weights, models[1].weights) and models[0].threshold == pytest.approx(models[1].threshold)


@pytest.mark.parametrize("zeros, ones", [(2_600, 4_400), (9, 4_400), (4_400, 300)])
def test_every_labelled_row_is_learned_from(spark, documents, monkeypatch, zeros, ones):
    """More rows of a label than one block holds, and in one case another label that is too rare for every block."""
    rng = random.Random(zeros)
    words = {0: ["##", "BUY", "now!!", "word", "a", "|", "house", "777"], 1: ["house", "a", "the", "word", "walks", "now!!", "river.", "BUY"]}
    rows = [(i, " ".join(rng.choice(words[int(i >= zeros)]) for _ in range(rng.randrange(3, 30)))) for i in range(zeros + ones)]
    rows += [(5, "The same id, another text."), (5, "The same id, another text.")]
    docs, labels = documents(rows), spark.createDataFrame([(i, int(i >= zeros)) for i in range(zeros + ones)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality, "FOLDS", 3)
    model = quality.learn(docs, labels, F.lit(True))
    x = np.array([quality.features(t) for _, t in dict.fromkeys(rows)])
    label = np.array([int(i >= zeros) for i, _ in dict.fromkeys(rows)])
    assert np.allclose(model.mean, x.mean(axis=0), rtol=1e-9) and np.allclose(model.spread, quality.level(x.std(axis=0)), rtol=1e-9)
    whole = quality.fit(x, label)
    assert np.corrcoef(model.ranked(x), whole.ranked(x))[0, 1] > 0.98
    assert abs(auc(model.ranked(x), label) - auc(whole.ranked(x), label)) < 0.01
    # The threshold is one of the scores, that at label 0's share of the labels.
    z = np.sort(model.ranked(x))
    each = np.where(label == 0, zeros / (label == 0).sum(), 1)[np.argsort(model.ranked(x), kind="stable")]
    assert model.threshold == pytest.approx(z[np.searchsorted(np.cumsum(each) / each.sum(), zeros / (zeros + ones))], abs=1e-9)
    again = quality.learn(documents(rows[::-1], 2), labels, F.lit(True))
    assert (again.weights == model.weights).all() and again.threshold == model.threshold


def test_bits_are_in_the_order_of_the_numbers():
    z = np.array([-np.inf, -3.5, -1e-300, 0.0, 2e-308, 0.7, 0.7000000000000001, 1e300])
    bits = quality.ordered_bits(z)
    assert (bits[1:] > bits[:-1]).all() and [quality.from_ordered_bits(int(b)) for b in bits] == z.tolist()


def plain_margin(x, machine):
    return sum(float(a) * float(b) for a, b in zip(x, machine.weights) if a) + machine.offset


def plain_language(text, model):
    """Family of the largest margin, then one vote per pair of its languages; shares of votes settle ties."""
    if text is None or not any(c.isalpha() for c in text):
        return "und"
    x = language.features(text)
    family = max(sorted(model.families), key=lambda f: plain_margin(x, model.of_family[f])) if model.of_family else next(iter(model.families))
    members = model.families[family]
    points = dict.fromkeys(members, 0.0)
    for a in members:
        for b in members:
            if (a, b) in model.of_pair:
                m = plain_margin(x, model.of_pair[a, b])
                points[a if m > 0 else b] += 1
                points[a] += math.tanh(m) / (2 * len(members))
                points[b] -= math.tanh(m) / (2 * len(members))
    return max(members, key=lambda a: points[a])


def test_predictions_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs, ~language.held_out())
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.lang_pred for r in language.predicted(docs, model).collect()}
    assert got == {d: plain_language(t, model) for d, t in texts.items()}
