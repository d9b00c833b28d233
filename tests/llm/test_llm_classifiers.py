import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import language_id, toxicity

SYLLABLES = {"aa": "ba be bo du", "bb": "kri stu plo", "cc": "öm ün äl", "dd": "xyz wov qua"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split(), 3)) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = np.random.default_rng(0)
    return [(prose(rng, lang, 12), lang) for lang in SYLLABLES for _ in range(30)]


@pytest.fixture(scope="module")
def model(spark, labelled):
    rows = [*labelled, (None, "aa"), ("text without label", None), ("", "aa")]
    return language_id.train(spark.createDataFrame(rows, "text string, lang string"))


def test_held_out_accuracy(spark, model):
    rng = np.random.default_rng(1)
    rows = [(k, prose(rng, lang, 8), lang) for k, lang in enumerate(list(SYLLABLES) * 20)]
    found = language_id.predict(
        spark.createDataFrame(rows, "doc_id long, text string, score string"), model
    )
    known = {i: lang for i, _, lang in rows}
    found = found.collect()
    assert len(found) == len(rows)
    assert np.mean([r.lang_pred == known[r.doc_id] for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_no_letter_is_unknown(spark, model, labelled):
    rows = [(1, None), (2, ""), (3, " 12 34 !"), (4, labelled[0][0]), (4, labelled[0][0]),
            (5, "é"), (None, "a" * 100_000)]
    found = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model)
    found = found.collect()
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3}
    assert all(r.score == 0 and r.ambiguous for r in found if r.lang_pred == "und")
    assert sum(r.doc_id == 4 and r.lang_pred == "aa" for r in found) == 2
    kept = language_id.keep_told(
        spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double"),
        model,
    )
    assert kept.columns == ["doc_id", "text", "score"]
    assert sum(r.doc_id == 4 for r in kept.collect()) == 2


@pytest.mark.parametrize("langs", [[], ["aa"], ["aa", "bb"]])
def test_few_languages(spark, langs):
    rng = np.random.default_rng(2)
    rows = [(prose(rng, lang, 10), lang) for lang in langs for _ in range(5)]
    small = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    asked = [(k, prose(rng, lang, 10)) for k, lang in enumerate(langs or ["aa"])]
    found = language_id.predict(spark.createDataFrame(asked, "doc_id long, text string"), small)
    assert [r.lang_pred for r in found.orderBy("doc_id").collect()] == (langs or ["und"])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 20])
def test_codewords_differ(n):
    codes = language_id.code_matrix(n)
    assert codes.shape[0] == n and len({tuple(c) for c in codes}) == n
    if n > 1:
        assert all(len(set(bit)) == 2 for bit in codes.T)


def plain_grams(text):
    raw = [b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32
           for b in text.lower().encode()]
    out = []
    for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
        out.append(((((a << 16) | (b << 8) | c) * 0x9E3779B1) % 2**32) >> 16)
    return out


def test_scores_are_those_of_a_plain_model(spark, labelled, model):
    """Counts, log ratios, trust and distances written with loops over single n-grams."""
    languages = sorted(SYLLABLES)
    size, smooth = language_id.FEATURES, language_id.SMOOTHING
    rows = [*labelled, ("", "aa")]
    counts = {lang: {} for lang in languages}
    for text, lang in rows:
        for g in plain_grams(text):
            counts[lang][g] = counts[lang].get(g, 0) + 1

    def share(lang, g):
        return (counts[lang].get(g, 0) + smooth) / (sum(counts[lang].values()) + smooth * size)

    codes = language_id.code_matrix(4)
    bits = codes.shape[1]

    def margin(text, bit):
        found = plain_grams(text)
        total = 0.0
        for g in found:
            sides = [[share(x, g) for x, c in zip(languages, codes[:, bit], strict=True) if c == s]
                     for s in (1, -1)]
            total += math.log(np.mean(sides[0]) / np.mean(sides[1]))
        return total / math.sqrt(len(found)) if found else 0.0

    right = {lang: [0] * bits for lang in languages}
    n = dict.fromkeys(languages, 0)
    for text, lang in rows:
        n[lang] += 1
        for b in range(bits):
            right[lang][b] += margin(text, b) * codes[languages.index(lang), b] > 0
    trust = {}
    for lang in languages:
        raw = [(right[lang][b] + 1) / (n[lang] + 2) for b in range(bits)]
        trust[lang] = [x / sum(raw) for x in raw]
    rng = np.random.default_rng(8)
    texts = [prose(rng, lang, k) for k in (1, 2, 5) for lang in languages] + ["Ba KRI, öm!", "zzz"]
    found = language_id.predict(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), model)
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    for k, text in enumerate(texts):
        loss = {
            lang: sum(trust[lang][b] * math.log1p(math.exp(-margin(text, b) * codes[i, b]))
                      for b in range(bits)) for i, lang in enumerate(languages)
        }
        best, second = sorted(loss, key=loss.get)[:2]
        assert got[k][0] == best
        assert got[k][1] == pytest.approx(loss[second] / (loss[best] + loss[second]), rel=1e-4)


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert language_id.predict(none, model).collect() == []
    assert language_id.keep_told(none, model).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).collect() == []


def test_very_long_texts(spark, model):
    rng = np.random.default_rng(3)
    docs = spark.createDataFrame(
        [(1, " ".join([prose(rng, "bb", 50)] * 4_000)), (2, "x")], "doc_id long, text string")
    assert language_id.predict(docs, model).collect()[0].lang_pred == "bb"
    fitted = toxicity.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert [0 <= r.score <= 1 for r in toxicity.score(docs, fitted).collect()] == [True, True]


def test_grams_stay_inside_texts():
    found, counts = language_id.grams(pa.array(["abcd", "", "ab", None, "x", "abc"]))
    assert counts.tolist() == [2, 0, 0, 0, 0, 1]
    assert found[0] == found[2] and len(found) == 3


def toxic_rows(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        text = prose(rng, "aa", int(rng.integers(20, 60)))
        toxic = k % 4 == 0
        if toxic:
            text += " Insult! " + prose(rng, "bb", 10)
        rows.append((k, text, int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    train = toxic_rows(0, 300)
    docs = spark.createDataFrame(
        [r[:2] for r in train] + [(900, None), (901, "x")], "doc_id long, text string"
    )
    labels = spark.createDataFrame(
        [(r[0], r[2]) for r in train] + [(901, None), (None, 1), (900, 1), (5000, 1)],
        "doc_id long, toxic int",
    )
    fitted = toxicity.train(docs, labels)
    rows = toxic_rows(1, 200)
    asked = [(*r[:2], 9) for r in rows] + [(1000, None, 9), (1001, "", 9), (3, rows[3][1], 9)]
    found = toxicity.score(
        spark.createDataFrame(asked, "doc_id long, text string, predicted int"), fitted
    ).collect()
    assert len(found) == len(asked)
    by_id = {r.doc_id: r for r in found}
    right = [by_id[i].predicted == toxic for i, _, toxic in rows]
    assert np.mean(right) > 0.97
    assert by_id[1000].score == by_id[1001].score < 0.7
    assert all(r.predicted == (r.score >= 0.7) for r in found)


def test_one_training_row_for_each_id(spark, monkeypatch):
    got = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda rows: got.extend(rows) or fit(rows))
    texts = [f"text number{k} words" for k in range(50)]
    docs = spark.createDataFrame(
        [(1, t) for t in texts * 4] + [(2, "other"), (3, None), (2, None)],
        "doc_id long, text string",
    ).repartition(3)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    least = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    own, _ = toxicity.terms(pa.array([least]))
    assert [label for _, label in got] == [0, 1]
    assert got[0][0].tolist() == own.tolist()


def test_toxicity_with_one_label_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for rows in ([], [(1, 0), (2, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        found = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert len(found) == 2 and all(0 <= r.score <= 1 for r in found)


def test_factors_learn_a_pair():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        has = rng.integers(0, 2, 2)
        terms = np.flatnonzero([has[0], has[1], 1]).astype(np.int32)
        rows.append((terms, int(has[0] and has[1])))
    fitted = toxicity.fit(rows)
    score, _ = toxicity.raw_scores(
        fitted, np.array([0, 1, 2, 0, 2, 1, 2], np.int32), np.array([3, 2, 2])
    )
    assert score[0] > 0 > max(score[1:])


def pair_rows(seed, n, insults):
    """Terms 0 and 1 are in half of the texts of each label, alone only in clean ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        found = set((rng.zipf(1.3, 40) % 2000 + 10).tolist())
        both = bool(rng.integers(2))
        if k % 2:
            found |= {0, 1} if both else {int(rng.integers(2, 5))} if insults else set()
        else:
            found.add(int(both))
        rows.append((np.array(sorted(found), np.int32), k % 2))
    return rows


@pytest.mark.parametrize("insults", [True, False])
def test_pair_of_terms_that_are_equally_common_with_each_label(insults):
    fitted = toxicity.fit(pair_rows(1, 1500, insults))
    asked = pair_rows(2, 600, insults)
    score, _ = toxicity.raw_scores(
        fitted, np.concatenate([t for t, _ in asked]), np.array([len(t) for t, _ in asked])
    )
    toxic = 1 / (1 + np.exp(-score)) >= toxicity.TOXIC
    pair = np.array([{0, 1} <= set(t.tolist()) for t, _ in asked])
    clean = np.array([not label for _, label in asked])
    assert toxic[pair].mean() > 0.95 and toxic[clean].mean() < 0.02


def test_raw_score_counts_pairs():
    rng = np.random.default_rng(1)
    fitted = toxicity.Model(0.5, rng.normal(size=9), rng.normal(size=(9, 3)))
    terms = [np.array([1, 4, 7]), np.array([], int), np.array([0])]
    score, _ = toxicity.raw_scores(
        fitted, np.concatenate(terms).astype(int), np.array([len(t) for t in terms])
    )
    for t, s in zip(terms, score, strict=True):
        pairs = sum(
            fitted.factors[a] @ fitted.factors[b] for a in t.tolist() for b in t.tolist() if a < b
        )
        assert s == pytest.approx(0.5 + fitted.weights[t].sum() + pairs)
