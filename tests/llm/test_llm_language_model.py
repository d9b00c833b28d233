import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm import exchange, language_model
from tastegrid.llm.elias_fano import EliasFano

SCHEMA = "doc_id long, text string, train boolean, score string, block int"


def brute(rows):
    count, pairs = Counter(), Counter()
    tokens = [(i, (t or "").encode().lower().split() + [None], bool(train) and i is not None)
              for i, t, train in rows]
    for _, words, train in tokens:
        if train:
            count.update(words)
            pairs.update(zip(["^", *words[:-1]], words, strict=True))
    n, kinds = sum(count.values()), len(count)
    after = Counter(a for a, _ in pairs)
    before = count + Counter({"^": count[None]})
    out = []
    for i, words, _ in tokens:
        base = [math.log10((count[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in words]
        score = 0
        for a, w, b in zip(["^", *words[:-1]], words, base, strict=True):
            chance = 10**b
            if before[a]:
                chance *= 0.75 * after[a] / before[a]
                chance += max(pairs[a, w] - 0.75, 0) / before[a]
            score += math.log10(chance)
        out.append((i, len(words), sum(count[w] > 0 for w in words), n, sum(base), score))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "s", 0) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in language_model.score_documents(df).collect()), key=str)


def same(found, wanted):
    assert [f[:4] for f in found] == [w[:4] for w in wanted]
    for f, w in zip(found, wanted, strict=True):
        assert f[4] == pytest.approx(w[4])
        assert abs(f[5] - w[5]) <= 0.5 / language_model.STEPS * w[1] + 1e-9


def corpus():
    rng = np.random.default_rng(5)
    words = np.array([f"W{k}" for k in range(60)])
    chance = 1 / np.arange(1, 61)
    rows = []
    for k in range(80):
        text = " ".join(rng.choice(words, rng.integers(1, 40), p=chance / chance.sum()))
        rows.append((k, text, bool(k % 5)))
    rows += [(100, None, True), (101, "", False), (102, "unseen words here", False),
             (103, "w1 \x1c w2", None), (None, "w1 w2 w3", True), (7, rows[7][1], True),
             (104, "only " * 700, True)]
    return rows


def test_equals_brute_force(spark):
    same(run(spark, corpus()), brute(corpus()))


def test_split_words_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(exchange, "RANGE_KEYS", 64)
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 300)
    same(run(spark, corpus()), brute(corpus()))


def test_nothing_to_learn_from(spark):
    rows = [(1, "a b", False), (2, None, None)]
    same(run(spark, rows), brute(rows))
    assert run(spark, []) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=80, unique=True), st.integers(0, 3))
def test_elias_fano(values, extra):
    values = np.array(sorted(values), np.uint64)
    universe = int(values.max(initial=0)) + 1 + 1000 * extra
    sequence = EliasFano(values, universe)
    assert (sequence.at(np.arange(len(values))) == values).all()
    asked = np.arange(min(universe, 6000), dtype=np.uint64)
    at = sequence.find(asked, np.zeros(len(asked), np.int64), np.full(len(asked), len(values)))
    wanted = {int(v): k for k, v in enumerate(values)}
    assert at.tolist() == [wanted.get(int(a), -1) for a in asked]


def test_a_run_of_pointers_may_repeat():
    pointers = np.array([0, 0, 0, 4, 4, 9, 9], np.uint64)
    assert (EliasFano(pointers, 10).at(np.arange(7)) == pointers).all()
