import hashlib
import random

import pytest

from tastegrid.llm import exchange, substring

SCHEMA = "doc_id long, text string, n_words int, keys string"


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, window):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(50)]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [some(rng.choice([window - 1, window, window + 3, 3 * window])) for _ in range(5)]
    texts = []
    for _ in range(40):
        text = some(rng.randrange(2 * window))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        texts.append(" ".join(text))
    texts += [texts[0], texts[1], None, "", " ".join(["x"] * (3 * window)), " ".join(["x"] * 99)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def run(spark, rows, window, least):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA).repartition(4)
    found = substring.remove_repeats(df, window, least)
    return sorted(
        (tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()),
        key=str,
    )


@pytest.mark.parametrize("window,least", [(50, 20), (8, 2), (11, 3)])
def test_equals_brute_force(spark, window, least):
    rows = corpus(window, window)
    assert run(spark, rows, window, least) == brute(rows, window)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(exchange, "RANGE_KEYS", 16)
    rows = corpus(1, 10)
    assert run(spark, rows, 10, 5) == brute(rows, 10)


def test_repeated_ids_null_ids_and_empty_tables(spark):
    text = " ".join(f"t{k}" for k in range(12))
    rows = [(4, text), (4, text), (4, "new " + text), (None, text), (6, text), (8, None)]
    assert run(spark, rows, 8, 4) == brute(rows, 8)
    assert run(spark, [], 8, 4) == []


def test_kept_text_is_null_where_nothing_is_removed(spark):
    text = " ".join(f"t{k}" for k in range(10))
    df = spark.createDataFrame([(1, text), (2, f"a\n{text}  b")], "doc_id long, text string")
    found = {r.doc_id: r.kept_text for r in substring.remove_repeats(df, 8, 4).collect()}
    assert found == {1: None, 2: "a b"}


def test_lengths_double_up_to_the_window():
    assert substring.lengths(50) == [25, 50]
    assert substring.lengths(200) == [25, 50, 100, 200]
    assert substring.lengths(11, 3) == [3, 6, 11]
