import random
import time

import numpy as np
import pytest

from tastegrid.llm import exchange, ngram_join
from tastegrid.llm.components import components

SCHEMA = "doc_id long, text string, component_id string, print string"


def brute(rows, length, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        grams = {tuple(w[k : k + length]) for k in range(len(w) - length + 1)}
        sets[i] = grams or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in ids}


def corpus(seed=0):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 90]))]
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    shared = " ".join(rng.choice(words) for _ in range(30))
    texts += [f"{shared} {' '.join(rng.choice(words) for _ in range(n))}" for n in (4, 6, 9, 60)]
    texts += [None, "", " \t ", "one", "ONE", "one two", "a\x1cb c d e", "a\x1cb c d e"]
    rng.shuffle(texts)
    return [(10 + 3 * k, t) for k, t in enumerate(texts)]


def run(spark, rows, length, percent):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    found = ngram_join.jaccard_components(df, length, percent)
    return [tuple(r) for r in found.select("doc_id", "n_grams", "component_id").collect()]


@pytest.mark.parametrize("length,percent", [(4, 85), (5, 80)])
def test_components_equal_brute_force(spark, length, percent):
    rows = corpus(percent)
    assert set(run(spark, rows, length, percent)) == brute(rows, length, percent)


def test_split_groups_and_many_ranges_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK_GRAMS", 150)
    monkeypatch.setattr(exchange, "RANGE_KEYS", 64)
    rows = corpus(7)
    assert set(run(spark, rows, 4, 85)) == brute(rows, 4, 85)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "a b c d e f"
    found = run(spark, [(5, text), (5, text), (None, text), (7, text), (9, None)], 4, 85)
    assert sorted(found, key=str) == sorted(
        [(5, 3, 5), (5, 3, 5), (None, 3, 5), (7, 3, 5), (9, 0, 9)], key=str
    )
    assert run(spark, [], 4, 85) == []


def test_prefix_keeps_a_shared_gram_for_every_linked_pair():
    # sizes of linked sets: what each side leaves out is less than what they share
    for size in range(1, 400):
        for percent in (80, 85):
            least = ngram_join.least_overlap(size, percent)
            assert 1 <= ngram_join.spare(least) <= ngram_join.spare(size) <= max(least, 1)
            assert 100 * least >= percent * size > 100 * (least - 1)


def test_trie_joins_runs_and_walks():
    sets = [np.array(s, np.uint32) for s in ([1, 2, 3], [1, 2, 3, 4], [1, 2, 9], [5])]
    trie = ngram_join.Trie(sets)
    assert sorted(zip(trie.low.tolist(), trie.high.tolist(), strict=True)) == [
        (0, 2), (0, 3), (0, 4), (1, 2), (2, 3), (3, 4)
    ]
    grams = [s.astype(np.uint64) for s in sets]
    links = ngram_join.link_group(
        grams, np.array(list("abcd"), object), np.ones(4, bool), 75
    )
    assert {frozenset(p) for p in links} == {frozenset((0, 1))}


@pytest.mark.parametrize("seed", range(6))
def test_links_of_a_group_connect_what_brute_force_links(seed):
    rng = np.random.default_rng(seed)
    base = rng.choice(5000, 120, replace=False)
    sets = []
    for _ in range(40):
        own = base.copy()
        changed = rng.integers(0, 14)
        own[rng.choice(120, changed, replace=False)] = 5000 + rng.integers(0, 400, changed)
        sets.append(np.unique(own[: rng.integers(90, 121)]).astype(np.uint64))
    sets += [np.unique(rng.choice(5000, 3)).astype(np.uint64) for _ in range(5)]
    sets = list({s.tobytes(): s for s in sets}.values())
    asks = np.ones(len(sets), bool) if seed % 2 else rng.random(len(sets)) < 0.4
    links = ngram_join.link_group(sets, np.arange(len(sets)).astype(str), asks, 85)

    def classes(pairs):
        part = list(range(len(sets)))
        for a, b in pairs:
            part = [part[a] if p == part[b] else p for p in part]
        return {frozenset(i for i in range(len(sets)) if part[i] == p) for p in part}

    wanted = [
        (a, b) for a in range(len(sets)) for b in range(a)
        if (asks[a] or asks[b]) and 100 * len(np.intersect1d(sets[a], sets[b]))
        >= 85 * len(np.union1d(sets[a], sets[b]))
    ]
    assert all((max(p), min(p)) in wanted for p in links)
    assert classes(links) == classes(wanted)


def test_components_of_chains_and_stars(spark):
    edges = [(f"{a:03d}", f"{a + 1:03d}") for a in range(40)]
    edges += [("900", f"{a}") for a in range(901, 930)] + [("x", "x"), ("901", "900")]
    found = dict(components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert {found[f"{a:03d}"] for a in range(41)} == {"000"}
    assert {found[f"{a}"] for a in range(900, 930)} == {"900"}
    assert "x" not in found
    empty = components(spark.createDataFrame([], "a string, b string"))
    assert empty.collect() == []


def _root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


@pytest.mark.parametrize("looser", [0, 1, 8])
@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_any_group_is_connected_as_by_all_pairs(monkeypatch, percent, looser):
    monkeypatch.setattr(ngram_join, "LOOSER", looser)
    draw = random.Random(percent + looser)
    for _ in range(60):
        universe = draw.choice([12, 40])
        bases = [set(draw.sample(range(universe), draw.randint(1, universe - 2))) for _ in range(4)]
        sets = set()
        for _ in range(draw.randint(2, 40)):
            one = set(draw.choice(bases))
            for _ in range(draw.randint(0, 3)):
                one ^= {draw.randrange(universe)}
            if one:
                sets.add(frozenset(one))
        sets = list(sets)
        n = len(sets)
        roots = [draw.randrange(n) if draw.random() < 0.2 else 1000 + i for i in range(n)]
        asks = [draw.random() < 0.7 or percent == 85 for _ in range(n)]
        wanted = list(range(n))
        for i in range(n):
            for j in range(i):
                if roots[i] == roots[j]:
                    wanted[_root(wanted, i)] = _root(wanted, j)
        got = list(wanted)
        links = ngram_join.link_group(
            [np.array(sorted(s), np.uint64) for s in sets], np.array(roots), np.array(asks), percent)
        for x, y in links:
            assert 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
            got[_root(got, x)] = _root(got, y)
        for i in range(n):
            for j in range(i):
                if (asks[i] or asks[j]) and (
                    100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
                ):
                    wanted[_root(wanted, i)] = _root(wanted, j)
        a, b = ([_root(p, i) for i in range(n)] for p in (wanted, got))
        assert [[x == y for y in a] for x in a] == [[x == y for y in b] for x in b]


def test_a_common_gram_does_not_bring_a_group_together():
    """130,000 sets that share one gram: the work follows what else they share."""
    rng = np.random.default_rng(0)
    sets = [np.unique(np.append(rng.integers(10, 2**63, 7), 5)).astype(np.uint64)
            for _ in range(130_000)]
    sets[70_000] = np.unique(np.append(sets[9], np.uint64(6))).astype(np.uint64)  # 8 of 9 in common
    began = time.perf_counter()
    links = ngram_join.link_group(sets, np.arange(len(sets)), np.ones(len(sets), bool), 85)
    assert [sorted(x) for x in links] == [[9, 70_000]]
    assert time.perf_counter() - began < 20


def test_sets_too_small_to_be_linked_are_not_looked_at(spark):
    """Up to five grams nothing but an equal set is within 85 hundredths."""
    rows = [(k, " ".join(["same", "old", "words", "here"] + [f"w{k}"] * (k % 2))) for k in range(40)]
    rows += [(100, "a b c d e f g h i"), (101, "a b c d e f g h i j")]  # 6 of 7
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, 4, 85).collect()}
    assert {got[k] for k in range(0, 40, 2)} == {0} and got[101] == got[100] == 100
    assert all(got[k] == k for k in range(1, 40, 2))
