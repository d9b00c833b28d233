import hashlib
import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm import sharding

SCHEMA = "doc_id long, text string, shard string, size int"


def run(spark, rows, shards=4):
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(3)
    return sharding.shard_documents(df, shards).collect()


def check(rows, found, shards):
    texts = dict(rows)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert 0 <= r.shard < shards
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r)
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    by_text = {}
    for r in found:
        by_text.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_groups_stay_whole_and_sizes_are_near(spark):
    rng = np.random.default_rng(0)
    rows = [(k, "x" * int(rng.integers(1, 300)) + str(k)) for k in range(400)]
    rows += [(1000 + k, "copy " * 10) for k in range(60)]
    rows += [(2000, None), (2001, ""), (2002, None)]
    found = run(spark, rows)
    check(rows, found, 4)
    sizes = [sum(r["size"] for r in found if r.shard == s) for s in range(4)]
    group = 60 * (50 + 16)
    assert max(sizes) - min(sizes) <= group
    assert max(sizes) <= sum(sizes) / 4 + group


def test_one_group_of_a_third_of_the_rows(spark):
    rows = [(k, "the same text, again and again") for k in range(200)]
    rows += [(500 + k, f"text number {k}") for k in range(400)]
    found = run(spark, rows, 6)
    check(rows, found, 6)


def test_few_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a"), (2, "b")]
    check(rows, run(spark, rows, 40), 40)
    found = run(spark, [(None, "a"), (None, "a"), (3, "a")])
    assert sorted(r.slot for r in found) == [0, 1, 2]
    assert run(spark, []) == []


def best_capacity(sizes, shards):
    best = sum(sizes)
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), shards - 1):
        edges = [0, *cuts, len(sizes)]
        best = min(best, max(sum(sizes[a:b]) for a, b in itertools.pairwise(edges)))
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=8), st.integers(1, 4))
def test_smallest_capacity(sizes, shards):
    capacity, starts = sharding.shard_starts(np.array(sizes, np.int64), shards)
    assert capacity == best_capacity(sizes, shards)
    edges = [*starts.tolist(), len(sizes)]
    assert edges == sorted(edges) and edges[0] == 0 and len(starts) == shards
    assert all(sum(sizes[a:b]) <= capacity for a, b in itertools.pairwise(edges))


@pytest.mark.parametrize("parts", [1, 5])
def test_group_runs_over_partitions(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = [(k, "one text") for k in range(50)] + [(100, "b"), (101, "c")]
        check(rows, run(spark, rows, 3), 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("resolution,finer", [(1, 2), (3, 8), (20, 64)])
def test_capacity_and_cuts_are_those_of_all_groups(monkeypatch, resolution, finer):
    monkeypatch.setattr(sharding, "RESOLUTION", resolution)
    monkeypatch.setattr(sharding, "FINER", finer)
    draw = np.random.default_rng(resolution)
    for _ in range(200):
        n, shards = draw.choice([1, 2, 5, 30, 300]), int(draw.choice([1, 2, 3, 7, 40]))
        sizes = np.where(draw.random(n) < 0.2, draw.integers(16, 9000, n), draw.integers(16, 90, n))
        ends = np.cumsum(sizes)
        starts, total = ends - sizes, int(ends[-1])

        def cells(step, within, coarse, starts=starts, total=total):
            some = starts if within is None else starts[np.isin(starts // coarse, within)]
            cell, first = np.unique(some // step, return_index=True)
            last = np.append(first[1:], len(some)) - 1
            assert len(cell) <= max(shards * resolution + 1, 40 * shards * shards * finer)
            return sharding.Starts(some[first], some[last], total)

        capacity, cuts = sharding.exact_cuts(cells, shards, total)
        assert capacity == sharding.shard_starts(sizes, shards)[0]
        edges = [0, *cuts, total]
        assert len(cuts) == shards - 1 and edges == sorted(edges)
        assert set(cuts) <= {*starts.tolist(), total}
        assert max(b - a for a, b in itertools.pairwise(edges)) <= capacity


def test_largest_shard_of_a_table_is_the_least_possible(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RESOLUTION", 2)
    monkeypatch.setattr(sharding, "FINER", 4)
    rng = np.random.default_rng(5)
    rows = [(k, f"{k} " + "y" * int(rng.integers(0, 400))) for k in range(900)]
    rows += [(5000 + k, "many copies " * 20) for k in range(40)]
    found = run(spark, rows, 7)
    check(rows, found, 7)
    texts = dict(rows)
    groups = {}
    for _, text in rows:
        key = hashlib.md5(text.encode()).hexdigest()
        groups[key] = groups.get(key, 0) + len(text.encode()) + 16
    sizes = np.array([groups[k] for k in sorted(groups)], np.int64)
    by_shard = np.bincount([r.shard for r in found], [r["size"] for r in found])
    assert by_shard.max() == sharding.shard_starts(sizes, 7)[0]
    order = sorted(found, key=lambda r: (r.shard, r.slot))
    keys = [hashlib.md5(texts[r.doc_id].encode()).hexdigest() for r in order]
    assert keys == sorted(keys)


def test_a_very_long_text(spark):
    rows = [(1, "long " * 400_000), (2, "b"), (3, "c"), (4, "d" * 1000)]
    check(rows, run(spark, rows, 3), 3)
