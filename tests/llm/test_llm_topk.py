import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import topk


def brute(rows, step, k):
    kept = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, q), q)
    out = []
    for i, q in kept.items():
        if i % step:
            continue
        best = sorted(
            (-sum(a * b for a, b in zip(q, o, strict=True)), j)
            for j, o in kept.items() if j != i and len(o) == len(q)
        )[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, step, k, **sizes):
    df = spark.createDataFrame(
        [(i, v, 0, 1.0) for i, v in rows],
        "vec_id long, embedding array<float>, block int, score double",
    )
    found = topk.top_k(df, F.col("vec_id") % step == 0, k, **sizes)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block_rows,chunk_queries", [(1 << 15, 1 << 10), (30, 7)])
def test_equals_brute_force(spark, block_rows, chunk_queries):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)]) for i in rng.permutation(200)]
    rows += [(300 + i, [0.5] * 6) for i in range(70)]  # ties
    rows += [(400, None), (401, []), (402, [None] * 6), (403, [float("nan")] * 6),
             (404, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (405, [1.0, 2.0]),
             (410, [0.0] * 6), (0, rows[0][1]), rows[1]]
    got = run(spark, rows, 10, 5, block_rows=block_rows, chunk_queries=chunk_queries)
    assert got == brute(rows, 10, 5)


def test_few_rows_and_empty_tables(spark):
    assert run(spark, [(10, [1.0])], 10, 5) == []
    assert run(spark, [(10, [1.0]), (11, [-1.0])], 10, 5) == [(10, 1, 11, -65536)]
    assert run(spark, [], 10, 5) == []


def test_adders_sum_bitmaps():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (23, 128), np.uint8)
    weights = rng.integers(0, 4, 23)
    packed = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    out = topk.add_slices([packed[weights == w] for w in range(4)])
    total = sum(
        np.unpackbits(s.view(np.uint8), bitorder="little").astype(int) << w
        for w, s in enumerate(out)
    )
    assert (total == (bits * (1 << weights)[:, None]).sum(axis=0)).all()


def test_scores_that_do_not_fit_are_an_error(spark):
    def found(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()]

    for x in (1e300, -1e300, 2.0**40):
        with pytest.raises(ValueError, match="64 bits"):
            found([(10, [x, 0.25]), (11, [0.25, 1.0])])
    assert found([(10, [2.0**21, 0.0]), (11, [2.0**20, 1.0])]) == [(10, 1, 11, 2**57)]


def test_ids_of_another_integer_type(spark):
    df = spark.createDataFrame([(10, [1.0]), (11, [2.0])], "vec_id int, embedding array<float>")
    found = topk.top_k(df, F.col("vec_id") % 10 == 0, 5)
    assert [tuple(r) for r in found.collect()] == [(10, 1, 11, 131072)]
