import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm import periodic_runs as P
from tastegrid.llm.queries import op12_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plainly(words, min_length=6, min_exponent=4):
    """(start, length, period) of every run: each period is tried at every place."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if j > i and len(run) >= max(min_length, min_exponent * q) and not any(
                run[p:] == run[:-p] for p in range(1, q)
            ):
                out.append((i, len(run), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_in(texts, *limits):
    """Runs of each list of words, all in one call."""
    codes, last, offsets = [], [], []
    for words in texts:
        offsets.append(len(codes))
        last += [len(codes) + len(words)] * (len(words) + 1)
        codes += [*(w + 1 for w in words), 0]
    runs = P.find_runs(np.array(codes, np.int64), np.array(last, np.int64), *limits).tolist()
    ends = [*offsets[1:], len(codes)]
    return [[(s - a, n, q) for s, n, q in runs if a <= s < b]
            for a, b in zip(offsets, ends, strict=True)]


few = st.lists(st.integers(0, 2), max_size=40)
periodic = st.tuples(few, st.lists(st.integers(0, 3), min_size=1, max_size=5),
                     st.integers(1, 9), few).map(lambda t: t[0] + t[1] * t[2] + t[3])


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(few, periodic), min_size=1, max_size=4),
       limits=st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2), (1, 6)]))
def test_runs_of_any_words(texts, limits):
    assert found_in(texts, *limits) == [plainly(t, *limits) for t in texts]


def test_least_prefix_is_that_of_the_shortest_run():
    for min_length in range(1, 30):
        for e in range(2, 7):
            runs = [max(min_length, e * q) - q for q in range(1, 40)]
            assert P.least_prefix(min_length, e) == min(runs)


def test_long_texts():
    texts = [[0] * 30_000, [*range(7)] * 4_000, [*range(20_000)], [*range(5000)] * 4]
    assert found_in(texts, 6, 4) == [[(0, 30_000, 1)], [(0, 28_000, 7)], [], [(0, 20_000, 5000)]]


def test_rows_of_any_kind(spark):
    words = ["a b " * 9, "x", "", None, " \t\n", "stop " * 6 + "go", "stop " * 5, "né né né né né né",
             "A a A a A a A a", "c d e " * 5 + "c d e f " * 5, "w" * 100_000, "z y " * 20_000]
    rows = [(k, t) for k, t in enumerate(words)] + [(1, "b " * 8)] * 2 + [(None, "q " * 7)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "doc_id long, text string, runs int, kept_text string, start int")
    got = P.periodic_runs(docs.coalesce(1)).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, rows, strict=True):
        w = WORD.findall(text or "")
        runs = plainly(w) if len(w) < 1000 else [(0, 40_000, 2)]
        assert (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) == (
            doc_id, len(w), runs, kept(w, runs))
    assert P.periodic_runs(docs.limit(0)).collect() == []


def contract(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = plainly(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept(w, runs).encode()).hexdigest())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(contract(r.doc_id, r.text) for r in docs)
    got = sorted(map(tuple, op12_periodic_runs(spark, sf_dir).collect()))
    assert got == want
    assert sum(r[1] > 0 for r in got) > len(docs) // 30


def test_query_on_any_rows(spark, tmp_path):
    texts = ["", None, "a a a a a a b b b b b b b", "u v " * 12 + "w " * 12, "p q r " * 30]
    rows = [(k, texts[k % 5]) for k in range(60)] + [(None, "n " * 9), (3, "n " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    want = [contract(*r) for r in rows if r[0] is not None]
    lines, left = (hashlib.sha256(x).hexdigest() for x in (b"0,9,1\n", b"n"))
    assert got == sorted([*want, (None, 1, 0, 9, 1, 9000, lines, left)], key=repr)
