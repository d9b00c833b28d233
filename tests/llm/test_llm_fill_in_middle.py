import hashlib
import re

import pytest

from tastegrid.llm import fill_in_middle as fim
from tastegrid.llm.queries import op11_fill_in_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row string, place int, piece string, part int, n int"


def plainly(doc_id, text, rate=50, spm=80):
    """(n, form, prefix, middle, output) by slicing the list of units."""
    text = text or ""
    units = UNIT.findall(text)
    h1, h2, h3, h4 = (
        int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[k : k + 8], 16)
        for k in range(0, 32, 8)
    )
    n = len(units)
    if doc_id is None or not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    None, "", " ", "\t\n ", "one", " one ", "a b c d e f", "ends in blanks \r\n", "é ü 数字 🙂 x",
    "has <P> a mark", "<S>", "not < P > a mark", "<P", "x <", "S>y < z", "\x1c \x85 \xa0 no blanks",
    "w " * 3000, "y" * 200_000, "é" * 100_000 + " tail", "ab\n" * 40_000,
]


@pytest.fixture(scope="module")
def rows():
    # several ids for each text, so that all forms occur; one row three times; null ids
    found = [(k, t) for k, t in enumerate(TEXTS * 6)]
    return found + [(7, "same row again")] * 3 + [(None, "no id here"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA).repartition(3)


def test_rearranged_and_restored_as_by_slicing(docs, rows):
    got = sorted(map(tuple, fim.fill_in_middle(docs).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        n, form, p, m, output = plainly(doc_id, text)
        want.append((doc_id, n, form, p, m, sha(output), sha(text or "")))
    assert got == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_outputs_themselves(docs, rows):
    got = sorted(map(tuple, fim.output_texts(docs).collect()))
    want = [(i, f, o) for (i, t) in rows for _, f, _, _, o in [plainly(i, t)] if f != "plain"]
    assert got == sorted(want)


def test_pieces_are_bounded_and_stand_in_order(docs):
    found = fim.in_output_order(fim.pieces(docs, rate=100)).toPandas()
    assert found["piece"].dropna().map(len).max() <= fim.PIECE_BYTES + 3
    for _, part in found.groupby(found["row"].map(bytes), sort=False):
        assert part["place"].tolist() == list(range(-1, len(part) - 1))
    assert found.groupby(found["row"].map(bytes)).size().max() > 5


def test_one_shuffle_and_no_text_of_plain_rows_in_it(docs):
    plan = fim.fill_in_middle(docs.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    heads = fim.pieces(docs, rate=0)
    assert heads.where("piece IS NOT NULL").count() == 0 and heads.count() == docs.count()


def test_row_keys_do_not_depend_on_the_order_of_rows(docs):
    one = docs.coalesce(1)
    a = fim.pieces(one).select("row", "place", "piece")
    b = fim.pieces(one.sortWithinPartitions("text", "doc_id")).select("row", "place", "piece")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.where("place = -1").select("row").distinct().count() == docs.count()


def test_empty_table(docs):
    assert fim.fill_in_middle(docs.limit(0)).collect() == []
    assert fim.output_texts(docs.limit(0)).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: plainly(r.doc_id, r.text) for r in docs}
    got = op11_fill_in_middle(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, p, m, output = want[r.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (
            n, form, p, m, sha(output))
