import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tastegrid.llm import packing
from tastegrid.llm.queries import PACKING_FILE, op13_packing

FILE = public_tokenizers.path(PACKING_FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def words():
    return packing.Words(Path(FILE).read_text(), 1)


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


HARD = [
    "", " ", "Don't WON'T we'll I'M", "x\x0by\x1cz\x85w\xa0v u", "é ́e ΟΔΟΣ Σ ΑΣ, İI ǅ",
    "１２３ ½ 2024-01-01", "<|endoftext|> a<|startoftext|>b < |endoftext|>", "</w> a</w>", "🙂🙂 👩‍👩‍👧",
    "a" * 3000, "!!! ??? ...", "'s 's'd x's", "가 ᆨ", "ﬁ ß ẞ", "tab\tnew\r\nline",
]


def test_same_ids_as_the_library(library, words):
    want = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in HARD]
    assert split(*words.encode(pa.array(HARD))) == want


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.one_of(
    st.characters(codec="utf-8"), st.sampled_from("aeST \t\n'.́ͅΣ<|>")), max_size=40)))
def test_any_texts(library, words, texts):
    want = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert split(*words.encode(pa.array(texts, pa.string()))) == want


def test_forgetting_changes_nothing(monkeypatch, words):
    monkeypatch.setattr(packing, "REMEMBERED", 1)
    small = packing.Words(Path(FILE).read_text(), 1)
    for text in HARD:
        a, b = small.encode(pa.array([text])), words.encode(pa.array([text]))
        assert a[0].tolist() == b[0].tolist()


@settings(max_examples=300, deadline=None)
@given(lengths=st.lists(st.integers(1, 70), max_size=60),
       tiers=st.sampled_from([(32, 16, 8), (16,), (64, 32, 16, 8, 4), (8, 4)]))
def test_windows_hold_every_token_once_without_padding(lengths, tiers):
    windows = packing.Packer(tiers).pack(lengths)
    sizes = [sum(n for *_, n in w) for w in windows]
    assert all(s & (s - 1) == 0 and 0 < s <= tiers[0] for s in sizes)
    short = sorted(s for s in sizes if s not in tiers)
    assert len(short) == len(set(short))  # one rest in a block at most
    covered = defaultdict(list)
    for doc, at, n in (p for w in windows for p in w):
        assert n > 0
        covered[doc].append((at, n))
    for doc, length in enumerate(lengths):
        ends = 0
        for at, n in sorted(covered[doc]):
            assert at == ends
            ends += n
        assert ends == length


def test_documents_stay_whole_where_they_fit():
    # 20 goes to the tier of 32, its gap of 12 to the longest documents that fit
    assert packing.Packer((32, 16, 8)).pack([20, 7, 5, 12]) == [
        [(0, 0, 20), (3, 0, 12)], [(1, 0, 7), (2, 0, 1)], [(2, 1, 4)]]


def test_steps_hold_near_the_same_number_of_tokens():
    sizes = [2048] * 100 + [1024] * 301 + [512] * 77 + [256] * 5
    steps = packing.step_groups(sizes, 64 * 2048)
    loads = np.bincount(steps, weights=sizes)
    assert len(loads) == 4 and loads.max() - loads.min() <= 256


def check(pieces, docs, library, longest=2048):
    """``pieces`` hold every id of every row of ``docs`` once; repeated ids are not allowed."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {d for d, _ in docs}
    for doc_id, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= longest and at & (at - 1) == 0
        assert {p.context for p in own} == {at} and len({p.step for p in own}) == 1


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(op13_packing(spark, sf_dir).collect(), docs, library)


def test_rows_of_any_kind(spark, tmp_path, library):
    texts = ["", None, "a b c", "x" * 50_000, "one two " * 9000, " "]
    rows = [(k, texts[k % 6]) for k in range(40)] + [(None, "no id")]
    spark.createDataFrame([(*r, 1, "s", 2) for r in rows],
                          "doc_id long, text string, start int, ids string, step int") \
        .repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    check(op13_packing(spark, str(tmp_path)).collect(), rows, library)
    docs = spark.createDataFrame([(1, "same row")] * 5, "doc_id int, text string")
    tokenizer = Path(FILE).read_text()
    again = packing.packed(docs.coalesce(1), tokenizer).collect()
    assert sum(p.length for p in again) == 15 and {p.doc_id for p in again} == {1}
    assert packing.packed(docs.limit(0), tokenizer).collect() == []


def test_bad_tiers(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    for tiers in ((100,), (256, 512), (8, 8)):
        with pytest.raises(ValueError):
            packing.packed(docs, "{}", tiers=tiers)
