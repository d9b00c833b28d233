import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm import bpe
from tastegrid.llm.queries import RANK_FILE, op8_byte_bpe, vocabulary


@pytest.fixture(scope="module")
def known():
    return vocabulary()


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(RANK_FILE), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


HARD = [
    "", " ", "  a  b", "don't WON'T we'll", "\x1c\x1d\x85\xa0 x y​", "é é ñandú",
    "数字１２３ ½ ²", "a" * 5000, "ab" * 3000, "<|endoftext|>", "\n\n\t \r\n x", "🙂🙂 👩‍👩‍👧",
    "!!!???$$$", "thandndth ingly" * 50, "\x00\x01", "१२३ ४५ ١٢",
]


def ids_of(encoder, texts):
    ids, counts = encoder.encode(texts)
    ends = counts.cumsum()
    return [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]


def test_same_ids_as_the_reference_library(known, reference):
    encoder = bpe.Encoder(known)
    for text, ids in zip(HARD, ids_of(encoder, HARD), strict=True):
        assert ids == reference.encode_ordinary(text), text[:20]
        assert encoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(
    st.characters(codec="utf-8"), st.sampled_from("abcdeth \n'0.é")), max_size=60))
def test_any_text(known, reference, text):
    encoder = bpe.Encoder(known)
    assert ids_of(encoder, [text]) == [reference.encode_ordinary(text)]


def test_forgetting_changes_nothing(known, monkeypatch):
    plain = ids_of(bpe.Encoder(known), HARD)
    monkeypatch.setattr(bpe, "REMEMBERED", 1)
    small = bpe.Encoder(known)
    assert [ids_of(small, [t])[0] for t in HARD] == plain


def test_perfect_hash_has_no_gaps(known):
    slots = known.perfect.find(bpe._hashes(list(known.ids)))
    assert sorted(slots.tolist()) == list(range(len(known.ids)))


def test_query_digests(spark, tmp_path, reference):
    rows = [(k, t, k) for k, t in enumerate([*HARD, None, HARD[1]])]
    spark.createDataFrame(rows, "doc_id long, text string, ids int").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = {r.doc_id: r for r in op8_byte_bpe(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for i, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        assert found[i].n_tokens == len(ids)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].ids_sha256 == digest
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark, known):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_decode(empty, known).collect() == []
