import random

import pytest

import corpus_pipeline
from tastegrid.llm import language_id, ngram_join, substring

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"en": "the tion ing er", "de": "sch ung keit ei", "fr": "aux ou ment é"}


def prose(rng, lang, n):
    parts = LETTERS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randrange(2, 6))) for _ in range(n))


def corpus():
    rng = random.Random(8)
    texts = [(prose(rng, lang, 80), lang) for lang in LETTERS for _ in range(25)]
    item = prose(rng, "en", 30)
    passage = prose(rng, "de", 60)
    near = texts[3][0].split()
    near[40] = "changed"
    rows = {k: t for k, t in enumerate(texts)}
    rows[200] = (" ".join(near), "en")  # a near copy of 3
    rows[201] = (texts[5][0], "en")  # a copy of 5
    rows[202] = ("123 !!! 456", "en")
    rows[203] = (None, "en")
    rows[204] = (f"{prose(rng, 'en', 40)} {item} {prose(rng, 'en', 40)}", "en")
    rows[205] = (f"{prose(rng, 'de', 70)} {passage} {prose(rng, 'de', 70)}", "de")
    rows[206] = (f"{prose(rng, 'de', 75)} {passage}\n{prose(rng, 'de', 75)}", "de")
    docs = [(k, t, lang, "s", len(t or "")) for k, (t, lang) in rows.items()]
    return docs, [(0, item)], passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs, items, _ = corpus()
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(
        str(path / "benchmark.parquet")
    )
    return str(path)


def test_planted_cases(spark, folder):
    docs, _, passage = corpus()
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    gone = {200, 201, 202, 203, 204}
    assert set(found) == {d[0] for d in docs} - gone
    texts = {d[0]: d[1] for d in docs}
    assert passage in found[205].text and passage not in found[206].text
    assert found[206].text.split() == texts[206].replace(passage, "").split()
    for i, row in found.items():
        assert row.n_tokens == len(row.ids)
        assert i == 206 or row.text == texts[i]


def test_stages_keep_the_columns_and_follow_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "language_id", "ngram_join", "substring_dedup", "decontamination", "byte_bpe"
    ]
    model = language_id.train(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        before = {r.doc_id: r for r in docs.collect()}
        after = {r.doc_id: r for r in out.collect()}
        if name == "language_id":
            told = language_id.predict(docs, model).where("NOT ambiguous").collect()
            assert set(after) == {r.doc_id for r in told}
        if name == "ngram_join":
            groups = ngram_join.jaccard_components(docs, 5, 80).collect()
            assert set(after) == {r.component_id for r in groups}
        if name == "substring_dedup":
            changed = {r.doc_id: r.kept_text for r in substring.remove_repeats(docs).collect()}
            for i, row in before.items():
                assert after[i].text == (row.text if changed[i] is None else changed[i])
                assert after[i].n_chars == len(after[i].text)
        docs = spark.createDataFrame(list(after.values()), docs.schema)


def test_stages_with_extra_columns_of_clashing_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "*", "1 AS text_hash", "'x' AS kept_text", "2 AS changed_id", "'c' AS component_id",
        "0.5 AS score", "'p' AS print", "doc_id AS item_id",
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert {tuple(r)[5:9] for r in out.collect()} == {(1, "x", 2, "c")}


def test_empty_documents(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
