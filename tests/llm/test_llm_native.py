import random

import pytest
from pyspark.sql import functions as F

from tastegrid.llm import decontamination, url_filter
from tastegrid.llm.queries import URL_RULES


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def some(rng, n):
    return [f"v{rng.randrange(3000)}" for _ in range(n)]


def passages():
    rng = random.Random(4)
    items = [(k, some(rng, rng.choice([16, 25, 40]))) for k in range(6)]
    docs, planted = [], set()
    for k in range(60):
        text = some(rng, rng.choice([20, 60, 300]))
        if k % 3 == 0:
            i, item = items[k % 6]
            item = list(item)
            for _ in range(len(item) // 9):  # changed words
                item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(text))
            text[at:at] = item
            planted.add((k, i))
        docs.append((k, ", ".join(text).upper() if k % 2 else " ".join(text)))
    return docs, [(i, " ".join(t)) for i, t in items], planted


def test_changed_passages_are_found_and_nothing_else(spark):
    docs, items, planted = passages()
    extra = [(100, None), (101, ""), (102, "!!"), (None, items[0][1]), (103, items[1][1]),
             (103, items[1][1]), (104, " ".join(items[2][1].split()[8:]) + " tail of text")]
    df = spark.createDataFrame(
        [(*r, 1, "s") for r in docs + extra], "doc_id long, text string, item_id int, start string"
    )
    bench = spark.createDataFrame(
        [(*r, "x") for r in items] + [(50, None, "x"), (51, "too short", "x"), (5, items[5][1], "x")],
        "item_id long, text string, doc_id string",
    )
    result = decontamination.contaminated(df, bench)
    assert no_python(result)
    found = result.collect()
    assert {(r.doc_id, r.item_id) for r in found if r.doc_id is not None and r.doc_id < 100} \
        == planted
    others = {(r.doc_id, r.item_id) for r in found} - planted
    assert others == {(None, 0), (103, 1), (104, 2)}
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    whole = next(r for r in found if r.doc_id == 103)
    assert whole.n_matched == whole.n_tokens and whole.start == 0
    head = next(r for r in found if r.doc_id == 104)
    assert head.start == -8
    clean = decontamination.without_contaminated(df, bench)
    assert clean.columns == df.columns
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i, _ in docs + extra} - {p[0] for p in planted} - {103, 104}


def tokens_equal(item, text, start):
    return [k for k, w in enumerate(item)
            if 0 <= start + k < len(text) and text[start + k] == w]


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_whole_tokens_are_compared_where_many_words_are_changed(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    items = {k: some(rng, rng.choice([20, 30, 40])) for k in range(8)}
    docs = {}
    for k in range(120):
        item = list(items[k % 8])
        for x in rng.sample(range(len(item)), round(len(item) * rng.uniform(0.2, 0.3))):
            item[x] = "other"
        docs[k] = some(rng, 15) + item + some(rng, 15)
    wanted = {}
    for d, text in docs.items():
        for i, item in items.items():
            span = decontamination.SPAN - 1
            starts = {at - p for at in range(len(text) - span) for p in range(len(item) - span)
                      if any(all(text[at + x] == item[p + x] for x in mask)
                             for mask in decontamination.MASKS)}
            for start in sorted(starts):
                equal = tokens_equal(item, text, start)
                near = max((sum(a <= x < a + 13 for x in equal) for a in equal), default=0)
                if (len(equal) >= 0.6 * len(item) or near >= 11) and len(equal) > wanted.get(
                    (d, i), (0, 0)
                )[0]:
                    wanted[d, i] = len(equal), start
    assert len(wanted) > 80
    found = decontamination.contaminated(
        spark.createDataFrame([(d, " ".join(t)) for d, t in docs.items()],
                              "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()],
                              "item_id long, text string"),
    )
    assert no_python(found)
    assert {(r.doc_id, r.item_id): (r.n_matched, r.start) for r in found.collect()} == wanted


@pytest.mark.parametrize("length,least", [(15, 0.9), (16, 0.95), (25, 0.99), (59, 0.99)])
def test_recall_at_the_threshold(spark, length, least):
    """Passages of which 60 % of the tokens are left, at random places."""
    rng = random.Random(length)
    items = {k: [f"t{k}x{j}" for j in range(length)] for k in range(400)}
    docs = []
    for k, item in items.items():
        text = list(item)
        for x in rng.sample(range(length), length - -(-6 * length // 10)):
            text[x] = "changed"
        docs.append((k, " ".join([*some(rng, 9), *text, *some(rng, 9)])))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()],
                              "item_id long, text string"),
    ).collect()
    assert all(r.doc_id == r.item_id for r in found)
    assert len(found) >= least * len(items)


def test_a_passage_in_a_very_long_text(spark):
    rng = random.Random(3)
    item = some(rng, 30)
    text = " ".join(["filler words of a long text"] * 40_000 + item + ["more"] * 50_000)
    found = decontamination.contaminated(
        spark.createDataFrame([(1, text)], "doc_id long, text string"),
        spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"),
    ).collect()
    assert [(r.item_id, r.start, r.n_matched) for r in found] == [(7, 240_000, 30)]


def test_each_text_of_a_repeated_id_is_compared(spark):
    rng = random.Random(12)
    item, other = some(rng, 20), some(rng, 20)
    half = [w if k < 10 else "x" for k, w in enumerate(item)]
    rest = [w if k >= 10 else "y" for k, w in enumerate(item)]
    rows = [(1, half), (1, rest), (None, item), (None, other), (None, half)]
    found = decontamination.contaminated(
        spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string"),
        spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"),
    ).collect()
    assert [(r.doc_id, r.item_id, r.n_matched) for r in found] == [(None, 7, 20)]


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, none).collect() == []
    assert decontamination.contaminated(docs.where("false"), none).collect() == []
    assert decontamination.without_contaminated(docs, none).count() == 1


URLS = {
    "http://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
    "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
    "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "x://m.shop.com/fr/#a": ("m.shop.com", "/fr/", "com/fr/", "allow"),
    "x://shop.com/de/": ("shop.com", "/de/", "com/de/", "block"),
    "http://org": ("org", "", None, None),
    "http://net.x?u://y/z": ("net.x", "", None, None),
    "a\nb://h.net/p\nq?r": ("h.net", "/p\nq", None, None),
    "no scheme": ("", "", None, None),
    "": ("", "", None, None),
    None: ("", "", None, None),
    "http://www.bad.net/a/?q": ("www.bad.net", "/a/", None, "block"),
    "http://bad.net/a#x": ("bad.net", "/a", None, "block"),
    "http://bad.net/ab": ("bad.net", "/ab", None, None),
}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_rules_then_the_list(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
    urls = list(URLS)
    pages = spark.createDataFrame(
        [(k, u, "v", None) for k, u in enumerate([*urls, urls[-1]])],
        "page_id long, url string, verdict string, html string",
    )
    listed = spark.createDataFrame(
        [(f"site{k}.net/p{k}",) for k in range(500)] + [("bad.net/a",)] * 2 + [(None,), ("",)],
        "url string",
    )
    result = url_filter.filter_urls(pages, listed, URL_RULES)
    assert no_python(result)
    found = {r.page_id: r for r in result.collect()}
    assert len(found) == len(urls) + 1
    for k, url in enumerate(urls):
        host, path, rule, verdict = URLS[url]
        r = found[k]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (verdict or "allow"), url


def test_bloom_filter_holds_all_its_keys(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 3000 // url_filter.KEYS_PER_BLOCK
    bloom = url_filter.build_bloom(keys, "key", blocks)
    rows = keys.unionByName(spark.range(20000).select(F.concat(F.lit("n"), "id").alias("key")))
    probed = url_filter.may_hold(bloom, rows, "key", blocks, 0).groupBy(
        F.substring("key", 1, 1).alias("kind"), "maybe"
    ).count().collect()
    count = {(r.kind, r.maybe): r["count"] for r in probed}
    assert count["k", True] == 3000 and ("k", False) not in count
    assert count.get(("n", True), 0) < 200


def test_empty_list_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.net/utm_")], "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    assert [r.verdict for r in url_filter.filter_urls(pages, none, URL_RULES).collect()] == ["allow"]
    assert url_filter.filter_urls(pages.where("false"), none, []).collect() == []
    assert url_filter.tracked_urls(pages).collect() == []
