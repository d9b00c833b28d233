import pytest

from tastegrid.operators import ranking as R
from tastegrid.operators import rules as G
from tastegrid.sinks import results as K

ITEMS = "content_id string, tag_names string"


def test_tag_map_last_id_wins_after_distinct(spark):
    tags = spark.createDataFrame(
        [(1, "a", 0), (2, "a", 1), (1, "a", 2), (5, "b", 3)],
        "TAG_ID bigint, TAG_NAME string, at int")
    got = {r.tag_name: r.tag_id for r in G.tag_map(tags, "at").collect()}
    assert got == {"a": 2, "b": 5}


def test_rule_map_first_place_last_id(spark):
    rules = spark.createDataFrame(
        [(0, "1,2", 10), (1, "3", 11), (2, "1,2", 12)],
        "rule_ord int, LIST_TAGS_ID string, RULE_ID bigint")
    got = sorted((r.rule_ord, r.list_tags_id, r.rule_id) for r in G.rule_map(rules).collect())
    assert got == [(0, "1,2", 12), (1, "3", 11)]


@pytest.fixture
def world(spark):
    tags = spark.createDataFrame([("red", 12), ("ring", 13), ("blue", 2), ("hot", 7)],
                                 "tag_name string, tag_id bigint")
    rules = spark.createDataFrame(
        [(0, "12,13", 101), (1, "2", 102), (2, "12", 103), (3, "None", 105), (4, "4,7", 106),
         (5, "12", 107)],
        "rule_ord int, LIST_TAGS_ID string, RULE_ID bigint")
    items = spark.createDataFrame(
        [("both", "red, ring"), ("first", "blue, red"), ("one", "red"), ("none", "hot"),
         ("unknown", "rod"), ("empty", ""), ("null", "None"), ("repeat", "red, red")], ITEMS)
    return items, tags, rules


WANTED = {"both": 101, "first": 102, "one": 107, "none": -100, "unknown": 105, "empty": 105,
          "null": 105, "repeat": 107}


@pytest.fixture(params=["trie", "small groups", "join"])
def assign(request):
    return {"trie": G.assign_rules, "join": G.assign_rules_by_join,
            "small groups": lambda *a: G.assign_rules(*a, group_items=20, group_rules=3)
            }[request.param]


def test_first_matching_rule(world, assign):
    # the repeated list "12" keeps its place and takes its last id
    assert {r.content_id: r.rule_id for r in assign(*world).collect()} == WANTED


def test_many_rules_of_one_common_tag(spark):
    """Sets of tags that most items carry: each would meet most items in a join."""
    n = 17
    tags = spark.createDataFrame([(f"t{i}", i) for i in range(n)], "tag_name string, tag_id bigint")
    rules = spark.range(100_000).selectExpr(
        "CAST(99999 - id AS INT) AS rule_ord", "id AS RULE_ID",
        f"array_join(transform(filter(sequence(0, {n - 1}), i -> (shiftright(id, i) & 1) = 1),"
        " i -> CAST(i AS STRING)), ',') AS LIST_TAGS_ID")
    items = [(str(k), ", ".join(f"t{i}" for i in range(n) if k & (1 << i)))
             for k in range(1, 1 << n, 61)]
    got = G.assign_rules(spark.createDataFrame(items, ITEMS), tags, rules.where("RULE_ID > 0"))

    def first(k):  # the largest subset of k below 100,000
        best = 0
        for i in reversed(range(n)):
            if k & (1 << i) and best | (1 << i) < 100_000:
                best |= 1 << i
        return best

    assert {int(r.content_id): r.rule_id for r in got.collect()} == {
        int(k): first(int(k)) for k, _ in items}


def test_many_rules_against_a_plain_loop(spark, assign):
    import random
    rng = random.Random(5)
    tags = spark.createDataFrame([(f"t{i}", i) for i in range(12)], "tag_name string, tag_id bigint")
    rules = [(i, ",".join(map(str, rng.sample(range(12), rng.randint(1, 4)))), 1000 + i)
             for i in range(60)]
    items = [(str(i), ", ".join(f"t{j}" for j in rng.sample(range(14), rng.randint(1, 6))))
             for i in range(300)]
    last = {listed: rule for _, listed, rule in rules}

    def first(names):
        have = {n[1:] if int(n[1:]) < 12 else "None" for n in names.split(", ")}
        return next((last[t] for _, t, _ in rules if set(t.split(",")) <= have), -100)

    got = assign(
        spark.createDataFrame(items, ITEMS), tags,
        spark.createDataFrame(rules, "rule_ord int, LIST_TAGS_ID string, RULE_ID bigint"))
    assert {r.content_id: r.rule_id for r in got.collect()} == {i: first(t) for i, t in items}


# -- ranking and output --------------------------------------------------------

PAIRS = "profile_id bigint, content_id string, item_ord bigint, score double"


def test_top_n_ties_nan_and_repeats(spark):
    pairs = spark.createDataFrame(
        [(1, "a", 0, 0.5), (1, "b", 1, 0.9), (1, "c", 2, 0.5), (1, "d", 3, float("nan")),
         (1, "b", 1, 0.1), (2, "z", 9, 0.2)], PAIRS)
    got = sorted((r.profile_id, r["rank"], r.content_id) for r in R.top_n(pairs, 4).collect())
    assert got == [(1, 1, "b"), (1, 2, "a"), (1, 3, "c"), (1, 4, "d"), (2, 1, "z")]
    again = R.top_n(R.top_n(pairs, 4).drop("rank"), 2).collect()
    assert sorted((r.profile_id, r.content_id) for r in again) == [(1, "a"), (1, "b"), (2, "z")]


def test_profiles_and_their_username(spark):
    log = spark.createDataFrame(
        [("u", 1), ("u", 1), ("t", 1), ("v", 2), ("w", None)], "username string, profile_id bigint")
    assert R.profiles(log).count() == 3
    names = {r.profile_id: r.username for r in R.profile_usernames(R.profiles(log)).collect()}
    assert names == {1: "t", 2: "v"}


def test_meta_lookup_text(spark):
    meta = spark.createDataFrame(
        [("a", 1, "A", None, "t"), ("a", 0, "first", "x", "t")],
        "content_id string, item_ord bigint, content_name string, tag_names string, type_id string")
    one = R.content_meta(meta)
    assert [r.content_name for r in one.collect()] == ["first"]
    ranked = spark.createDataFrame([("a",), ("q",)], "content_id string")
    got = {r.content_id: tuple(r)[1:] for r in R.with_meta(ranked, one).collect()}
    assert got == {"a": ("first", "x", "t"), "q": ("", "", "")}
    null = R.with_meta(ranked, R.content_meta(meta.where("item_ord = 1")))
    assert {r.content_id: r.tag_names for r in null.collect()} == {"a": "None", "q": ""}


@pytest.fixture
def results(spark):
    ranked = spark.createDataFrame(
        [(7, 1, "c1", "n1", "t", "12", 0.9, 132), (7, 2, "c2", "n2", "t", "13", 0.8, 148),
         (7, 3, "c3", "n3", "t", "12", 0.7, 132), (7, 4, "c4", "n4", "t", "12", 0.6, -100),
         (8, 1, "c1", "n1", "t", "12", 0.9, 132), (9, 1, "c4", "n4", "t", "12", 0.5, -100)],
        "profile_id bigint, rank int, content_id string, content_name string, tag_names string, "
        "type_id string, score double, rule_id bigint")
    names = spark.createDataFrame([(7, "u"), (8, "v"), (9, "w")], "profile_id bigint, username string")
    return R.results(ranked, names)


def test_rule_outputs(results):
    groups = R.rule_groups(results)
    assert {r.pid: r.d for r in R.rulename(groups).collect()} == {7: "132,148", 8: "132", 9: ""}
    assert {r.pid: r.line for r in R.rule_content(groups).collect()} == {
        7: "7|132$12#c1$12#c3;148$13#c2", 8: "8|132$12#c1", 9: "9|"}
    commas = {r.pid: r.line for r in R.rule_content(groups, rule_sep=",").collect()}
    assert commas[8] == "8|132,$12#c1"


def test_written_results(spark, results, tmp_path):
    import json
    K.write_results(results, str(tmp_path / "result"))
    K.write_rulename(results, str(tmp_path / "rulename"))
    K.write_rule_content(results, str(tmp_path / "rule_content"))
    merged = {}
    for row in spark.read.text(str(tmp_path / "result")).collect():
        merged.update(json.loads(row.value))
    assert list(merged["7"]["suggested_content"]) == ["c1", "c2", "c3", "c4"]
    assert merged["7"]["suggested_content"]["c2"] == {
        "content_name": "n2", "tag_names": "t", "type_id": "13", "score": 0.8, "rule_id": 148}
    assert merged["9"]["user"] == {"username": "w", "profile_id": 9}
    names = spark.read.schema("pid bigint, d string").json(str(tmp_path / "rulename"))
    assert names.count() == 3
    lines = [r.value for r in spark.read.text(str(tmp_path / "rule_content")).collect()]
    assert "9|" in lines
