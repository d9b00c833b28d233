import json

import pytest

from tastegrid.config import DOMAINS
from tastegrid.plans import jobs
from tastegrid.workload import adapters as A


@pytest.fixture(scope="module")
def layout(spark, sf_dir, tmp_path_factory):
    """The given tables written out as the files a user would have."""
    root = tmp_path_factory.mktemp("inputs")
    layout = jobs.Layout.under(str(root))
    A.watch_log_dense(spark, sf_dir).coalesce(2).write.parquet(layout.log)
    A.users(spark, sf_dir).coalesce(1).write.parquet(layout.users)
    A.rules(spark).orderBy("rule_ord").drop("rule_ord").coalesce(1).write.parquet(layout.rules)
    folder = root / "catalogue" / "deep"
    folder.mkdir(parents=True)
    rows = [r.asDict() for r in A.catalogue(spark, sf_dir).drop("item_ord").collect()]
    (folder / "content_clip_20.json").write_text(json.dumps(rows[:100]))
    (folder / "content_clip_21.json").write_text(json.dumps(rows[100:]))
    tags = root / "tags" / "one"
    tags.mkdir(parents=True)
    (tags / "tags.json").write_text(json.dumps(
        [r.asDict() for r in A.tags(spark, sf_dir).distinct().collect()]))
    return layout


def test_train_then_recommend(spark, layout):
    domain = DOMAINS["clip"]
    history = jobs.train_domain(spark, layout, domain, 2025, rounds=1, epochs=1)
    assert len(history) == 1
    found = jobs.recommend_domain(spark, layout, domain, 2025, n=7)
    rows = found.collect()
    assert len(rows) == 15 and all(len(r["items"]) == 7 for r in rows)
    lines = spark.read.text(layout.of(domain, "result_json")).collect()
    assert len(lines) == 15 and len(json.loads(lines[0].value)) == 1
    names = spark.read.json(layout.of(domain, "rulename_json"))
    assert sorted(names.columns) == ["d", "pid"] and names.count() == 15
    assert spark.read.text(layout.of(domain, "rule_content")).count() == 15
    assert spark.read.parquet(layout.of(domain, "broken_catalogue_files")).count() == 0
    counts = spark.read.parquet(layout.of(domain, "counts")).first()
    assert counts.scored_pairs == counts.profile_rows * counts["items"] > 0
    assert spark.read.parquet(layout.of(domain, "tag_map")).count() == 15
    items = spark.read.parquet(layout.of(domain, "catalogue"))
    assert sorted(r.item_ord for r in items.collect()) == list(range(200))
    assert {int(r.content_id): r.item_ord for r in items.collect()} == {i: i for i in range(200)}
    # a second training starts from the stored matrix and keeps the better model
    jobs.train_domain(spark, layout, domain, 2025, rounds=1, epochs=1)
    assert spark.read.parquet(layout.of(domain, "history")).count() == 2


def test_numeric_user_columns_pass_through(spark, sf_dir):
    from pyspark.sql import functions as F

    from tastegrid.plans import feature_build
    users = A.users(spark, sf_dir).withColumn("points", F.lit(2.5)).withColumn("note", F.lit("x"))
    features = feature_build.fit_features(
        users, A.catalogue(spark, sf_dir), DOMAINS["clip"], 2025)
    assert features.names[:2] == ["sex", "points"] and "note" not in features.names
    assert {dict(zip(r.idx, r.val, strict=True))[1] for r in features.users.collect()} == {2.5}


def test_compact_log(spark, layout, sf_dir):
    parts = spark.read.parquet(jobs.compact_log(spark, layout))
    n = A.watch_log_dense(spark, sf_dir).count()
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {**{i: n // 5 for i in range(1, 5)}, 5: n - 4 * (n // 5)}


def test_a_training_set_lists_the_catalogue_once_for_its_print(spark, layout, monkeypatch):
    listed, whole = [], jobs.manifests.files_print

    def seen(session, path, pattern="*"):
        listed.append(path)
        return whole(session, path, pattern)

    monkeypatch.setattr(jobs.manifests, "files_print", seen)
    jobs.build_training_set(spark, layout, DOMAINS["music"], 2025)
    assert listed.count(layout.catalogue) == 1
