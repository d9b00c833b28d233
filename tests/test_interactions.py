import math
import random

import pytest
from pyspark.sql import functions as F

from tastegrid.config import DOMAINS
from tastegrid.operators import diagnostics, interactions, positions
from tastegrid.operators import split as S
from tastegrid.operators.joins import splittable_join
from tastegrid.workload import adapters

LOG = "username string, content_id string, duration double, profile_id bigint"


def tables(spark):
    users = spark.createDataFrame([("u", 1), ("v", 0)], "username string, sex int")
    items = spark.createDataFrame([("a", 100.0), ("b", 10.0)],
                                  "content_id string, content_duration double")
    return users, items


def labelled(spark, log, domain):
    users, items = tables(spark)
    rows = interactions.labelled_views(
        spark.createDataFrame(log, LOG), users, items, DOMAINS[domain])
    return sorted((r.username, r.content_id, r.duration, r.profile_id, r.watch_count, r.label)
                  for r in rows.collect())


def test_identical_views_count_once(spark):
    log = [("u", "a", 1.0, 1), ("u", "a", 1.0, 1), ("v", "a", 1.0, 2), ("v", "a", 2.0, 2)]
    assert labelled(spark, log, "all") == [
        ("u", "a", 1.0, 1, 1, 0), ("v", "a", 1.0, 2, 2, 1), ("v", "a", 2.0, 2, 2, 1)]


def test_unknown_users_and_contents_leave_before_the_count(spark):
    log = [("u", "a", 1.0, 1), ("ghost", "a", 2.0, 1), ("u", "zz", 1.0, 1)]
    assert labelled(spark, log, "all") == [("u", "a", 1.0, 1, 1, 0)]


def test_null_profile_is_not_labelled_by_count(spark):
    users, items = tables(spark)
    log = spark.createDataFrame(
        [("u", "a", 1.0, None), ("u", "a", 2.0, None), ("u", "b", 9.0, None)], LOG)
    for domain, wanted in (("all", {1.0: 0, 2.0: 0, 9.0: 0}),
                           ("movie", {1.0: 0, 2.0: 0, 9.0: 1})):
        rows = interactions.labelled_views(log, users, items, DOMAINS[domain]).collect()
        assert {r.duration: r.label for r in rows} == wanted
        assert all(r.watch_count is None for r in rows)


@pytest.mark.parametrize("domain,limit", [("movie", 0.9), ("clip", 0.3), ("music", 1.0)])
def test_share_limit_is_inclusive_and_missing_is_0(spark, domain, limit):
    log = [("u", "a", 100 * limit, 1), ("u", "a", 100 * limit - 1, 2), ("u", "a", 500.0, 3),
           ("u", "a", None, 4), ("u", "a", math.nan, 5)]
    users, items = tables(spark)
    rows = interactions.labelled_views(
        spark.createDataFrame(log, LOG), users, items, DOMAINS[domain]).collect()
    assert {r.profile_id: r.label for r in rows} == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}


def test_training_rows_log_the_duration_where_configured(spark):
    users, items = tables(spark)
    log = spark.createDataFrame([("u", "a", 1.0, 1)], LOG)
    for domain, wanted in (("movie", math.log(100)), ("all", 100.0)):
        row = interactions.training_rows(log, users, items, DOMAINS[domain]).first()
        assert row.content_duration == pytest.approx(wanted)
        assert "duration" not in row and "watch_count" not in row


def test_repeated_user_and_item_rows_fan_out(spark):
    users = spark.createDataFrame([("u", 1), ("u", 0)], "username string, sex int")
    items = spark.createDataFrame([("a", 10.0), ("a", 20.0)],
                                  "content_id string, content_duration double")
    log = spark.createDataFrame([("u", "a", 1.0, 1)], LOG)
    rows = interactions.labelled_views(log, users, items, DOMAINS["all"]).collect()
    assert len(rows) == 4 and {r.watch_count for r in rows} == {4}


def test_hot_group_is_split_over_tasks(spark):
    """One pair holds most rows: the count join must not bring them into one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("profile_id"),
            F.lit("a").alias("content_id"), F.lit("u").alias("username"),
            F.col("id").cast("double").alias("duration"))
        users = spark.createDataFrame([("u",)], "username string")
        items = spark.createDataFrame([("a",)], "content_id string")
        counts = interactions.watch_counts(rows, users, items)
        counted = splittable_join(rows, counts, ["profile_id", "content_id"], "left")
        counted.collect()
        assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()
        # 7 itself is a multiple of 3 plus 1, so it only occurs as the hot key
        assert counted.where("profile_id = 7 and watch_count = 40000").count() == 40_000
        assert counted.where("profile_id <> 7 and watch_count = 1").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_log_is_joined_once_with_each_table(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        users, items = tables(spark)
        log = spark.createDataFrame([("u", "a", 1.0, 1), ("u", "b", 2.0, 1)], LOG)
        rows = interactions.labelled_views(log, users, items, DOMAINS["movie"])
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        # two with the tables, one with the counts, and two short ones that make the counts
        assert len(joins) == 5
        assert sum("_hash" in line for line in joins) == 3
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_splittable_join_keeps_unmatched_rows_on_the_left(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    got = splittable_join(left, right, ["k"], "left").collect()
    assert sorted((r.k or "", r.v) for r in got) == [("", None), ("a", 1), ("b", None)]


def test_join_diagnostics_and_overlap(spark):
    users, items = tables(spark)
    log = spark.createDataFrame(
        [("u", "a", 1.0, 1), ("u", "a", 1.0, 1), ("u", "zz", 1.0, 1), ("x", "b", 1.0, 2)], LOG)
    got = diagnostics.join_diagnostics(log, users, items).first().asDict()
    assert got == {
        "log_rows": 4, "log_contents": 3, "user_rows": 2, "usernames": 2, "item_rows": 2,
        "contents": 2, "rows_after_users": 3, "usernames_after_users": 1, "rows_after_items": 2,
        "contents_after_items": 1, "rows_after_distinct": 1}
    overlap = diagnostics.content_overlap(log, items)
    assert sorted(r.content_id for r in overlap.collect()) == ["a", "b"]
    assert [r.content_id for r in diagnostics.sample_ids(log, n=2).collect()] == ["a", "b"]


def test_scoring_counts(spark):
    log = spark.createDataFrame([("u", "a", 1.0, 1), ("u", "a", 1.0, None)], LOG)
    profiles = spark.createDataFrame([("u", 1), ("v", 1)], "username string, profile_id int")
    items = spark.createDataFrame([("b",), ("a",), ("c",)], "content_id string")
    catalogue = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "content_id string")
    got = diagnostics.scoring_counts(log, profiles, items, catalogue).first().asDict()
    assert got == {"profile_rows": 2, "items": 3, "scored_pairs": 6, "null_profiles": 1,
                   "null_items": 1, "sample": "a,b,c"}


@pytest.mark.parametrize("n,sizes", [(12, [2, 2, 2, 2, 4]), (3, [0, 0, 0, 0, 3]), (5, [1] * 5)])
def test_slices(spark, n, sizes):
    df = spark.createDataFrame([(i, random.random()) for i in range(n)], "k int, x double")
    placed = positions.with_positions(df.repartition(3), ["k"])
    rows = placed.withColumn("s", positions.slice_number()).collect()
    assert sorted((r.k, r.position) for r in rows) == [(i, i) for i in range(n)]
    assert [sum(r.s == i for r in rows) for i in range(5)] == sizes


def test_file_positions(spark, tmp_path):
    for part, ids in (("a", range(0, 5)), ("b", range(5, 9))):
        spark.createDataFrame([(i,) for i in ids], "k int").coalesce(1).write.parquet(
            str(tmp_path / part))
    placed = positions.read_with_positions(
        spark, [str(tmp_path / "b"), str(tmp_path / "a")], ["k"]).collect()
    assert {r.k: r.position for r in placed} == {i: i for i in range(9)}
    assert {r.total for r in placed} == {9}


def test_validation_sizes():
    assert S.validation_sizes({0: 10, 1: 5}, 0.2) == {0: 2, 1: 1}
    assert sum(S.validation_sizes({0: 7, 1: 6}, 0.3).values()) == 4


@pytest.mark.parametrize("bits", [16, 4])
def test_split_is_exact_and_independent_of_partitions(spark, monkeypatch, bits):
    monkeypatch.setattr(S, "PREFIX_BITS", bits)
    rows = spark.range(1000).select(F.col("id").alias("row_key"),
                                    (F.col("id") % 10 < 3).cast("int").alias("label"))
    first = S.stratified_split(rows, 0.2).where("split = 'validation'").collect()
    again = S.stratified_split(rows.repartition(7), 0.2).where("split = 'validation'").collect()
    assert sorted(r.row_key for r in first) == sorted(r.row_key for r in again)
    assert sum(r.label == 0 for r in first) == 140 and sum(r.label for r in first) == 60


def test_class_distribution_and_weight(spark):
    rows = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "label int")
    got = {r.label: (r.n, r.percent) for r in S.class_distribution(rows).collect()}
    assert got == {0: (8, 80.0), 1: (2, 20.0)}
    assert S.positive_weight(rows).first()[0] == pytest.approx(2.0)


def test_the_distinct_log_is_made_once(spark):
    """The count and the labelled rows read the same shuffled views."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        users, items = tables(spark)
        log = spark.createDataFrame(
            [("u", "a", 1.0, 1), ("u", "a", 1.0, 1), ("u", "a", 2.0, 1), ("v", "b", 3.0, None),
             ("v", "b", 4.0, None), (None, "b", 1.0, 1), ("u", None, 1.0, 1)], LOG)
        rows = interactions.labelled_views(log, users, items, DOMAINS["all"])
        got = sorted((r.username, r.duration, r.watch_count or 0) for r in rows.collect())
        assert got == [("u", 1.0, 2), ("u", 2.0, 2), ("v", 3.0, 0), ("v", 4.0, 0)]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan.split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_task_holds_one_sum_of_the_log(spark):
    """The distinct views and their counts are sums of different tasks, by a shuffle between."""
    log = spark.range(2_000, numPartitions=4).select(
        F.lit("u").alias("username"), F.lit("a").alias("content_id"),
        (F.col("id") % 1_500).cast("double").alias("duration"),
        F.lit(None).cast("bigint").alias("profile_id"))
    users = spark.createDataFrame([("u", 1), ("u", 0)], "username string, sex int")
    counts = interactions._user_counts(interactions.distinct_views(log), users)
    assert [tuple(r) for r in counts.collect()] == [(None, "a", 3_000)]
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    steps = [line for line in plan.splitlines() if "Aggregate(" in line or "Exchange" in line]
    sums = ["Exchange" not in line for line in steps]
    assert not any(a and b for a, b in zip(sums, sums[1:], strict=False))
    # one pair holds all rows: its rows are spread before they are summed
    spread = [line for line in steps if "REPARTITION_BY_COL" in line]
    assert len(spread) == 1 and "_part" in spread[0]


def test_lines_are_joined_and_made_distinct_in_different_tasks(spark, tmp_path):
    """Names too large to be sent along must not bring join, sums and lines into merged tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, rows, schema in (
        ("customer", [(1, "u"), (2, "v")], "c_custkey bigint, c_name string"),
        ("orders", [(10, 1), (11, 2), (12, 3), (13, None)], "o_orderkey bigint, o_custkey bigint"),
        ("lineitem", [(10, 5, 1.0), (10, 5, 1.0), (11, 6, 2.0), (12, 7, 1.0), (13, 7, 1.0)],
         "l_orderkey bigint, l_partkey bigint, l_quantity double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        views = interactions.distinct_views(adapters.watch_log_wide(spark, str(tmp_path)))
        got = sorted(tuple(r) for r in views.collect())
        assert got == [("u", "5", 1.0, 1), ("v", "6", 2.0, 2)]
        plan = views._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        steps = [line for line in plan.splitlines() if "Aggregate(" in line or "Exchange" in line]
        assert "Aggregate(" in steps[0] and "Exchange" in steps[1] and "Aggregate(" in steps[2]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_events_are_joined_and_made_distinct_in_different_tasks(spark, tmp_path):
    """The dense log, too; a user that holds most events is split where it meets its name."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    spark.createDataFrame(
        [(0, "u"), (1, "v"), (1, "w"), (None, "x")], "c_custkey bigint, c_name string"
    ).write.parquet(str(tmp_path / "customer.parquet"))
    content = F.concat(F.lit('{"k": '), (F.col("id") % 7).cast("string"), F.lit("}"))
    user = (F.when(F.col("id") < 20_000, 0).when(F.col("id") < 20_100, 1)
            .when(F.col("id") < 20_200, 2))  # 2 has no name, the last have no user
    spark.range(20_300, numPartitions=8).select(
        F.col("id").alias("event_id"), user.cast("bigint").alias("user_id"),
        (F.col("id") % 5_000).cast("double").alias("value"), content.alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        views = interactions.distinct_views(adapters.watch_log_dense(spark, str(tmp_path)))
        got = sorted(tuple(r) for r in views.collect())
        assert got == sorted(
            {("u", str(i % 7), float(i % 5_000), 0) for i in range(20_000)}
            | {(n, str(i % 7), float(i % 5_000), 1) for i in range(20_000, 20_100) for n in "vw"}
        )
        plan = views._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        steps = [line for line in plan.splitlines() if "Aggregate(" in line or "Exchange" in line]
        assert "Aggregate(" in steps[0] and "Exchange" in steps[1] and "Aggregate(" in steps[2]
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
