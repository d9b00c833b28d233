import math

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import encoding as E

SPEC = E.FeatureSpec(
    key="id", numeric=("n",), one_hot=("kind",), multi_hot=("cats",), scaled=("s",))
SCHEMA = "id string, n string, kind string, cats string, s double"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("1", "5", "b", "x,y", 1.0), ("2", None, "a", None, 2.0), ("3", "0", None, "y,,y", 4.0)],
        SCHEMA)


def test_vocabulary_is_sorted_with_null_last(rows):
    got = {(r.source, r.value): r.ordinal for r in E.vocabulary(rows, SPEC).collect()}
    assert got == {("kind", "a"): 0, ("kind", "b"): 1, ("kind", None): 2,
                   ("cats", ""): 0, ("cats", "x"): 1, ("cats", "y"): 2}


def test_population_sd_and_constant_column(spark, rows):
    stats = E.statistics(rows, SPEC).first()
    assert stats.mean == pytest.approx(7 / 3) and stats.sd == pytest.approx(1.247219, abs=1e-6)
    constant = spark.createDataFrame([(3.0,), (3.0,)], "s double")
    spec = E.FeatureSpec(key="id", scaled=("s",))
    assert E.statistics(constant, spec).first().sd == 1.0


def test_wide_and_sparse_agree_and_unknown_is_zero(spark, rows):
    encoder = E.Encoder.fit(rows, SPEC)
    assert encoder.feature_names == [
        "n", "kind_a", "kind_b", "kind_None", "cats_", "cats_x", "cats_y", "s"]
    new = rows.unionByName(spark.createDataFrame([("4", "2", "zz", "q,x", 7 / 3)], SCHEMA))
    wide = {r.id: [float(r[c] or 0) for c in encoder.feature_names]
            for r in encoder.wide(new).collect()}
    for r in encoder.sparse(new).collect():
        dense = [0.0] * encoder.width
        for i, v in zip(r.idx, r.val, strict=True):
            dense[i] = v
        assert dense == pytest.approx(wide[r.id])
        assert list(r.idx) == sorted(r.idx)
    assert wide["4"][1:4] == [0, 0, 0] and wide["4"][4:7] == [0, 1, 0]


def test_scaled_column_has_mean_0_and_sd_1(rows):
    wide = E.Encoder.fit(rows, SPEC).wide(rows)
    got = wide.agg(F.avg("s").alias("m"), F.stddev_pop("s").alias("d")).first()
    assert got.m == pytest.approx(0, abs=1e-12) and got.d == pytest.approx(1)


def test_log_and_unusable_text(spark):
    spec = E.FeatureSpec(key="id", numeric=("n",))
    df = spark.createDataFrame([("1", "10"), ("2", "oops"), ("3", None)], "id string, n string")
    got = {r.id: r for r in E.Encoder.fit(
        df.withColumn("k", F.lit("c")), E.FeatureSpec("id", ("n",), ("k",))).sparse(
        df.withColumn("k", F.lit("c")), log_of="n").collect()}
    assert got["1"].val[0] == pytest.approx(math.log(10))
    assert got["1"].usable and not got["2"].usable and got["3"].usable
    assert spec.numeric == ("n",)


def test_category_order_of_a_row_does_not_matter(spark):
    df = spark.createDataFrame(
        [("1", "1", "a", "x,y", 1.0), ("1", "1", "a", "y,x,y", 1.0)], SCHEMA)
    assert E.Encoder.fit(df, SPEC).sparse(df).distinct().count() == 1


def test_ten_thousand_categories(spark):
    df = spark.range(10_000).select(
        F.col("id").cast("string").alias("id"), F.lit("1").alias("n"),
        F.concat(F.lit("k"), "id").alias("kind"), F.concat("id", F.lit(",x")).alias("cats"),
        F.col("id").cast("double").alias("s"))
    encoder = E.Encoder.fit(df, SPEC)
    assert encoder.width == 1 + 10_000 + 10_001 + 1
    at = {(r.source, r.value): r.position for r in encoder.positions().collect()}
    assert sorted(at.values()) == list(range(1, 20_002))
    for r in encoder.sparse(df.where("id % 997 = 0")).collect():
        wanted = {0, at["kind", f"k{r.id}"], at["cats", r.id], at["cats", "x"], 20_002}
        assert set(r.idx) == wanted and len(r.idx) == 5


def test_text_none_and_a_null_have_two_names(spark):
    df = spark.createDataFrame(
        [("1", "1", "None", "x", 1.0), ("2", "1", None, "x", 2.0)], SCHEMA)
    names = E.Encoder.fit(df, SPEC).feature_names
    assert len(set(names)) == len(names) and "kind_None" in names


def test_save_load_and_missing_state(spark, rows, tmp_path):
    encoder = E.Encoder.fit(rows, SPEC)
    encoder.save(spark, str(tmp_path / "enc"))
    loaded = E.Encoder.load(spark, str(tmp_path / "enc"), SPEC)
    assert loaded.feature_names == encoder.feature_names and loaded.stats == encoder.stats
    with pytest.raises(FileNotFoundError, match="missing fitted vocabulary"):
        E.Encoder.load(spark, str(tmp_path / "none"), SPEC)
