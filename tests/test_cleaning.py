import math

import pytest
from pyspark.sql import functions as F

from tastegrid.config import DOMAINS
from tastegrid.functions import text as X
from tastegrid.operators import cleaning


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_birth_year(spark):
    got = column(spark, ["01011990", "1985", "199", "1990.0", None, "1990\n"],
                 lambda c: X.birth_year(c, 2025))
    assert got == [1990, 1985, 2025, 2025, 2025, 2025]


def test_sex(spark):
    assert column(spark, ["0", "1", "2", "x", None, "00", " 0"], X.sex_flag) == [
        0, 1, 1, 1, 0, 0, 1]


def test_numeric_text(spark):
    good = ["12", " 12 ", "1e3", ".5", "+5", "-2.", "7"]
    bad = ["abc", "", "1.5d", "1f", "0x10", "1,000", "None", "nan", None]
    assert column(spark, good, X.numeric_text) == [12, 12, 1000, 0.5, 5, -2, 7]
    assert column(spark, bad, X.numeric_text) == [None] * len(bad)


def test_positive_filter_drops_nan_and_missing(spark):
    df = spark.createDataFrame([(5.0,), (0.0,), (-3.0,), (math.nan,), (None,)], "x double")
    assert [r.x for r in df.where(X.positive(F.col("x"))).collect()] == [5.0]


def test_has_word_knows_other_scripts(spark):
    assert column(spark, ["đ", "a", ", ", "", None, "_"], X.has_word) == [
        True, True, False, False, False, True]


def test_lists(spark):
    assert column(spark, ["a,b", "a,,b", "a, b", "", None, "a,"], X.category_list) == [
        ["a", "b"], ["a", "", "b"], ["a", " b"], [""], [""], ["a", ""]]
    assert column(spark, ["x, y, x", "x,y"], X.tag_name_set) == [["x", "y"], ["x,y"]]


def test_fill_missing_by_type(spark):
    df = spark.createDataFrame(
        [(None, None, math.nan, None)], "a string, b int, c double, d bigint")
    assert tuple(cleaning.fill_missing(df).first()) == ("0", 0, 0.0, 0)


def test_clean_users(spark):
    users = spark.createDataFrame(
        [("u", None, None, None, "p", "q", 3)],
        "username string, birthday string, sex string, package_code string, tentinh string, "
        "province string, logins int")
    got = cleaning.clean_users(users, 2025).first().asDict()
    assert got == {"username": "u", "birthday": 2025, "sex": 0, "package_code": "0", "logins": 3}


def catalogue(spark, rows):
    names = ("content_id", "tag_names", "type_id", "content_duration", "content_status",
             "VOD_CODE", "content_cate_id", "content_publish_year")
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_year_is_filled_with_the_mean_of_the_kept_rows(spark):
    rows = [("1", "t", "a", "10", "1", "v", "c", "2000-05"),
            ("2", "t", "a", "20", "1", "v", "c", "2010"),
            ("3", "t", "a", "5", "1", "v", "c", "soon"),
            ("4", "t", "a", "0", "1", "v", "c", "1900")]
    items = cleaning.clean_items(catalogue(spark, rows), DOMAINS["clip"])
    got = {r.content_id: r.content_publish_year for r in items.collect()}
    assert got == {"1": 2000.0, "2": 2010.0, "3": 2005.0}
    given = cleaning.clean_items(catalogue(spark, rows), DOMAINS["clip"], year_mean=1999)
    assert {r.content_publish_year for r in given.collect()} == {2000.0, 2010.0, 1999.0}


def test_active_items_and_head(spark):
    rows = [("1", "đ", "a", "1", "1", "v", "c", "2000"), ("2", ", ", "a", "1", "1", "v", "c", ""),
            ("3", None, "a", "1", "1", "v", "c", ""), ("4", "x", "a", "1", "0", "v", "c", "")]
    active = cleaning.active_items(catalogue(spark, rows))
    assert [r.content_id for r in active.collect()] == ["1"]
    assert cleaning.head(catalogue(spark, rows), 2, ["content_id"]).count() == 2
    assert cleaning.head(catalogue(spark, rows), -1, ["content_id"]).count() == 4


@pytest.mark.parametrize("name", list(DOMAINS))
def test_numeric_columns_of_each_domain(name):
    assert set(DOMAINS[name].numeric) == (
        {"content_duration", "content_status"} | ({"content_single"} if name == "movie" else set()))
