"""The given tables presented in the shapes of the input tables.

Awkward values (nulls, bad text, zeros) are planted on purpose. ``SQL`` holds the same
views for the checks; both sides spell the same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.operators.joins import splittable_join

# Tag ids 1..16 in this order; "rod" stays out so that one tag is unknown.
TAG_WORDS = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old",
    "plate", "red", "ring", "rod", "small", "widget",
)
UNKNOWN_TAG = "rod"
# Fixed values: (rule_ord, LIST_TAGS_ID, RULE_ID); 103 must lose to 101, 106 never matches.
RULES = (
    (0, "12,13", 101), (1, "2", 102), (2, "12", 103), (3, "5,15", 104), (4, "None", 105),
    (5, "4,7", 106),
)
AS_OF_YEAR = 2025


# The stored types of the columns read here; spares a job per read.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double",
    "events": "event_id bigint, user_id bigint, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"),
        F.when(key % 13 == 0, None).when(key % 17 == 0, "n/a")
        .otherwise(F.concat(F.lit("0101"), (1950 + key % 55).cast("string"))).alias("birthday"),
        F.when(key % 11 == 0, None).when(key % 7 == 0, "x")
        .otherwise((F.col("c_nationkey") % 3).cast("string")).alias("sex"),
        F.when(key % 19 != 0, F.col("c_mktsegment")).alias("package_code"),
        F.lit("r").alias("tentinh"),
        F.lit("r").alias("province"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    return table(spark, sf_dir, "part").select(
        key.alias("item_ord"),
        key.cast("string").alias("content_id"),
        name.alias("content_name"),
        F.when(key % 23 != 0, F.replace(name, F.lit(" "), F.lit(", "))).alias("tag_names"),
        F.col("p_type").alias("type_id"),
        F.when(key % 29 == 0, "abc").when(key % 31 == 0, "0")
        .otherwise(F.col("p_size").cast("string")).alias("content_duration"),
        (key % 2).cast("string").alias("content_status"),
        F.col("p_brand").alias("VOD_CODE"),
        F.when(key % 37 != 0, F.replace(name, F.lit(" "), F.lit(","))).alias("content_cate_id"),
        F.when(key % 41 == 0, "unknown")
        .otherwise(F.concat((1980 + F.col("p_size")).cast("string"), F.lit("-01-01")))
        .alias("content_publish_year"),
        F.concat(F.lit("C"), (key % 5).cast("string")).alias("content_country"),
        F.lit("1").alias("content_single"),
    )


def catalogue_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue without the ids of some items."""
    return catalogue(spark, sf_dir).withColumn(
        "content_id", F.when(F.col("item_ord") % 43 != 0, F.col("content_id"))
    )


def watch_log_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form A: many profiles and contents, few repeats (lineitem through orders)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # a fixed number of partitions: merged ones hold sorts and sums of a gigabyte in a task;
    # names come with the orders, as a join of all lines by customer would be merged again
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        .join(names, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "c_name").repartition(parts, "o_orderkey")
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("c_name").alias("username"),
        F.col("l_partkey").cast("string").alias("content_id"),
        F.col("l_quantity").alias("duration"),
        F.col("o_custkey").alias("profile_id"),
    )


def watch_log_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form B: few profiles and contents with many repeats (events)."""
    events = table(spark, sf_dir, "events").select("user_id", "value", "props", "event_id")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    # a plain join leaves the rows dealt by profile, and the views are made distinct in its tasks
    return splittable_join(events, names, ["user_id"]).select(
        F.col("c_name").alias("username"),
        F.get_json_object("props", "$.k").cast("bigint").cast("string").alias("content_id"),
        F.col("value").alias("duration"),
        F.col("user_id").alias("profile_id"),
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag dictionary of the words that occur in the part names."""
    words = F.array(*[F.lit(w) for w in TAG_WORDS])
    return (
        table(spark, sf_dir, "part")
        .select(F.explode(F.split("p_name", " ")).alias("TAG_NAME"))
        .where(F.col("TAG_NAME") != UNKNOWN_TAG)
        .select(F.array_position(words, F.col("TAG_NAME")).alias("TAG_ID"), "TAG_NAME")
        .where("TAG_ID > 0")
    )


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(RULES), "rule_ord int, LIST_TAGS_ID string, RULE_ID bigint"
    )


def many_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part: the tags of its name's first two words; most lists repeat."""
    words = F.array(*[F.lit(w) for w in TAG_WORDS])
    name = F.split("p_name", " ")
    ids = F.transform(F.slice(name, 1, 2), lambda w: F.array_position(words, w).cast("string"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("rule_ord"), F.array_join(ids, ",")
        .alias("LIST_TAGS_ID"), (F.col("p_partkey") + 1000).alias("RULE_ID"),
    )


def repeated_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every part name with the part's key as its id."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("TAG_ID"), F.explode(F.split("p_name", " ")).alias("TAG_NAME")
    )


SQL = {
    "users": """
SELECT c_name AS username,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'n/a'
       ELSE '0101' || CAST(1950 + c_custkey % 55 AS VARCHAR) END AS birthday,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'x'
       ELSE CAST(c_nationkey % 3 AS VARCHAR) END AS sex,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS package_code
FROM customer""",
    "catalogue": """
SELECT p_partkey AS item_ord, CAST(p_partkey AS VARCHAR) AS content_id, p_name AS content_name,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE replace(p_name, ' ', ', ') END AS tag_names,
  p_type AS type_id,
  CASE WHEN p_partkey % 29 = 0 THEN 'abc' WHEN p_partkey % 31 = 0 THEN '0'
       ELSE CAST(p_size AS VARCHAR) END AS content_duration,
  CAST(p_partkey % 2 AS VARCHAR) AS content_status, p_brand AS VOD_CODE,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE replace(p_name, ' ', ',') END AS content_cate_id,
  CASE WHEN p_partkey % 41 = 0 THEN 'unknown'
       ELSE CAST(1980 + p_size AS VARCHAR) || '-01-01' END AS content_publish_year,
  'C' || CAST(p_partkey % 5 AS VARCHAR) AS content_country, '1' AS content_single
FROM part""",
    "log_wide": """
SELECT c_name AS username, CAST(l_partkey AS VARCHAR) AS content_id,
       l_quantity AS duration, o_custkey AS profile_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "log_dense": """
SELECT c_name AS username,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS content_id,
       value AS duration, user_id AS profile_id
FROM events JOIN customer ON user_id = c_custkey""",
}
