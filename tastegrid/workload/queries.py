"""Registered queries: each runs an operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.config import DOMAINS, TOP_N, DomainConfig
from tastegrid.operators import cleaning, diagnostics, evaluation, interactions, positions
from tastegrid.operators import network as N
from tastegrid.operators import ranking as R
from tastegrid.operators import rules as G
from tastegrid.operators import scoring as S
from tastegrid.operators import split as P
from tastegrid.operators import training as T
from tastegrid.operators.encoding import Encoder, item_spec, statistics, user_spec, vocabulary
from tastegrid.plans import feature_build, recommend
from tastegrid.plans.score_store import ScoreStore
from tastegrid.session import cut_lineage, shared_path, stored
from tastegrid.sinks import results as K
from tastegrid.workload import adapters as A
from tastegrid.workload.files import file_queries

Query = Callable[[SparkSession, str], DataFrame]
LOGS = {"wide": A.watch_log_wide, "dense": A.watch_log_dense}
HEAD = 100


def clean_users(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_users(A.users(spark, d), A.AS_OF_YEAR)


def clean_items(spark: SparkSession, d: str, domain: DomainConfig, keep=()) -> DataFrame:
    return cleaning.clean_items(A.catalogue(spark, d), domain, keep=keep)


def check_weights(width: int, net) -> N.Weights:
    """Weights by a rule that the SQL side repeats; all are multiples of 1/32."""
    half = width // 2

    def rule(tensor: int, rows: int, cols: int) -> np.ndarray:
        j, i = np.mgrid[0:rows, 0:cols]
        return ((7 * i + 13 * j + 5 * tensor) % 31 - 15) / 32.0

    w: N.Weights = {}
    tensor = 0
    for branch, layers in N.branches(net):
        for layer in range(layers):
            at = f"{branch}.{layer}"
            w[f"{at}.w"] = rule(tensor, half, width)
            w[f"{at}.b"] = rule(tensor + 1, 1, width)[0]
            w[f"{at}.ln_g"] = 1.0 + rule(tensor + 2, 1, half)[0]
            w[f"{at}.ln_b"] = rule(tensor + 3, 1, half)[0]
            if net.gated:
                w[f"{at}.gate_w"] = rule(tensor + 4, half, half)
                w[f"{at}.gate_b"] = rule(tensor + 5, 1, half)[0]
            if net.batch_norm:
                w[f"{at}.bn_g"] = 1.0 + rule(tensor + 6, 1, half)[0]
                w[f"{at}.bn_b"] = rule(tensor + 7, 1, half)[0]
                w[f"{at}.bn_mean"] = rule(tensor + 8, 1, half)[0]
                w[f"{at}.bn_var"] = 1.0 + rule(tensor + 9, 1, half)[0]
            tensor += 10
        w[f"{branch}.fc_w"] = 4.0 * rule(tensor, 1, width)[0]
        w[f"{branch}.fc_b"] = rule(tensor + 1, 1, 1)[0]
        tensor += 10
    return w


# -- cleaning and encoding -----------------------------------------------------

def user_features(spark: SparkSession, d: str) -> DataFrame:
    users = clean_users(spark, d)
    wide = Encoder.fit(users, user_spec()).wide(users)
    return wide.withColumn("birthday", F.round("birthday", 6))


def item_features_wide(spark: SparkSession, d: str) -> DataFrame:
    domain = DOMAINS["movie"]
    items = clean_items(spark, d, domain)
    wide = Encoder.fit(items, item_spec(domain)).wide(items)
    return wide.withColumn("content_publish_year", F.round("content_publish_year", 6))


def feature_vocab(spark: SparkSession, d: str) -> DataFrame:
    domain = DOMAINS["movie"]
    return vocabulary(clean_users(spark, d), user_spec()).unionByName(
        vocabulary(clean_items(spark, d, domain), item_spec(domain))
    ).withColumn("ordinal", F.col("ordinal").cast("bigint"))


def feature_stats(spark: SparkSession, d: str) -> DataFrame:
    domain = DOMAINS["movie"]
    return statistics(clean_users(spark, d), user_spec()).unionByName(
        statistics(clean_items(spark, d, domain), item_spec(domain))
    ).select("source", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


def item_clean(domain: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        items = clean_items(spark, d, DOMAINS[domain])
        if "content_publish_year" not in items.columns:
            return items
        return items.withColumn("content_publish_year", F.round("content_publish_year", 6))

    return run


def item_filtered_head(spark: SparkSession, d: str) -> DataFrame:
    items = clean_items(spark, d, DOMAINS["all"], keep=["item_ord"])
    return cleaning.head(cleaning.active_items(items), HEAD, ["item_ord"]).select(
        "item_ord", "content_id", "tag_names", "content_duration"
    )


def user_head(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.head(clean_users(spark, d), HEAD, ["username"])


# -- interactions --------------------------------------------------------------

def train_rows(domain: str, form: str) -> Query:
    """The training set in named columns; the SQL side checks the unencoded ones."""
    config = DOMAINS[domain]

    def run(spark: SparkSession, d: str) -> DataFrame:
        users, items = clean_users(spark, d), clean_items(spark, d, config)
        rows = interactions.training_rows(
            LOGS[form](spark, d),
            Encoder.fit(users, user_spec()).wide(users.distinct()),
            Encoder.fit(items, item_spec(config)).wide(cleaning.distinct_items(items, config)),
            config,
        )
        columns = ["username", "content_id", "profile_id", "sex", "content_status", "label"]
        rounded = ["birthday", "content_duration", *config.scaled]
        return rows.select(*columns, *[F.round(c, 6).alias(c) for c in rounded])

    return run


def training_positions(spark: SparkSession, d: str) -> DataFrame:
    """Which columns of a training row are set, one-hot and multi-hot ones included."""
    _, rows = matrix(spark, d, DOMAINS["movie"], "wide")
    listed = F.array_join(F.array_sort("idx").cast("array<string>"), ",")
    return rows.select("username", "content_id", "profile_id", "label",
                       F.md5(listed).alias("positions"))


def watch_counts_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Users and items that occur in several different rows multiply the joined rows."""
    domain = DOMAINS["movie"]
    users = clean_users(spark, d).distinct()
    items = clean_items(spark, d, domain, keep=["item_ord"]).distinct()
    users = users.unionByName(
        users.where("birthday % 5 = 0").withColumn("package_code", F.lit("again"))
    )
    items = items.unionByName(
        items.where("item_ord % 3 = 0").withColumn("content_status", F.lit(9))
    ).drop("item_ord", "tag_names")
    return interactions.labelled_views(A.watch_log_dense(spark, d), users, items, domain).select(
        "username", "content_id", "profile_id", "duration", "package_code", "content_status",
        "watch_count", F.round("share", 6).alias("share"), "label",
    )


def watch_counts(form: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        domain = DOMAINS["movie"]
        users = clean_users(spark, d).distinct()
        items = cleaning.distinct_items(clean_items(spark, d, domain), domain)
        return interactions.labelled_views(LOGS[form](spark, d), users, items, domain).select(
            "username", "content_id", "profile_id", "duration", "watch_count",
            F.round("share", 6).alias("share"), "label",
        )

    return run


def matrix(spark: SparkSession, d: str, domain: DomainConfig, form: str):
    features = feature_build.fit_features(
        A.users(spark, d), A.catalogue(spark, d), domain, A.AS_OF_YEAR
    )
    return features, feature_build.training_matrix(LOGS[form](spark, d), features, domain)


def training_matrix(domain: str, form: str) -> Query:
    """Per row: label, number of entries and a position-weighted sum of the values."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        _, rows = matrix(spark, d, DOMAINS[domain], form)
        weighted = F.aggregate(
            F.zip_with("idx", "val", lambda i, v: (i + 1) * v), F.lit(0.0), lambda a, x: a + x
        )
        return rows.select(
            "username", "content_id", "profile_id", "label",
            F.size("idx").cast("bigint").alias("entries"),
            F.round(weighted, 5).alias("weighted"),
        )

    return run


def log_slices(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice"]
    lines = A.table(spark, d, "lineitem").select(*columns)
    placed = positions.with_positions(lines, columns)
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                         positions.slice_number().alias("slice"))


def log_file_slices(spark: SparkSession, d: str) -> DataFrame:
    placed = positions.read_with_positions(
        spark, f"{d.rstrip('/')}/events.parquet", ["event_id", "user_id", "value"]
    )
    return placed.select("event_id", "user_id", "value", "position",
                         positions.slice_number().alias("slice"))


def join_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    items = clean_items(spark, d, DOMAINS["all"]).drop("tag_names")
    return diagnostics.join_diagnostics(A.watch_log_wide(spark, d), clean_users(spark, d), items)


def join_estimates(spark: SparkSession, d: str) -> DataFrame:
    """Ids along the joins from sketches, the log's merged from those of its thirds."""
    log, third = A.watch_log_wide(spark, d), F.pmod("profile_id", F.lit(3))
    keys = ["username", "content_id"]
    parts = log.groupBy(third.alias("part")).agg(F.count(F.lit(1)).alias("rows"), *[
        F.theta_sketch_agg(F.col(k), diagnostics.SKETCH_LG_K).alias(k) for k in keys
    ]).drop("part")
    return diagnostics.join_estimates(
        diagnostics.merged_sketches(parts),
        diagnostics.id_sketches(clean_users(spark, d), ["username"]),
        diagnostics.id_sketches(clean_items(spark, d, DOMAINS["all"]), ["content_id"]),
    )


def content_overlap(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.content_overlap(
        A.watch_log_wide(spark, d), clean_items(spark, d, DOMAINS["all"])
    )


# -- split ---------------------------------------------------------------------

def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    _, rows = matrix(spark, d, DOMAINS["movie"], "wide")
    return P.class_distribution(rows).withColumn("percent", F.round("percent", 6))


def pos_weight(spark: SparkSession, d: str) -> DataFrame:
    _, rows = matrix(spark, d, DOMAINS["movie"], "wide")
    return P.positive_weight(rows).select(F.round("pos_weight", 6).alias("pos_weight"))


def split_counts(domain: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        config = DOMAINS[domain]
        _, rows = matrix(spark, d, config, "wide")
        labels = cut_lineage(rows.select("row_key", "label"))
        return P.split_counts(P.stratified_split(labels, config.validation_share))

    return run


# -- rules ---------------------------------------------------------------------

def profiles(spark: SparkSession, d: str) -> DataFrame:
    return R.profile_features(A.watch_log_wide(spark, d), clean_users(spark, d))


def content_meta(spark: SparkSession, d: str) -> DataFrame:
    return R.content_meta(A.catalogue(spark, d))


def tag_map(spark: SparkSession, d: str) -> DataFrame:
    return G.tag_map(A.tags(spark, d))


def rule_map(spark: SparkSession, d: str) -> DataFrame:
    """The rules that list only tags of the dictionary (or the unknown tag)."""
    ids = G.tag_map(A.tags(spark, d)).select(F.col("tag_id").cast("string").alias("tag"))
    listed = G.rule_map(A.rules(spark)).withColumn("tag", F.explode("rule_tags"))
    unknown = listed.where("tag <> 'None'").join(ids, "tag", "left_anti").select("rule_ord")
    return (
        listed.join(unknown, "rule_ord", "left_anti")
        .select("rule_ord", "list_tags_id", "rule_id").distinct()
    )


def _shown_items(spark: SparkSession, d: str) -> DataFrame:
    meta = R.content_meta(A.catalogue(spark, d))
    return R.with_meta(meta.select("content_id"), meta)


def item_rules(plan) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return plan(_shown_items(spark, d), G.tag_map(A.tags(spark, d)), A.rules(spark))

    return run


# -- scoring -------------------------------------------------------------------

def scored(spark: SparkSession, d: str, domain: DomainConfig, form: str) -> DataFrame:
    features, rows = matrix(spark, d, domain, form)
    width = features.width
    return S.score_rows(
        rows, check_weights(width, domain.network), domain.network, width,
        ["username", "content_id", "profile_id", "label"],
    )


def score_crossnet(domain: str, form: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = scored(spark, d, DOMAINS[domain], form)
        return rows.select(
            "username", "content_id", "profile_id", "label",
            *[F.round(c, 6).alias(c) for c in ("score", "score_deep", "score_shallow")],
        )

    return run


def on_scored(metric: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        found = metric(scored(spark, d, DOMAINS["movie"], "dense"))
        return found.select(*[
            (F.round(f.name, 6) if f.dataType.typeName() == "double" else F.col(f.name))
            .alias(f.name) for f in found.schema.fields
        ])

    return run


def tri_bce_weighted(rows: DataFrame) -> DataFrame:
    return evaluation.tri_bce(rows, evaluation.root_weights)


def tri_bce_balanced(rows: DataFrame) -> DataFrame:
    return evaluation.tri_bce(rows, evaluation.balanced_weights)


def _scoring_inputs(spark: SparkSession, d: str, name: str = "movie", catalogue=A.catalogue):
    domain = DOMAINS[name]
    users, catalogue = A.users(spark, d), catalogue(spark, d)
    fitted = feature_build.fit_features(users, catalogue, domain, A.AS_OF_YEAR)
    features = feature_build.apply_features(
        users, catalogue, fitted.user_encoder, fitted.item_encoder, domain, A.AS_OF_YEAR
    )
    features = replace(features, items=stored(features.items, "items"))  # read several times
    return domain, catalogue, features, check_weights(features.width, domain.network)


def topn_crossnet(form: str, name: str = "movie", catalogue=A.catalogue, **plan) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        domain, _, features, weights = _scoring_inputs(spark, d, name, catalogue)
        found = recommend.rank_profiles(LOGS[form](spark, d), features, weights, domain, **plan)
        return found.by_profile().select(
            "profile_id", F.col("rank").cast("bigint").alias("rank"), "content_id",
            F.round("score", 7).alias("score"),
        )

    return run


def topn_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The dense log's lists, where an earlier run has stored those of some profiles."""
    domain, _, features, weights = _scoring_inputs(spark, d)
    log = A.watch_log_dense(spark, d)
    store = ScoreStore.of(
        spark, shared_path(spark, "class-ranks"), features.items, weights, TOP_N,
        wave_pairs=50_000,
    )
    recommend.rank_profiles(
        log.where("profile_id % 2 = 0"), features, weights, domain, store=store
    )
    found = recommend.rank_profiles(log, features, weights, domain, store=store)
    return found.by_profile().select(
        "profile_id", F.col("rank").cast("bigint").alias("rank"), "content_id",
        F.round("score", 7).alias("score"),
    )


def _results(spark: SparkSession, d: str, form: str) -> DataFrame:
    domain, catalogue, features, weights = _scoring_inputs(spark, d)
    info = recommend.item_info(features.items, catalogue, A.tags(spark, d), A.rules(spark))
    return recommend.recommend(LOGS[form](spark, d), features, weights, domain, info)


def topn_meta(spark: SparkSession, d: str) -> DataFrame:
    return _shown_scores(_results(spark, d, "dense").select(
        "profile_id", "username", F.inline("items")
    ).withColumn("rank", F.col("rank").cast("bigint")))


def _shown_scores(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", F.round("score", 7))


def topn_null_ids(spark: SparkSession, d: str) -> DataFrame:
    """Results over a catalogue in which some items have no id: no rank is left out."""
    domain, catalogue, features, weights = _scoring_inputs(
        spark, d, catalogue=A.catalogue_with_nulls
    )
    info = recommend.item_info(features.items, catalogue, A.tags(spark, d), A.rules(spark))
    found = recommend.recommend(A.watch_log_dense(spark, d), features, weights, domain, info)
    return _shown_scores(found.select("profile_id", F.inline("items"))).select(
        "profile_id", F.col("rank").cast("bigint").alias("rank"), "content_id", "score", "rule_id"
    )


def rulename(spark: SparkSession, d: str) -> DataFrame:
    return R.rulename(R.rule_groups(_results(spark, d, "dense")))


def rule_content(spark: SparkSession, d: str) -> DataFrame:
    return R.rule_content(R.rule_groups(_results(spark, d, "dense")))


def result_documents(spark: SparkSession, d: str) -> DataFrame:
    """The JSON documents, parsed back into rows."""
    entry = (
        "struct<content_name:string,tag_names:string,type_id:string,score:double,rule_id:bigint>"
    )
    parsed = F.from_json(
        "document",
        f"suggested_content map<string,{entry}>, user struct<username:string,profile_id:bigint>",
    )
    documents = K.result_documents(_results(spark, d, "dense")).select(parsed.alias("d"))
    return _shown_scores(documents.select(
        F.col("d.user.profile_id").alias("profile_id"), F.col("d.user.username").alias("username"),
        F.explode("d.suggested_content").alias("content_id", "e"),
    ).select("profile_id", "username", "content_id", "e.*"))


def scoring_counts(spark: SparkSession, d: str) -> DataFrame:
    """What a scoring run over the dense log covers and leaves out."""
    _, catalogue, features, _ = _scoring_inputs(spark, d, catalogue=A.catalogue_with_nulls)
    log = A.watch_log_dense(spark, d)
    return diagnostics.scoring_counts(
        log, R.profile_features(log, features.users), features.items, catalogue
    )


def _pass_inputs(spark: SparkSession, d: str, name: str = "movie"):
    domain = DOMAINS[name]
    domain = replace(domain, network=replace(domain.network, dropout=0.0))
    features, rows = matrix(spark, d, domain, "dense")
    width = features.width
    return domain, rows, check_weights(width, domain.network), width


def gradient_pass(spark: SparkSession, d: str) -> DataFrame:
    """Loss, confusion counts and output-layer gradients of the whole dense matrix as one
    batch, with fixed weights and without dropout: (name, position, value)."""
    domain, rows, weights, width = _pass_inputs(spark, d)
    rows = stored(rows.select("row_key", "idx", "val", "label"), "gradient-pass")
    weight = P.positive_weight(rows).first()[0]
    sums, grad = T.read_sums(
        T.gradient_sums(rows, weights, domain, width, weight, seed=0), weights
    )
    return _gradient_rows(spark, sums, grad)


def gradient_pass_all(spark: SparkSession, d: str) -> DataFrame:
    """The same for the deep network, normalised by the statistics of the whole batch: its
    tasks, two at least where there are slots, share the moments of every layer."""
    domain, rows, weights, width = _pass_inputs(spark, d, "all")
    rows = stored(rows.select("row_key", "idx", "val", "label", F.lit(0).alias("batch")), "batch")
    slots = spark.sparkContext.defaultParallelism
    tasks = min(slots, max(2, T.epoch_tasks(spark, rows.count(), 1)))
    passed = T.epoch_pass(rows, weights, T.Adam(0.0), domain, width, 1.0, 1, 0, tasks)
    return _gradient_rows(spark, passed.totals, passed.gradient)


def _gradient_rows(spark: SparkSession, sums: dict, grad: N.Weights) -> DataFrame:
    found = [("loss", 0, sums["loss"] / sums["n"])]
    found += [(c, 0, sums[c]) for c in ("n", "tp", "fp", "fn", "tn")]
    for name in ("deep.fc_w", "deep.fc_b", "shallow.fc_w", "shallow.fc_b"):
        found += [(name, k, float(g)) for k, g in enumerate(grad[name])]
    return spark.createDataFrame(found, "name string, position bigint, value double").withColumn(
        "value", F.round("value", 6)
    )


def validation_pass(spark: SparkSession, d: str) -> DataFrame:
    """Loss and metrics of the evaluation pass over the dense matrix, with fixed weights."""
    domain, rows, weights, width = _pass_inputs(spark, d)
    weight = P.positive_weight(rows).first()[0]
    found = T.evaluate(rows, weights, domain, width, weight)
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def train_history(spark: SparkSession, d: str) -> DataFrame:
    """History of a training at rate 0: equal losses, so that patience ends each round."""
    domain, rows, weights, width = _pass_inputs(spark, d)
    domain = replace(domain, learning_rate=0.0, patience=1)
    rows = stored(rows.select("row_key", "idx", "val", "label"), "history")
    split = rows.withColumn("split", F.explode(F.array(F.lit("train"), F.lit("validation"))))
    _, history = T.train(
        split, [""] * width, domain, P.positive_weight(rows).first()[0], rounds=2, epochs=9,
        batch_rows=1 << 40, weights=weights, train_auc=False,
    )
    columns = ("round", "epoch", "train_loss", "train_accuracy", "train_precision", "train_recall",
               "train_f1", "val_loss", "accuracy", "precision", "recall", "f1", "auc")
    found = spark.createDataFrame(history, T.HISTORY_SCHEMA)
    return found.select(*[F.round(c, 6).alias(c) if "round" != c != "epoch" else F.col(c)
                          for c in columns])


def model_stored(spark: SparkSession, d: str) -> DataFrame:
    """Weights and optimiser state of a model that was saved and loaded, summed per tensor."""
    domain, _, features, weights = _scoring_inputs(spark, d)
    adam = T.Adam(0.0, step=3, epoch=2)
    adam.update(weights, {k: 2.0 * v for k, v in weights.items()})
    names = [str(k) for k in range(features.width)]
    path = shared_path(spark, "model")
    T.save_model(spark, T.Model(weights, names, 0.5, 1, 2, adam.state()), path)
    model = T.load_model(spark, path, names)
    again = T.Adam(0.0)
    again.restore(model.optimiser)
    rows = [
        (kind, name, float(a.sum()), float((a.ravel() * np.arange(1, a.size + 1)).sum()),
         again.step, again.epoch)
        for kind, group in (("weight", model.weights), ("first", again.first))
        for name, a in group.items()
    ]
    return spark.createDataFrame(
        rows, "kind string, name string, total double, weighted double, step bigint, epoch bigint"
    ).withColumns({c: F.round(c, 6) for c in ("total", "weighted")})


def user_features_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Users through an encoder that was stored and loaded."""
    users, path = clean_users(spark, d), shared_path(spark, "encoder")
    Encoder.fit(users, user_spec()).save(spark, path)
    wide = Encoder.load(spark, path, user_spec()).wide(users)
    return wide.withColumn("birthday", F.round("birthday", 6))


QUERIES: dict[str, Query] = {
    "log_slices": log_slices,
    "log_file_slices": log_file_slices,
    "user_clean": clean_users,
    "user_head": user_head,
    **{f"item_clean_{d}": item_clean(d) for d in DOMAINS},
    "item_filtered_head": item_filtered_head,
    "user_features": user_features,
    "item_features_wide": item_features_wide,
    "feature_vocab": feature_vocab,
    "feature_stats": feature_stats,
    **{f"train_{d}": train_rows(d, "wide") for d in DOMAINS},
    **{f"train_{d}_dense": train_rows(d, "dense") for d in DOMAINS},
    "watch_counts": watch_counts("wide"),
    "watch_counts_dense": watch_counts("dense"),
    "watch_counts_repeated": watch_counts_repeated,
    "training_positions_movie": training_positions,
    "training_matrix_movie": training_matrix("movie", "wide"),
    **{f"training_matrix_{d}": training_matrix(d, "wide") for d in ("clip", "music")},
    "training_matrix_all_dense": training_matrix("all", "dense"),
    "join_diagnostics": join_diagnostics,
    "join_estimates": join_estimates,
    "content_overlap": content_overlap,
    "class_distribution": class_distribution,
    "pos_weight": pos_weight,
    "split_counts": split_counts("movie"),
    "split_counts_all": split_counts("all"),
    "profiles": profiles,
    "content_meta": content_meta,
    "tag_map": tag_map,
    "rule_map": rule_map,
    "item_rules": item_rules(G.assign_rules),
    "item_rules_division": item_rules(G.assign_rules_by_join),
    "score_crossnet": score_crossnet("movie", "wide"),
    "score_crossnet_clip": score_crossnet("clip", "dense"),
    "score_crossnet_music": score_crossnet("music", "dense"),
    "score_crossnet_all": score_crossnet("all", "dense"),
    "confusion_metrics": on_scored(evaluation.confusion),
    "roc_auc": on_scored(evaluation.roc_auc),
    "tri_bce": on_scored(evaluation.tri_bce),
    "tri_bce_weighted": on_scored(tri_bce_weighted),
    "tri_bce_balanced": on_scored(tri_bce_balanced),
    "topn_crossnet": topn_crossnet("wide"),
    "topn_crossnet_grid": topn_crossnet("dense", max_item_bytes=400_000, tile_classes=60),
    **{f"topn_crossnet_{d}": topn_crossnet("dense", d) for d in ("clip", "music", "all")},
    "topn_null_ids": topn_null_ids,
    "topn_resumed": topn_resumed,
    "topn_meta": topn_meta,
    "rulename": rulename,
    "rule_content": rule_content,
    "result_documents": result_documents,
    "scoring_counts": scoring_counts,
    "gradient_pass": gradient_pass,
    "gradient_pass_all": gradient_pass_all,
    "validation_pass": validation_pass,
    "train_history": train_history,
    "model_stored": model_stored,
    "user_features_loaded": user_features_loaded,
    **file_queries(lambda spark, d: _results(spark, d, "dense")),
}
