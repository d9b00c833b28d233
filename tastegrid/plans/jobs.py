"""The two jobs a domain is run with: train a model, and recommend with it.

Inputs lie under one root; every result is a table or file set under the domain's work
folder. Stage results that are read more than once are stored first, so a lost executor
rereads them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tastegrid.config import TOP_N, DomainConfig
from tastegrid.operators import cleaning, diagnostics, positions
from tastegrid.operators import ranking as R
from tastegrid.operators import rules as G
from tastegrid.operators import training as T
from tastegrid.operators.encoding import Encoder, item_spec, user_spec
from tastegrid.plans import feature_build, recommend
from tastegrid.plans.feature_build import Features
from tastegrid.plans.fit_model import fit_model
from tastegrid.plans.score_store import ScoreStore
from tastegrid.sinks import results as K
from tastegrid.sources import catalogue as C
from tastegrid.sources import logs, manifests, tables
from tastegrid.sources.manifests import Origin
from tastegrid.sources.tags import read_tags


@dataclass(frozen=True)
class Layout:
    """Where the inputs lie and where results go."""

    log: str
    users: str
    catalogue: str
    tags: str
    rules: str
    work: str

    @classmethod
    def under(cls, root: str, work: str | None = None) -> Layout:
        """The usual names below one folder."""
        root = root.rstrip("/")
        return cls(
            f"{root}/log", f"{root}/users.parquet", f"{root}/catalogue", f"{root}/tags",
            f"{root}/rules.parquet", work or f"{root}/work",
        )

    def of(self, domain: DomainConfig, name: str) -> str:
        return f"{self.work.rstrip('/')}/{domain.name}/{name}"


def catalogue_origin(spark: SparkSession, layout: Layout, domain: DomainConfig) -> Origin:
    pattern = "{" + ",".join(domain.catalogue_globs) + "}"
    return manifests.origin(spark, {"catalogue": (layout.catalogue, pattern)}, files=pattern)


def merged_catalogue(
    spark: SparkSession, layout: Layout, domain: DomainConfig, stale: str = "rebuild",
    now: Origin | None = None,
) -> DataFrame:
    """The domain's catalogue as one table, with its order as ``item_ord``.

    A stored table serves as long as the files are those it was made from. ``now``: the
    files' print, where the caller has it; else they are listed for it.
    """
    def build() -> DataFrame:
        good, broken = C.read_catalogue(spark, layout.catalogue, domain)
        broken.write.mode("overwrite").parquet(layout.of(domain, "broken_catalogue_files"))
        placed = positions.with_positions(good, ["source_file", "_at"])
        return placed.withColumnRenamed("position", "item_ord").drop("_at", "total", "source_file")

    return manifests.build_if_changed(
        spark, layout.of(domain, "catalogue"), now or catalogue_origin(spark, layout, domain),
        build, stale,
    )


def _stored(spark: SparkSession, features: Features, layout: Layout, domain: DomainConfig,
            prefix: str) -> Features:
    """The same features, read back from their stored tables."""
    paths = [layout.of(domain, f"{prefix}_{side}") for side in ("users", "items")]
    for path, table in zip(paths, (features.users, features.items), strict=True):
        table.write.mode("overwrite").parquet(path)
    users, items = (spark.read.parquet(p) for p in paths)
    return Features(features.user_encoder, features.item_encoder, users, items)


def training_origin(
    spark: SparkSession, layout: Layout, domain: DomainConfig, year: int,
    catalogue: Origin | None = None,
) -> Origin:
    """What the training matrix depends on: all inputs, the domain and the year."""
    inputs = manifests.origin(
        spark, {"log": layout.log, "users": layout.users}, domain=domain, year=year
    )
    return inputs | (catalogue or catalogue_origin(spark, layout, domain))


def build_training_set(
    spark: SparkSession, layout: Layout, domain: DomainConfig, as_of_year: int | None = None,
    stale: str = "rebuild",
) -> tuple[DataFrame, list[str]]:
    """(training matrix, feature names); encoders, encoded tables and matrix are stored.

    A stored matrix serves as long as inputs, domain, year and code are those it was made
    from.
    """
    year = as_of_year or date.today().year
    catalogue = catalogue_origin(spark, layout, domain)

    def build() -> DataFrame:
        log, report = logs.read_watch_log(spark, layout.log)
        report.write.mode("overwrite").parquet(layout.of(domain, "log_files"))
        fitted = feature_build.fit_features(
            tables.read_table(spark, layout.users),
            merged_catalogue(spark, layout, domain, stale, catalogue), domain, year,
        )
        fitted.user_encoder.save(spark, layout.of(domain, "user_encoder"))
        fitted.item_encoder.save(spark, layout.of(domain, "item_encoder"))
        features = _stored(spark, fitted, layout, domain, "train")
        return feature_build.training_matrix(log, features, domain)

    matrix = manifests.build_if_changed(
        spark, layout.of(domain, "training_matrix"),
        training_origin(spark, layout, domain, year, catalogue), build, stale,
    )
    return matrix, [n for e in _encoders(spark, layout, domain) for n in e.feature_names]


def _encoders(
    spark: SparkSession, layout: Layout, domain: DomainConfig
) -> tuple[Encoder, Encoder]:
    return (
        Encoder.load(
            spark, layout.of(domain, "user_encoder"),
            user_spec(cleaning.extra_numeric(tables.read_table(spark, layout.users))),
        ),
        Encoder.load(spark, layout.of(domain, "item_encoder"), item_spec(domain)),
    )


def train_domain(
    spark: SparkSession, layout: Layout, domain: DomainConfig, as_of_year: int | None = None,
    stale: str = "rebuild", resume: bool = False, **options,
) -> list[tuple]:
    """Train, from the stored matrix if it is up to date; keep the model if it is better.

    ``resume`` goes on from the stored model, its optimiser's state included; otherwise
    training begins anew. Returns the history, which is stored as well.
    """
    matrix, names = build_training_set(spark, layout, domain, as_of_year, stale)
    model_path = layout.of(domain, "model")
    meta = T.latest_meta(spark, model_path)
    earlier = meta.loss if meta else math.inf
    if resume and meta:
        options["resume"] = T.load_model(spark, model_path, names)
    _, history = fit_model(
        matrix, names, domain, earlier_loss=earlier,
        on_best=lambda model: T.save_model(spark, model, model_path), **options,
    )
    spark.createDataFrame(history, T.HISTORY_SCHEMA).write.mode("append").parquet(
        layout.of(domain, "history")
    )
    return history


def recommend_domain(
    spark: SparkSession, layout: Layout, domain: DomainConfig, as_of_year: int | None = None,
    n: int = TOP_N, num_users: int = -1, num_items: int = -1, rule_sep: str = "",
    stale: str = "rebuild", **plan,
) -> DataFrame:
    """Score every profile of the log and write the result table and its three shapes.

    The stored catalogue serves while its files are the same (``stale`` says what else).
    Lists of user classes are kept: a run after a failure, or with few changed
    users, scores only the classes that have none for this model and these items. Also
    written: the tag mapping, the item information, and the counts of the run.
    """
    user_encoder, item_encoder = _encoders(spark, layout, domain)
    model = T.load_model(
        spark, layout.of(domain, "model"),
        [*user_encoder.feature_names, *item_encoder.feature_names],
    )
    catalogue = merged_catalogue(spark, layout, domain, stale)
    features = _stored(spark, feature_build.apply_features(
        tables.read_table(spark, layout.users), catalogue, user_encoder, item_encoder, domain,
        as_of_year or date.today().year, num_users, num_items,
        item_encoder.stats.get("content_publish_year", (None,))[0],
    ), layout, domain, "score")
    info_path, result_path = (layout.of(domain, p) for p in ("item_info", "results"))
    tags = read_tags(spark, layout.tags)
    G.tag_map(tags, "source_order").write.mode("overwrite").parquet(layout.of(domain, "tag_map"))
    recommend.item_info(
        features.items, catalogue, tags,
        tables.read_rules(spark, layout.rules), tag_order="source_order",
    ).write.mode("overwrite").parquet(info_path)
    log, _ = logs.read_watch_log(spark, layout.log)
    diagnostics.scoring_counts(
        log, R.profile_features(log, features.users), features.items, catalogue
    ).write.mode("overwrite").parquet(layout.of(domain, "counts"))
    store = ScoreStore.of(
        spark, layout.of(domain, "class_ranks"), features.items, model.weights, n
    )
    recommend.recommend(
        log, features, model.weights, domain, spark.read.parquet(info_path), n, store=store, **plan
    ).write.mode("overwrite").parquet(result_path)
    store.forget_others()
    found = spark.read.parquet(result_path)
    K.write_results(found, layout.of(domain, "result_json"), mode="overwrite")
    K.write_rulename(found, layout.of(domain, "rulename_json"), mode="overwrite")
    K.write_rule_content(found, layout.of(domain, "rule_content"), rule_sep, mode="overwrite")
    return found


def compact_log(spark: SparkSession, layout: Layout, slices: int = 5) -> str:
    """Store the usable log in equal numbered parts (by file name and place in the file)."""
    _, report = logs.read_watch_log(spark, layout.log)
    paths = [r.path for r in report.where("status = 'ok'").collect()]
    placed = positions.read_with_positions(spark, sorted(paths), list(logs.LOG_TYPES))
    out = f"{layout.work.rstrip('/')}/compacted_log"
    K.write_log_slices(placed, out, slices, mode="overwrite")
    return out
