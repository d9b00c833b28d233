"""Feature encoding: fitted vocabulary and statistics tables, then joins and projections.

Only dimension tables (users, items) are encoded, never the log. The vocabulary of a
fitted ``Encoder`` is a stored table of any length; positions come from a join with it.
The driver knows the number of categories per column, and their names only where a
caller asks for them.

Two layouts: ``wide`` (one named column per feature) and ``sparse`` (sorted feature
positions and their values), which is what the training and scoring jobs move.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastegrid.config import DomainConfig
from tastegrid.functions import text as X
from tastegrid.session import stored

STATS_SCHEMA = "source string, mean double, sd double"


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns of a table become features, in output order."""

    key: str
    numeric: tuple[str, ...] = ()
    one_hot: tuple[str, ...] = ()
    multi_hot: tuple[str, ...] = ()
    scaled: tuple[str, ...] = ()


def user_spec(extra_numeric: Sequence[str] = ()) -> FeatureSpec:
    return FeatureSpec(
        key="username",
        numeric=("sex", *extra_numeric),
        one_hot=("package_code",),
        scaled=("birthday",),
    )


def item_spec(domain: DomainConfig) -> FeatureSpec:
    return FeatureSpec(
        key="content_id",
        numeric=domain.numeric,
        one_hot=domain.one_hot,
        multi_hot=(domain.multi_hot,),
        scaled=domain.scaled,
    )


def category_entries(spec: FeatureSpec) -> Column:
    """A row's categories as an array of (kind, source, value)."""
    def entry(kind: str, source: str, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(source).alias("source"), value.alias("value")
        )

    def entries_of_list(source: str) -> Column:
        return F.transform(
            X.category_list(F.col(source)), lambda v: entry("multi_hot", source, v)
        )

    entries = [F.array(entry("one_hot", c, F.col(c).cast("string"))) for c in spec.one_hot]
    entries += [entries_of_list(c) for c in spec.multi_hot]
    none = F.array().cast("array<struct<kind:string,source:string,value:string>>")
    return F.concat(none, *entries)


def categories(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(kind, source, value): the distinct values of every categorical column.

    One scan for all columns; the distinct combines before its shuffle, so only the
    distinct values travel.
    """
    return df.select(F.explode(category_entries(spec)).alias("e")).select("e.*").distinct()


def vocabulary(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(kind, source, value, ordinal): categories in order of their value, null last.

    One column's categories are numbered in one window; they are as many as the model has
    columns for them.
    """
    order = Window.partitionBy("kind", "source").orderBy(F.col("value").asc_nulls_last())
    return categories(df, spec).withColumn("ordinal", F.row_number().over(order) - 1)


def statistics(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(source, mean, sd) per scaled column; population sd, zero sd read as one."""
    aggregates = [
        F.struct(
            F.lit(c).alias("source"),
            F.avg(c).alias("mean"),
            F.when(F.stddev_pop(c) == 0, 1.0).otherwise(F.stddev_pop(c)).alias("sd"),
        )
        for c in spec.scaled
    ]
    return df.agg(F.array(*aggregates).alias("s")).select(F.inline("s"))


@dataclass
class Encoder:
    """Fitted state: the stored vocabulary, the categories per column, the statistics."""

    spec: FeatureSpec
    vocab: DataFrame
    sizes: dict[tuple[str, str], int]
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    # -- fitting and tables -------------------------------------------------

    @classmethod
    def fit(cls, df: DataFrame, spec: FeatureSpec) -> Encoder:
        """One job stores the categories and the statistics and counts them on the way."""
        seen = Observation()
        state = cls._state(df, spec).observe(seen, *cls._counts(spec))
        return cls._from_counts(spec, stored(state, "encoder"), seen.get)

    @staticmethod
    def _state(df: DataFrame, spec: FeatureSpec) -> DataFrame:
        state = vocabulary(df, spec).withColumns({
            "mean": F.lit(None).cast("double"), "sd": F.lit(None).cast("double")
        })
        if spec.scaled:
            state = state.unionByName(statistics(df, spec).select(
                F.lit("scaled").alias("kind"), "source", F.lit(None).cast("string").alias("value"),
                F.lit(0).alias("ordinal"), "mean", "sd",
            ))
        return state

    @staticmethod
    def _counts(spec: FeatureSpec) -> list[Column]:
        """Categories per column, mean and sd per scaled column."""
        def of(kind: str, source: str) -> Column:
            return (F.col("kind") == kind) & (F.col("source") == source)

        counts = [F.count_if(of("one_hot", c)).alias(f"one_hot {c}") for c in spec.one_hot]
        counts += [F.count_if(of("multi_hot", c)).alias(f"multi_hot {c}") for c in spec.multi_hot]
        for c in spec.scaled:
            counts += [F.max(F.when(of("scaled", c), F.col(v))).alias(f"{v} {c}")
                       for v in ("mean", "sd")]
        return counts or [F.count(F.lit(1)).alias("rows")]

    @classmethod
    def _from_counts(cls, spec: FeatureSpec, state: DataFrame, found: dict) -> Encoder:
        sizes = {("one_hot", c): found[f"one_hot {c}"] for c in spec.one_hot}
        sizes |= {("multi_hot", c): found[f"multi_hot {c}"] for c in spec.multi_hot}
        stats = {c: (found[f"mean {c}"], found[f"sd {c}"]) for c in spec.scaled}
        vocab = state.where("kind <> 'scaled'").select("kind", "source", "value", "ordinal")
        return cls(spec, vocab, sizes, stats)

    def stats_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, *ms) for c, ms in self.stats.items()], STATS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.stats_table(spark).write.mode("overwrite").parquet(f"{path}/stats")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec) -> Encoder:
        from tastegrid.sources.tables import require_table

        vocab = require_table(spark, f"{path}/vocab", "fitted vocabulary")
        stats = require_table(spark, f"{path}/stats", "fitted statistics")
        state = vocab.unionByName(
            stats.withColumn("kind", F.lit("scaled")), allowMissingColumns=True
        )
        return cls._from_counts(spec, state, state.agg(*cls._counts(spec)).first().asDict())

    # -- layout -------------------------------------------------------------

    @cached_property
    def values(self) -> dict[tuple[str, str], list[str | None]]:
        """The ordered categories of each column, brought to the driver on demand."""
        out: dict[tuple[str, str], list[str | None]] = {k: [] for k in self.sizes}
        for row in self.vocab.orderBy("kind", "source", "ordinal").collect():
            out[row.kind, row.source].append(row.value)
        return out

    @cached_property
    def feature_names(self) -> list[str]:
        def names(kind: str, c: str) -> list[str]:
            values = self.values[kind, c]
            missing = "None" if "None" not in values else "None (missing)"
            return [f"{c}_{missing if v is None else v}" for v in values]

        hot = [n for c in self.spec.one_hot for n in names("one_hot", c)]
        multi = [n for c in self.spec.multi_hot for n in names("multi_hot", c)]
        return [*self.spec.numeric, *hot, *multi, *self.spec.scaled]

    @property
    def width(self) -> int:
        return len(self.spec.numeric) + sum(self.sizes.values()) + len(self.spec.scaled)

    def positions(self) -> DataFrame:
        """(kind, source, value, position): where each category stands in a feature row."""
        first, at = F.lit(None).cast("int"), len(self.spec.numeric)
        for kind, c in (*[("one_hot", c) for c in self.spec.one_hot],
                        *[("multi_hot", c) for c in self.spec.multi_hot]):
            first = F.when((F.col("kind") == kind) & (F.col("source") == c), F.lit(at)) \
                .otherwise(first)
            at += self.sizes[kind, c]
        return self.vocab.select(
            "kind", "source", "value", (first + F.col("ordinal")).cast("int").alias("position")
        )

    @staticmethod
    def _numeric(df: DataFrame, c: str) -> Column:
        if df.schema[c].dataType.typeName() == "string":
            return X.numeric_text(F.col(c))
        return X.no_nan(F.col(c).cast("double"))

    def _scaled(self, c: str) -> Column:
        mean, sd = self.stats[c]
        return (F.col(c) - F.lit(mean)) / F.lit(sd)

    def wide(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """One named column per feature; unknown categories are all zero."""
        columns = [F.col(c) for c in (self.spec.key, *keep, *self.spec.numeric)]
        for c in self.spec.one_hot:
            for v in self.values["one_hot", c]:
                hit = F.col(c).cast("string").eqNullSafe(F.lit(v))
                columns.append(F.when(hit, 1.0).otherwise(0.0).alias(f"{c}_{v}"))
        for c in self.spec.multi_hot:
            cats = X.category_list(F.col(c))
            for v in self.values["multi_hot", c]:
                columns.append(F.array_contains(cats, v).cast("int").alias(f"{c}_{v}"))
        columns += [self._scaled(c).alias(c) for c in self.spec.scaled]
        return df.select(*columns)

    def sparse(
        self, df: DataFrame, keep: Sequence[str] = (), log_of: str | None = None
    ) -> DataFrame:
        """(key, keep…, idx array<int>, val array<double>, usable), positions ascending.

        Missing values are 0 and take no entry. ``usable`` is false where a numeric
        column holds text that is no number; training leaves such rows out.
        ``log_of`` names the column that enters as its natural logarithm. Rows that
        agree in all that is encoded and kept become one row.
        """
        parts, at = [], 0
        bad = F.lit(False)

        def one(position: int, value: Column) -> Column:
            pair = F.struct(F.lit(position).alias("i"), value.cast("double").alias("v"))
            return pair.cast("struct<i:int,v:double>")

        for c in self.spec.numeric:
            value = self._numeric(df, c)
            if df.schema[c].dataType.typeName() == "string":
                bad = bad | (F.col(c).isNotNull() & value.isNull())
            parts.append(one(at, F.log(value) if c == log_of else value))
            at += 1
        at += sum(self.sizes.values())
        for c in self.spec.scaled:
            parts.append(one(at, self._scaled(c)))
            at += 1
        plain = F.array(*parts).cast("array<struct<i:int,v:double>>")
        rows = df.select(
            self.spec.key, *keep, plain.alias("_plain"), (~bad).alias("usable"),
            F.explode_outer(category_entries(self.spec)).alias("_c"),
        ).select(self.spec.key, *keep, "_plain", "usable", "_c.*")
        known = self.positions().select(
            *[F.col(c).alias(f"_{c}") for c in ("kind", "source", "value")], "position"
        )
        placed = rows.join(
            known,
            (F.col("kind") == F.col("_kind")) & (F.col("source") == F.col("_source"))
            & F.col("value").eqNullSafe(F.col("_value")), "left",
        ).groupBy(self.spec.key, *keep, "_plain", "usable").agg(
            F.collect_set("position").alias("_hot")
        )
        hot = F.transform("_hot", lambda i: F.struct(i.alias("i"), F.lit(1.0).alias("v")))
        entries = F.array_sort(F.filter(
            F.concat("_plain", hot),
            lambda e: e.i.isNotNull() & e.v.isNotNull() & (e.v != 0) & ~F.isnan(e.v),
        ))
        return placed.select(self.spec.key, *keep, entries.alias("_e"), "usable").select(
            self.spec.key, *keep,
            F.col("_e.i").alias("idx"), F.col("_e.v").alias("val"), "usable",
        )
