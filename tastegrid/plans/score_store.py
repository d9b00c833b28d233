"""Ranked items of user classes, kept between runs and completed in waves.

A class's list depends on its feature vector, the items, the model and the number of
places alone. So lists are kept under a print of the last three, and a run scores only the
classes that have none there: those of new or changed users, or those that an ended run
did not get to. A wave's rows count once its row in the commit log is written.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.operators.network import Weights
from tastegrid.operators.scoring import CLASS
from tastegrid.session import remove, stored
from tastegrid.sources.manifests import code_print, rows_print
from tastegrid.sources.tables import table_exists

#: Pairs of a class and an item that one wave scores, about.
WAVE_PAIRS = 20_000_000_000
#: Waves of a run, at most: each costs jobs and reads the items, so their number is bounded.
MAX_WAVES = 16
RANKED = (
    "class_a bigint, class_b bigint, content_id string, score double, item_ord bigint, rank int"
)
_COLUMNS = [c.split()[0] for c in RANKED.split(", ")]
_LOG = "context string, name string, classes bigint"


def context_print(items: DataFrame, weights: Weights, n: int) -> str:
    """Of everything but the class that its list of items depends on."""
    digest = hashlib.sha256()
    for name in sorted(weights):
        digest.update(f"{name}{weights[name].shape}".encode() + weights[name].tobytes())
    of_items = rows_print(items, "content_id", "item_ord", "idx", "val")
    digest.update(f"{of_items} {n} {code_print()}".encode())
    return digest.hexdigest()[:32]


@dataclass(frozen=True)
class ScoreStore:
    """Ranked lists below ``path`` that belong to one context."""

    spark: SparkSession
    path: str
    context: str
    n_items: int
    wave_pairs: int = WAVE_PAIRS

    @classmethod
    def of(
        cls, spark: SparkSession, path: str, items: DataFrame, weights: Weights, n: int, **more
    ) -> ScoreStore:
        return cls(spark, path, context_print(items, weights, n), items.count(), **more)

    def _log(self) -> DataFrame:
        if not table_exists(self.spark, f"{self.path}/commits"):
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).parquet(f"{self.path}/commits")

    def committed(self) -> DataFrame:
        """Ranked lists of all classes scored so far."""
        commits = self._log().where(F.col("context") == self.context).collect()  # one row a wave
        paths = [f"{self.path}/lists/{self.context}/{c.name}" for c in commits]
        if not paths:
            return self.spark.createDataFrame([], RANKED)
        return self.spark.read.schema(RANKED).parquet(*paths)

    def complete(
        self, classes: DataFrame, rank: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """Ranked lists of ``classes`` (and of others): ``rank`` is asked for those missing.

        Missing classes are dealt to waves by their print; each is written apart and then
        committed, so a run that ends early loses one wave.
        """
        done = self.committed().select(*CLASS).distinct()
        missing = stored(classes.join(done, [*CLASS], "left_anti"), "missing-classes")
        n = missing.count()
        waves = min(MAX_WAVES, max(1, -(-n * self.n_items // self.wave_pairs)))
        wave = F.pmod(F.xxhash64(F.lit("wave"), *CLASS), F.lit(waves))
        for k in range(waves if n else 0):
            name, part = uuid.uuid4().hex, missing.where(wave == k)
            rank(part).select(*_COLUMNS).write.parquet(f"{self.path}/lists/{self.context}/{name}")
            row = [(self.context, name, part.count())]
            self.spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").parquet(
                f"{self.path}/commits"
            )
        return self.committed()

    def forget_others(self) -> None:
        """Delete the lists of every other context."""
        others = self._log().where(F.col("context") != self.context).select("context").distinct()
        for row in others.collect():
            remove(self.spark, f"{self.path}/lists/{row.context}")
