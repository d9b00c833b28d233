"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.joins import splittable_join
from tastegrid.session import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node of its component.

    Large-star and small-star steps in turn until nothing changes; each brings nodes
    nearer to the smallest, in about log(nodes) rounds. A star's smallest node is aggregated
    and joined back so that a node with many neighbours can be split over tasks.
    Each round's edges are stored and those of the round before deleted; the last ones, which
    the result reads, go with ``scratch``. Self-loops and repeated edges are fine; nulls are
    left out.
    """
    before = Scratch(edges.sparkSession)
    kept = before.stored(_tidy(edges), "edges")
    state = _state(kept)
    while True:
        after = Scratch(edges.sparkSession)
        kept = after.stored(_small_star(_large_star(kept)), "edges")
        now = _state(kept)
        before.clear()
        before = after
        if now == state:
            break
        state = now
    if scratch is not None:
        scratch.paths += before.paths
    roots = kept.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        kept.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _tidy(edges: DataFrame) -> DataFrame:
    """Different edges, the larger node first."""
    return edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _tidy(
        splittable_join(both, least, ["a"]).where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = splittable_join(edges, least, ["a"]).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return _tidy(near.unionByName(least.select("a", F.col("m").alias("b"))))
