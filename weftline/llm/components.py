"""Connected components of long ids, by smallest label with pointer jumping.

Every round is a written table; joins are on written tables, so that a hub with
very many edges is split by adaptive execution. Nothing is collected but the
count of labels that a round changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id on an edge.

    Null ends and loops are ignored; an empty input gives an empty result."""
    clean = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x is not null and y is not null and x <> y")
    both = materialize(clean.unionByName(clean.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = materialize(both.groupBy(F.col("x").alias("id")).agg(F.least(F.col("id"), F.min("y")).alias("component")))
    while True:
        heard = both.join(labels, both.x == labels.id).groupBy(F.col("y").alias("id")).agg(F.min("component").alias("heard"))
        lower = materialize(labels.join(heard, "id", "left").select("id", "component", F.least("component", "heard").alias("lower")))
        # a label's own label, where it has one
        own = lower.select(F.col("id").alias("lower"), F.col("lower").alias("jump"))
        after = materialize(lower.join(own, "lower", "left").select("id", "component", F.coalesce("jump", "lower").alias("next")))
        if not after.where("component <> next").limit(1).count():
            return labels
        labels = after.select("id", F.col("next").alias("component"))
