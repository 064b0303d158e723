"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, nodes: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(fp, least): the least ``least`` that links reach from each fp; nodes: (fp, least), one row per fp.

    Each round takes the least label among a node's neighbours and then the label of the label's owner, so that
    long chains shrink geometrically; every round is written to the shared folder.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(nodes.join(both.select(F.col("a").alias("fp")).distinct(), "fp", "left_semi").select("fp", "least", F.col("fp").alias("owner")), "labels")
    for _ in range(max_rounds):
        seen = both.join(labels.select(F.col("fp").alias("b"), "least", "owner"), "b").groupBy(F.col("a").alias("fp")).agg(F.min(F.struct("least", "owner")).alias("best"))
        hop = labels.join(seen, "fp", "left").select("fp", F.col("least").alias("was"), F.least(F.struct("least", "owner"), F.coalesce("best", F.struct("least", "owner"))).alias("now"))
        hop = hop.select("fp", "was", F.col("now.least").alias("least"), F.col("now.owner").alias("owner"))
        up = labels.select(F.col("fp").alias("owner"), F.struct(F.col("least"), F.col("owner")).alias("above"))
        jumped = hop.join(up, "owner", "left").select("fp", "was", F.least(F.struct("least", "owner"), F.coalesce("above", F.struct("least", "owner"))).alias("now"))
        step = written(jumped.select("fp", F.col("now.least").alias("least"), F.col("now.owner").alias("owner"), (F.col("now.least") != F.col("was")).alias("moved")), "labels")
        labels = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return labels.select("fp", "least")


def labels_of(links: DataFrame) -> DataFrame:
    """(node, label): the least node that links (a, b) reach from each node that has any."""
    ends = links.select(F.col("a").alias("fp")).union(links.select(F.col("b").alias("fp"))).distinct()
    return components(links, ends.select("fp", F.col("fp").alias("least"))).select(F.col("fp").alias("node"), F.col("least").alias("label"))
