"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import shared_folder, stored
from riskframe.session import drop_staged

MOST_ROUNDS = 100


def components(links: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(node, label) for every end of the links (a, b): the least node it is linked with.

    Each round takes the least label among a node's neighbours, then the label of that
    label; rounds go on until nothing changes. Minima combine before each shuffle, and
    joins on a label that many nodes share can be split, so one large component is no
    hot task. Every round's table is written to the shared folder and removed when the next
    is there.

    A link of a node with itself gives the node its own label; nodes without links are not
    returned; repeated links count once; no links give an empty result. Ends are not null.
    """
    edges = stored(
        links.select("a", "b").union(links.select("b", "a")).toDF("src", "dst").distinct(), "edges"
    )
    spark = links.sparkSession
    place = shared_folder(spark, "labels")
    labels = stored(
        edges.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("node")).alias("label")), "labels", place
    )
    for _ in range(most_rounds):
        near = (
            edges.join(labels, edges.src == labels.node)
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("label").alias("least"))
        )
        # a node's root learns of it too, so that whole trees are hooked at once
        moved = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("least"))
        roots = moved.groupBy(F.col("label").alias("node")).agg(F.min("least").alias("hook"))
        hooked = labels.join(roots, "node", "left").join(near, "node", "left")
        hooked = hooked.select("node", F.col("label").alias("old"), F.least("label", "least", "hook").alias("new"))
        up = hooked.select(F.col("node").alias("new"), F.col("new").alias("top"))
        before, place = place, shared_folder(spark, "labels")
        after = stored(
            hooked.join(up, "new", "left").select("node", "old", F.coalesce("top", "new").alias("label")), "labels", place
        )
        drop_staged(spark, before)
        if after.filter("label != old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
