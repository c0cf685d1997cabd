"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktally.llm.common import cut


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``x, y``): the least node of its component.

    Every round a node takes the least label among its neighbours', then the label
    of its label, so that chains halve. Each round is a written table; what a node
    with very many links does is a minimum, combined before it is shuffled.
    """
    both = cut(
        links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(),
        "component-links",
    )
    labels = cut(
        both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("label")).select("node", "label"),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("y"), "label"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = cut(
            labels.join(near, "node").select(
                "node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")
            ),
            "component-lower",
        )
        if lower.where("moved").isEmpty():
            return labels
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = cut(
            lower.join(up, "label").select("node", F.least("label", "up").alias("label")), "component-labels"
        )
