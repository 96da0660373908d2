"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it reaches, for every node of ``links`` (a, b).

    Labels spread along links and are then looked up in themselves, so paths shrink by halves; a
    node with very many links costs a partial minimum in each task. Each round's labels are
    written to the shared folder and only one number, the changed labels, comes to the driver.
    Null ends are no links; no links give no rows.
    """
    ends = links.select("a", "b").dropna()
    both = pin(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")
    ), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        spread = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        after = pin(
            spread.join(above, "label").select(
                "node", "before", F.least("label", "above").alias("label")
            ),
            "labels",
        )
        if after.where(F.col("label") != F.col("before")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
