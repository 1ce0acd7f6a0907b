"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.sources.shared import discard, stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reached.

    Each round gives every node the smallest label among its neighbours, then the label
    of its label. Rounds are written to the shared folder, so a lost executor costs one
    round at most; a round's files go when the next one is there. Only whether something
    changed comes to the driver. Nulls, self links and repeated links are allowed; no links
    give no rows. The result is staged and may be discarded.
    """
    links = links.where("a is not null and b is not null and a <> b")
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(both.distinct(), "links")
    held = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        labels = held.select("a", "root")
        near = (
            edges.join(labels.select(F.col("a").alias("b"), "root"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "a").select(
            "a", F.col("root").alias("old"), F.least("root", "near").alias("mid")
        )
        roots = labels.select(F.col("a").alias("mid"), F.col("root").alias("far"))
        labels_next = stage(
            lower.join(roots, "mid", "left").select(
                "a", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")
            ),
            "labels",
        )
        discard(held)
        held = labels_next
        if held.where("root < old").isEmpty():
            discard(edges)
            found = held.select(F.col("a").alias("node"), "root")
            found.staged_at = held.staged_at
            return found
