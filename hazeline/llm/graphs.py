"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.session import materialise


def components(links: DataFrame) -> DataFrame:
    """Smallest id of each id's component: (id, root), for ids that occur in ``links`` (a, b).

    Each round takes the smallest root of the neighbours and then the root's root, so the number of rounds is about the
    logarithm of the longest path. Only joins and minima: no component meets in one task.
    """
    both = materialise(links.select("a", "b").where("a != b").unionByName(links.selectExpr("b AS a", "a AS b").where("a != b"))
                       .distinct(), "links")
    roots = materialise(both.groupBy("a").agg(F.min("b").alias("low"))
                        .select(F.col("a").alias("id"), F.least("a", "low").alias("root")), "roots")
    while True:
        near = (both.join(roots.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("root").alias("low"))
                .withColumnRenamed("a", "id"))
        step = materialise(roots.join(near, "id").select("id", "root", F.least("root", "low").alias("new")), "roots")
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("far"))
        done = step.where("root != new").isEmpty()
        if done:
            return step.select("id", F.col("new").alias("root"))
        roots = materialise(step.join(jump, "new").select("id", F.least("new", "far").alias("root")), "roots")
