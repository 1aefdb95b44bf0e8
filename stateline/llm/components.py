"""Connected components by contraction, with every round written to the scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.llm.scratch import landed


def components(edges: DataFrame) -> DataFrame:
    """For each vertex of the links ``a, b`` (longs) its component: rows ``vertex, component``.

    In a round each vertex joins its smallest neighbour, if that is smaller, and the links are drawn
    between what they joined. At least half of the vertices that still have links disappear in each
    round. Vertices and links stay in tables; the driver sees only whether any link is left. The result
    is a table, too, so that whoever uses it more than once does not plan and run all rounds again.
    """
    edges = landed(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    rounds: list[DataFrame] = []
    while True:
        ends = edges.select(F.col("a").alias("vertex"), F.col("b").alias("other"))
        ends = ends.unionByName(edges.select(F.col("b").alias("vertex"), F.col("a").alias("other")))
        least = F.least("vertex", F.min("other")).alias("parent")
        parents = landed(ends.groupBy("vertex").agg(least), "parents")
        rounds.append(parents)
        a = parents.select(F.col("vertex").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("vertex").alias("b"), F.col("parent").alias("pb"))
        drawn = edges.join(a, "a").join(b, "b").where(F.col("pa") != F.col("pb"))
        edges = landed(drawn.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            break

    found = rounds.pop().select("vertex", F.col("parent").alias("component"))
    for parents in reversed(rounds):
        above = found.select(F.col("vertex").alias("parent"), "component")
        component = F.coalesce("component", "parent").alias("component")
        found = landed(parents.join(above, "parent", "left").select("vertex", component), "components")
    return found
