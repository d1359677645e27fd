"""Connected components of a table of links, by smallest neighbours and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodica.sources.shared import store


def renamed(table: DataFrame, roots: DataFrame) -> DataFrame:
    """``id``, ``label`` with every label replaced by its root, if it has one."""
    roots = roots.select(F.col("id").alias("label"), F.col("label").alias("root"))
    return table.join(roots, "label", "left").select("id", F.coalesce("root", "label").alias("label"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``label`` of every end of a link between two nodes; nodes that links connect have one label, one of their ids.

    Every node takes the smallest id among itself and its neighbours.  Links between different labels make the
    graph of the next round, whose nodes are labels: it has at most half the nodes, so rounds grow with the
    logarithm of the nodes, and a star is finished in one.  Minima are partial aggregates before their shuffle, and the
    joins have nothing but shuffles below them, so Spark can split the rows of a node with very many links over
    tasks.  Every round is written to the shared folder.
    """
    rounds = []
    while True:
        ends = store(
            links.select(F.col(a).alias("id"), F.col(b).alias("other")).union(links.select(b, a)).where("id != other").distinct(), "links"
        )
        labels = store(ends.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")), "labels")
        rounds.append(labels)
        here, there = labels.toDF("id", a), labels.toDF("other", b)
        links = store(ends.where("id < other").join(here, "id").join(there, "other").where(F.col(a) != F.col(b)).select(a, b).distinct(), "links")
        if links.isEmpty():
            break
    out = rounds.pop()
    while rounds:
        out = store(renamed(rounds.pop(), out), "labels")
    return out
