"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import write_step


def _roots(parents: DataFrame) -> DataFrame:
    """Parents of parents, until every node points at a node that points at itself: the way halves each time."""
    while True:
        up = parents.select(F.col("node").alias("at"), F.col("parent").alias("above"))
        jumped = write_step(
            parents.join(up, F.col("parent") == F.col("at"), "left")
            .select("node", F.coalesce("above", "parent").alias("parent"), (F.col("above") < F.col("parent")).alias("moved")),
            "roots",
        )
        parents = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in `links`, a table of two columns of ids.

    Each round every node hooks onto its smallest neighbour, the trees are flattened, and the links are
    contracted to links between trees; what is left shrinks at least by half. Smallest neighbours are found with
    combining before the shuffle. Each step is written, so that lineage stays short and a lost executor costs little.
    """
    a, b = links.columns
    links = write_step(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links"
    )
    found = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("parent")
        )
        trees = _roots(write_step(hooked, "hooked"))
        to = lambda name: trees.select(F.col("node").alias(name), F.col("parent").alias(f"root_{name}"))
        if found is None:
            found = trees.select("node", F.col("parent").alias("component"))
        else:
            found = write_step(
                found.join(to("component"), "component", "left")
                .select("node", F.coalesce("root_component", "component").alias("component")),
                "components",
            )
        links = write_step(
            links.join(to("a"), "a").join(to("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .filter("a <> b").distinct(),
            "links",
        )
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
