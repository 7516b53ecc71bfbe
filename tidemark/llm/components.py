"""Connected components of a graph of links, for graphs larger than any one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def _to_least(links: DataFrame) -> DataFrame:
    """``node, other, least`` where ``least`` is the smallest of a node and all its others.

    The minimum is aggregated before the shuffle and joined back, so a node with very many links
    never meets in one task.
    """
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    return links.join(least, "node").withColumn("least", F.least("least", "node"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    return _to_least(both).where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))


def _small_star(links: DataFrame) -> DataFrame:
    turned = links.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    found = _to_least(turned)
    own = found.select("node", F.col("least").alias("other"))
    others = found.where("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
    return own.unionByName(others)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; a component is named by its smallest node.

    ``links`` has two long columns ``a`` and ``b``. Large-star and small-star rounds alternate, each
    written to the shared folder, until no link changes; then every node points at the smallest.
    """
    now = settle(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(),
        "links",
    )
    seen = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")), F.sum(F.col("other").cast("decimal(38,0)"))
        ).first()
        if mark == seen or mark[0] == 0:
            return now.select("node", F.col("other").alias("component"))
        seen = mark
        now = settle(_small_star(_large_star(now).distinct()).distinct(), "links")


def between(links: DataFrame, parts: DataFrame) -> DataFrame:
    """``a, b``: the links as links of whole parts (``node, component``); those within a part are left out."""
    one = parts.select(F.col("node").alias("a"), F.col("component").alias("part_a"))
    other = parts.select(F.col("node").alias("b"), F.col("component").alias("part_b"))
    ends = links.join(one, "a", "left").join(other, "b", "left")
    ends = ends.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")).where("a <> b")
    return ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` of the links that made the ``parts`` and of ``links``, without going through the former again."""
    wholes = components(between(links, parts))
    to = wholes.select(F.col("node").alias("part"), F.col("component").alias("whole"))
    moved = parts.withColumnRenamed("component", "part").join(to, "part", "left")
    # A part's own name and a node without part are no ``node`` of the parts.
    return moved.select("node", F.coalesce("whole", "part").alias("component")).unionByName(wholes)
