"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emolens.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the smallest neighbour."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns u, v: any order,
    repeats and loops allowed) that is not itself a root; the root is the
    smallest node of its component.

    Each round is a few joins and aggregates on narrow rows and is written,
    so rounds (logarithmic in the size of the largest component) have no
    growing lineage.  Links never go to the driver, only their count and a
    checksum to see that a round changed nothing."""
    e = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "links")
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen or now[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
        e = written(_small_star(_large_star(e).distinct()).distinct(), "links")
