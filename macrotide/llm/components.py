"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two joins on the node; links are written to the shared folder after each, so lineage
stays short and a lost executor costs tasks. The driver sees one checksum a round. A node with very
many links is an ordinary skewed join key, which adaptive execution splits; minima are combined
before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import staged


def _star(links: DataFrame, small: bool) -> DataFrame:
    """links: node > other after a small star, any order before. Large: larger neighbours go to the
    least of the neighbourhood. Small: the node and its smaller neighbours go to their least."""
    if small:
        sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b"), F.col("a")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m"))
    joined = sides.join(least, sides["u"] == least["node"])
    if small:
        out = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its least node."""
    links = staged(links.where("a <> b").select("a", "b").distinct())
    before = None
    while True:
        links = staged(_star(_star(links, small=False), small=True))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b"), F.col("b"))).groupBy("node").agg(F.min("component").alias("component"))
