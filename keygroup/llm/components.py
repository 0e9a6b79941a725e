"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keygroup.workspace import materialise


def components(links: DataFrame, tag: str = "links") -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node with a link.

    ``links`` has two columns of one type, a link per row, in any direction. Each round
    points every node's larger neighbours, then its smaller ones, at its least
    neighbour; rounds go on until no link changes. Minima are aggregated before they
    are shuffled, so a node with a third of all links is no list anywhere, and every
    round is written to the shared folder.
    """
    a, b = (F.col(c) for c in links.columns)
    now = materialise(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), tag
    )
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A node without larger neighbours hands its links on through the other ends.
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), tag)
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
