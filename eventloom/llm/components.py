"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (whole numbers ``a`` and ``b``).

    Large and small stars by turns: each node links its larger neighbours to the smallest node it knows, then
    itself and its smaller neighbours. The links shrink to one star for each component within about log^2 rounds.
    A round is two sums with map-side combine, each joined back on its key; a node with very many links is a
    skewed partition of a plain join, which adaptive execution splits. Every round is written, so a lost executor repeats one round at most.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = written(links.distinct())
    before = _signature(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(pairs).alias("p")).select("p.*").where("u <> v").distinct()
        now = written(small)
        after = _signature(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
