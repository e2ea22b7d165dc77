"""Connected components of links, by contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """(v, c): the least node that each node of ``links`` (a, b) is connected with.

    In each round every node goes over to its least neighbour (twice, if that one goes on), and links are rewritten
    to what their ends went over to, until none joins two nodes. Stars take two rounds, paths a logarithm of theirs.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct().select("v", F.col("v").alias("c"))
    while not edges.isEmpty():
        ways = edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("to"))
        ways = written(ways, "ways")
        on = ways.select(F.col("v").alias("to"), F.col("to").alias("on"))
        jump = written(ways.join(on, "to", "left").select("v", F.coalesce("on", "to").alias("to")), "jumps")
        labels = written(labels.join(jump.withColumnRenamed("v", "c"), "c", "left").select("v", F.coalesce("to", "c").alias("c")), "labels")
        a = edges.join(jump.select(F.col("v").alias("a"), F.col("to").alias("x")), "a")
        b = a.join(jump.select(F.col("v").alias("b"), F.col("to").alias("y")), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = written(b.filter("a <> b").distinct(), "links")
    return labels
