"""Connected components of a table of links, by alternating stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.scratch import session_scratch, written
from tally.sources.scratch import Scratch


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None, files: int | None = None) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Nodes without a link are not listed.

    Each round joins every node's larger neighbours to its smallest one, then its smaller ones likewise. The smallest
    neighbour is a minimum that is taken before the shuffle as well, and comes back by a join whose large keys adaptive
    execution can split, so a node with a third of all links is no single task's work. Rounds end when each node has
    larger neighbours only or just one smaller neighbour, as the links are stars then and these minima the result; their
    number grows with the logarithm of the longest path. Every round is written to the shared folder and the one before
    it deleted. Null nodes link with nothing; repeated links, links of a node to itself and an empty table need no care.
    ``files``: see ``written``.
    """
    scratch = scratch or session_scratch(links.sparkSession)
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v"), "links", scratch, files)
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
        least = written(least.select("u", F.least("u", "low").alias("m"), F.expr("low > u or low = high").alias("ends")), "least", scratch, files)
        if least.where("not ends").isEmpty():
            scratch.drop(edges)
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: u and every smaller neighbour go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        new = written(small.where("u <> v").distinct(), "links", scratch, files)
        scratch.drop(edges, least)
        edges = new
