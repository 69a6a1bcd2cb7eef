"""Connected components of links of any number, in rounds of aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _low(nodes: DataFrame, node: str, low: str) -> DataFrame:
    return nodes.select(F.col("node").alias(node), F.col("low").alias(low))


def components(links: DataFrame) -> DataFrame:
    """Each node of ``links`` (columns a, b) with the smallest node of its component: node, component.

    A node's low is its smallest neighbour, or itself if that is smaller. In each round a link gives way to one between
    the lows of its ends, and a node is linked to the low of its low. That keeps what is connected connected, halves the
    depth of the trees of lows and joins their roots, so the number of rounds grows with the logarithm of the longest
    chain. It ends when every node has either larger neighbours only or one smaller neighbour only: then all links lead
    to the smallest node of a component. A round writes two tables. Lows are staged before they are joined, so that a
    node with very many neighbours is a skewed join, which Spark splits. Null and self links are dropped; an empty input
    gives an empty result. The result is a staged table.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    smaller = F.col("other") < F.col("node")
    while True:
        both = edges.selectExpr("a as node", "b as other").unionByName(edges.selectExpr("b as node", "a as other"))
        nodes = staged(
            both.groupBy("node").agg(
                F.least(F.min("other"), F.col("node")).alias("low"),
                F.count_if(smaller).alias("below"), F.count_if(~smaller).alias("above"),
            ),
            "nodes",
        )
        if nodes.where("below > 1 or below = 1 and above > 0").isEmpty():
            return _low(nodes, "node", "component")
        met = edges.join(_low(nodes, "a", "low_a"), "a").join(_low(nodes, "b", "low_b"), "b")
        lows = F.struct(F.greatest("low_a", "low_b").alias("a"), F.least("low_a", "low_b").alias("b"))
        jump = F.when(F.col("b") == F.col("low_a"), F.struct(F.col("a"), F.col("low_b").alias("b")))
        edges = staged(met.select(F.inline(F.array(lows, jump))).where("a <> b").distinct(), "links")
