"""Connected components of a graph that is larger than any one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.shared import landed


def component_labels(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (a, b); ``root`` is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Minima are aggregated with
    map-side combine and joined back, so that a node with very many edges is no single task. Each
    round is written down. Node values need an order only.
    """
    pairs = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = landed(pairs.distinct(), "edges")
    for _ in range(max_rounds):
        # Stars: every edge leads to a root that has no edge to a smaller node.
        roots = pairs.select(F.col("b").alias("a")).distinct()
        if pairs.join(roots, "a", "left_semi").isEmpty():
            lone = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
            if lone.filter("n > 1").isEmpty():
                break
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = landed(large.filter("a <> b").distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        pairs = landed(small, "small-star")
    else:
        raise RuntimeError(f"no stable components after {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
