"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinstone.llm.common import discard, written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node that it reaches.

    Each round is written to the shared folder, so that plans stay short and lost executors cost
    one round at most; the round before it is deleted then. Ends when a round changes nothing; the
    number of rounds is logarithmic in the longest path. No links give an empty table.
    """
    own = written(edges.select("a", "b").where("a <> b").distinct(), "links")
    mark = lambda t: t.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
    before = mark(own)
    while before[0]:
        new = written(_small(_large(own).where("a <> b").distinct()).where("a <> b").distinct(), "links")
        discard(own)
        own, after = new, mark(new)
        if after == before:
            break
        before = after
    return own.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(own.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
