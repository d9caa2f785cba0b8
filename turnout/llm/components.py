"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnout.llm.tables import stored


def _nearest(both: DataFrame) -> DataFrame:
    """Least neighbour of each node, itself included."""
    return both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.join(_nearest(both), "a").filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = _nearest(down)
    moved = down.join(near, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(near.select("a", F.col("least").alias("b"))).filter("a != b")


def components(links: DataFrame) -> DataFrame:
    """``a`` and the least node ``b`` of its component, for each node but the least ones.

    Links are pairs (a, b) of numbers; nulls, loops and repeats change nothing. Each round
    is written to the shared folder; the rounds end when one changes nothing. The number of links
    never grows, and a node with many links is counted within tasks before it is shuffled.
    """
    links = links.filter("a is not null and b is not null and a != b").select("a", "b").distinct()
    links = stored(links, "links")
    seen = None
    while True:
        links = stored(_small_star(_large_star(links)).distinct(), "links")
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            return links
        seen = state
