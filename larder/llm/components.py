"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import stored


LINKS_PER_TASK = 100_000


def _star(links: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Hang each node's larger (or not larger) neighbours on its smallest one. ``tasks`` grows with the links: few links need no more."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    around = both.where("v > u") if large else both.where("v < u")
    moved = around.join(least, "u").select(F.col("v").alias("x"), "m")
    if not large:  # the node itself hangs on its smallest neighbour too
        moved = moved.unionByName(least.select(F.col("u").alias("x"), "m"))
    return moved.where("x <> m").select(F.col("m").alias("u"), F.col("x").alias("v")).coalesce(tasks).distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v); root is the component's smallest node.

    Rounds go on until no link moves, each written to the shared folder. Every round shortens the way to the root, and the number of
    rounds grows with the logarithm of a component's width. No list of neighbours is ever put together.
    """
    links = links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    links, before = stored(links, "links"), None
    print_of = [F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))]
    while True:
        now = tuple(links.agg(*print_of).first())
        if now == before:
            break
        before = now
        tasks = 1 + now[0] // LINKS_PER_TASK
        links = stored(_star(_star(links, True, tasks), False, tasks), "links")
    # Settled links all lead from a root to a node.
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
