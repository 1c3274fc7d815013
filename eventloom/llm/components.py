"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.stored import forget, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (columns a, b; longs): root is the smallest node it is linked with, itself
    included. Large and small stars alternate until nothing changes (a number of rounds logarithmic in the graph);
    every step is a minimum per node, aggregated before its shuffle, so a node with very many links is no hot spot.
    Each round is stored, which cuts the lineage. Nulls and loops are no links; an empty table gives an empty result."""
    state = stored(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = _state_of(state)
    while True:
        after = stored(_small_stars(_large_stars(state)))
        forget(state)
        state, before, seen = after, seen, _state_of(after)
        if seen == before:
            break
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_stars(links: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node with its smallest neighbour."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_stars(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours with the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def still_open(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(cell, set, root) of the members of cells that hold more than one component."""
    if roots is None:
        return members.withColumn("root", F.col("set"))
    labelled = stored(members.join(roots, F.col("set") == F.col("node"), "left").select("cell", "set", F.coalesce("root", "set").alias("root")))
    open_cells = labelled.groupBy("cell").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("cell")
    found = stored(labelled.join(open_cells, "cell", "left_semi"))
    forget(labelled)
    return found


def led(labelled: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b): each set with the leader of one of its cells, of another component than its own. A cell's leader is
    the least of its sets by a hash, another one in each round."""
    leader = F.min(F.struct(F.xxhash64("set", F.lit(number)).alias("h"), "set", "root")).alias("l")
    to_leader = labelled.join(labelled.groupBy("cell").agg(leader), "cell").filter(F.col("root") != F.col("l.root"))
    one = to_leader.groupBy("set").agg(F.min(F.struct("l.h", "l.set")).alias("l"))
    return one.select(F.least("set", "l.set").alias("a"), F.greatest("set", "l.set").alias("b")).distinct()
