"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import work_dir

from .common import stored_at


def components(links: DataFrame) -> DataFrame:
    """id and component (the least id it is connected with) of every id in links (a, b).

    Each round hangs every node's larger neighbours, then its smaller ones, below the least id it
    sees; the graph becomes a forest of stars in about log(n) rounds. A node's neighbours are only
    aggregated, never collected. Each round is a stored table, and takes the place of the one
    before the last.
    """
    folder = work_dir(links.sparkSession, "stars")
    pairs = links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    pairs = stored_at(pairs, f"{folder}/0")
    state, turn = _state(pairs), 0
    while state[0]:
        turn = 1 - turn
        pairs = stored_at(_small_star(_large_star(pairs)), f"{folder}/{turn}")
        before, state = state, _state(pairs)
        if state == before:
            break
    below = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return below.unionByName(roots).distinct()


def _state(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    return row[0], row[1]


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root"))
    moved = both.join(least, "u").where("v > u")
    return moved.select(F.col("v").alias("u"), F.col("root").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("root"))
    moved = pairs.join(least, "u")
    hung = moved.select(F.col("v").alias("u"), F.col("root").alias("v"))
    return hung.unionByName(least.select("u", F.col("root").alias("v"))).where("u != v").distinct()
