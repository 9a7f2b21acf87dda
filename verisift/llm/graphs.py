"""Connected components and joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.llm import scratch

#: A key is hot from this share of the rows on, so there are at most HOT_KEYS hot keys.
HOT_KEYS = 200
HOT_LEAST = 1000


def hot_keys(sizes: DataFrame, keys: list[str], total: int) -> DataFrame | None:
    """The hot keys of sizes (keys and _n, the rows of each key) as a stored table of at most HOT_KEYS rows, or None."""
    least = max(HOT_LEAST, -(-total // HOT_KEYS))
    hot = scratch.stored(sizes.where(F.col("_n") >= least).select(*keys), "hot_keys")
    return hot if hot.head(1) else None


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], sizes: DataFrame | None = None, total: int | None = None, hot: DataFrame | str | None = "unknown") -> DataFrame:
    """left LEFT JOIN right on keys; right has at most one row for a key, keys are not null.

    Rows of hot keys stay where they are: right's rows for them, HOT_KEYS at most,
    are broadcast. The others are joined by shuffle. left should be a stored table,
    it is read three times. sizes (keys and _n, the rows of each key that right has)
    and total spare counting left; hot, as hot_keys gives it, spares both.
    """
    if isinstance(hot, str):
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if sizes is None else sizes
        hot = hot_keys(counts, keys, left.count() if total is None else total)
    if hot is None:
        return left.join(right, keys, "left")
    cold = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, "left")
    own = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    warm = left.join(F.broadcast(hot), keys, "left_semi").join(own, keys, "left")
    return cold.unionByName(warm)


def _tidy(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b, each once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node that is reachable) of each node of edges (a, b).

    Large-star and small-star rounds as joins with the least neighbour: no list of
    neighbours is ever gathered, and a node with very many neighbours is a hot key
    of hot_join. Every round ends in the shared folder. Node values must have an order.
    """
    now = scratch.stored(_tidy(edges), "edges")
    mark = None
    for _ in range(max_rounds):
        last = now
        least = now.select(F.col("a").alias("node"), F.col("b").alias("m")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("m"))).groupBy("node").agg(F.min("m").alias("m"))
        large = hot_join(now.withColumnRenamed("b", "node"), least, ["node"]).select("a", F.col("m").alias("b"))
        large = scratch.stored(_tidy(large), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        met = hot_join(large, low, ["a"])
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = scratch.stored(_tidy(small), "edges")
        # tables of earlier rounds are not read again
        for old in (last, large):
            scratch.forget(old)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
