"""Deduplication, anti-joins, last-wins joins, splits and order-preserving set operations.

Row order means something to these operators, so it is a column (_row_idx), never
the order of files or partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verisift.functions import text as T
from verisift.sources import folders


def with_row_idx(df: DataFrame, order: list[str] | None = None, name: str = "_row_idx") -> DataFrame:
    """df with a contiguous index from 0: by order if given (ties must not matter), else in the order of the input.

    The rows are stored with their partition and place; an index is the place plus the
    sizes of the partitions before, of which there is one row each.
    """
    rows = (df.sort(*order) if order else df).withColumn("_place", F.monotonically_increasing_id())
    rows = folders.stored(rows, "row_index")
    part = F.shiftright("_place", 33)
    sizes = {r["p"]: r["count"] for r in rows.groupBy(part.alias("p")).count().collect()}
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    first = df.sparkSession.createDataFrame(starts, "_part long, _first long")
    out = rows.withColumn("_part", part).join(F.broadcast(first), "_part")
    return out.select(*df.columns, (F.col("_first") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias(name))


def first_wins(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The first row of each key by order, as an aggregation: one row for a key leaves each task."""
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names, strict=True)], F.struct(*order).alias("_order"))
    return keyed.groupBy(*names).agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row")).select(*keys, "_row.*")


def dedup_texts(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """First row of each normalised text (stripped, white space collapsed, lower case; null as empty), by its SHA-1."""
    return first_wins(df, [F.sha1(T.normalize(F.col(text)))], order)


def anti_join_normalized(left: DataFrame, right: DataFrame, left_key: str, right_key: str, lower: bool = False) -> DataFrame:
    """Rows of left whose normalised key is in no row of right; null and empty are one key. SHA-256 of keys, not keys, are shuffled."""
    key = lambda c: F.unhex(F.sha2(T.normalize(F.col(c), lower), 256))
    seen = right.select(key(right_key).alias("_key")).distinct()
    return left.withColumn("_key", key(left_key)).join(seen, "_key", "left_anti").drop("_key")


def join_last_wins(left: DataFrame, right: DataFrame, key: str, columns: list[str], order: str = "_row_idx") -> DataFrame:
    """left LEFT JOIN right on key; of right's rows the last one of a key counts, and rows without a key do not."""
    side = last_wins(right.where(F.col(key).isNotNull()).select(key, order, *columns), [key], order).drop(order)
    return left.join(side, key, "left")


def lookup_with_fallback(left: DataFrame, right: DataFrame, key: str, text: str, value: str, order: str = "_row_idx") -> DataFrame:
    """left plus value: looked up by key, or, if that is null or empty, by the stripped text."""
    by_key = last_wins(right.select(F.col(key), F.col(value).alias("_v1"), order), [key], order).drop(order)
    by_text = last_wins(right.select(T.strip(F.col(text)).alias("_t"), F.col(value).alias("_v2"), order), ["_t"], order).drop(order)
    joined = left.withColumn("_t", T.strip(F.col(text))).join(by_key, key, "left").join(by_text, "_t", "left")
    return joined.withColumn(value, F.coalesce(F.nullif("_v1", F.lit("")), F.col("_v2"))).drop("_t", "_v1", "_v2")


def positional_join(left: DataFrame, right: DataFrame, order: str = "_row_idx") -> DataFrame:
    """Rows of equal index side by side; raises if the sides differ in length."""
    a, b = left.count(), right.count()
    if a != b:
        raise ValueError(f"the sides have {a} and {b} rows")
    return left.join(right, order)


def merge_steps(augmented: DataFrame, filtered: DataFrame, checklist: DataFrame, filtered_columns: list[str], checklist_columns: list[str], drop_contradictory: bool = False) -> DataFrame:
    """Three stage outputs on their core key; right sides are last-wins, a missing label is kept."""
    keyed = lambda df: df.where(F.col("key").isNotNull()).withColumn("core_key", T.core_key(F.col("key").cast("string")))
    out = keyed(augmented)
    for side, columns in ((filtered, filtered_columns), (checklist, checklist_columns)):
        own = keyed(side).select("core_key", "_row_idx", *columns)
        out = out.join(last_wins(own, ["core_key"], "_row_idx").drop("_row_idx"), "core_key", "left")
    return out.where(~contradictory(F.col("contradiction_label"))) if drop_contradictory else out


def contradictory(label: Column) -> Column:
    """Whether a label says contradictory and not the opposite; a null label does not."""
    low = F.lower(label)
    return F.coalesce(low.contains("contradictory") & ~low.contains("not"), F.lit(False))


def drawn(df: DataFrame, key: list[str], want: Callable[[int], int], seed: int = 42, name: str = "_draw") -> DataFrame:
    """df with its place in a random draw without replacement, 1 to want(rows); null for rows that are not drawn.

    The draw goes by the MD5 of seed and key. The rank of a row is its rank within one of
    4096 hash ranges plus the sizes of the ranges before, so no task sorts all rows.
    Keys should be unique; equal ones share a hash.
    """
    rows = df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))).withColumn("_range", F.substring("_h", 1, 3))
    sizes = {r["_range"]: r["count"] for r in rows.groupBy("_range").count().collect()}  # at most 4096 rows
    n, before, limits = want(sum(sizes.values())), 0, []
    for part in sorted(sizes):
        limits.append((part, before, n - before))
        before += sizes[part]
    limit = df.sparkSession.createDataFrame(limits, "_range string, _before long, _limit long")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy("_h", *key))).join(F.broadcast(limit), "_range")
    return ranked.withColumn(name, F.when(F.col("_rank") <= F.col("_limit"), F.col("_before") + F.col("_rank"))).drop("_h", "_range", "_rank", "_before", "_limit")


def split_exact(df: DataFrame, key: list[str], share: float, seed: int = 42) -> DataFrame:
    """df with is_test: exactly ceil(n * share) rows, those with the smallest MD5 of seed and key."""
    marked = drawn(df, key, lambda n: math.ceil(n * share - 1e-9), seed)
    return marked.withColumn("is_test", F.col("_draw").isNotNull()).drop("_draw")


def round_robin(df: DataFrame, index: int, total: int, order: str = "_row_idx") -> DataFrame:
    """Rows index, index + total, ...; any number of parts."""
    if not 0 <= index < total:
        raise ValueError(f"part {index} of {total}")
    return df.where(F.col(order) % total == index)


def union_all(parts: list[tuple[str, DataFrame]], source: str = "source_path") -> DataFrame:
    """UNION ALL by name, with the source of each row; columns that a part lacks are null."""
    out = None
    for name, df in parts:
        tagged = df.withColumn(source, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def split_sentinel(df: DataFrame, columns: list[str], sentinel: str = "<EMPTY>") -> tuple[DataFrame, DataFrame]:
    """(rows whose first not-null column is the sentinel, the others)."""
    empty = T.strip(F.coalesce(*columns)).eqNullSafe(F.lit(sentinel))
    return df.where(empty), df.where(~empty)
