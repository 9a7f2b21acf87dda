"""Windows, samples and searches over rows with an index."""

from __future__ import annotations

import random
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from verisift.operators import relational


def submitted(df: DataFrame, start: int = 0, most: int | None = None, order: str = "_row_idx") -> DataFrame:
    """Rows from index start on, and of these the first ``most`` by index, whatever becomes of them."""
    out = df.where(F.col(order) >= start)
    return out if most is None else out.where(F.col(order) < start + most)


def successful(df: DataFrame, ok: Column, most: int | None = None, order: str = "_row_idx") -> DataFrame:
    """The first ``most`` rows by index for which ok holds; null does not hold."""
    out = df.where(F.coalesce(ok, F.lit(False)))
    return out if most is None else out.orderBy(order).limit(most)


def first_rows(df: DataFrame, n: int, order: str | list[str] = "_row_idx") -> DataFrame:
    """The first n rows in order; all, if there are fewer."""
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


def restore_order(df: DataFrame, order: str = "_row_idx") -> DataFrame:
    """Rows in the order of their index."""
    return df.orderBy(order)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "_row_idx") -> DataFrame:
    """Exactly n rows (all, if there are fewer) drawn by seeded hash; their order is that of df's index."""
    return relational.drawn(df, [key], lambda total: min(n, total), seed).where(F.col("_draw").isNotNull()).drop("_draw")


def draw_rows(df: DataFrame, n: int, most: int | None = None, seed: int = 42, key: str = "_row_idx") -> DataFrame:
    """A sample of n rows with its order of drawing as _draw (from 1), cut to the first ``most``."""
    keep = n if most is None else min(n, most)
    return relational.drawn(df, [key], lambda total: min(keep, total), seed).where(F.col("_draw").isNotNull())


def sample_reference(items: list[str], n: int | None, seed: int = 42):
    """A function of an index column: n numbered items drawn with Python's generator of seed + index, renumbered from 1.

    With n null, or no smaller than the number of items, all items as they are.
    """
    if n is None or n >= len(items):
        return lambda index: F.lit("\n".join(items))
    bare = [re.sub(r"^\d+\.\s*", "", item) for item in items]

    @F.pandas_udf(StringType())
    def draw(index: pd.Series) -> pd.Series:
        drawn = (random.Random(seed + int(i)).sample(bare, n) for i in index)
        return pd.Series(["\n".join(f"{k}. {text}" for k, text in enumerate(some, 1)) for some in drawn], dtype="object")

    return draw


def search(df: DataFrame, column: str, term: str) -> DataFrame:
    """Rows whose column holds the term, in any case; an unknown column holds nothing, and a null reads as none."""
    if column not in df.columns:
        return df.where(F.lit(term == ""))
    kind = dict(df.dtypes)[column]
    shown = F.to_json(column) if kind.startswith(("array", "struct", "map")) else F.col(column).cast("string")
    return df.where(F.contains(F.lower(F.coalesce(shown, F.lit("none"))), F.lit(term.lower())))


def skip_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row: total, kept, and how many rows each check drops; a row counts for the first check that it fails."""
    failed = F.lit(None).cast("string")
    for name, ok in reversed(checks.items()):
        failed = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(failed)
    rows = df.select(failed.alias("f"))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("f").isNull()).alias("kept"), *[F.count_if(F.col("f") == n).alias(n) for n in checks])
