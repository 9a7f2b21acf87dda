"""Writers: Parquet, JSON lines, CSV with nested columns as JSON, metrics, and split outputs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.operators import relational
from verisift.sources import readers


def write(df: DataFrame, path: str, fmt: str = "parquet", overwrite: bool = False) -> None:
    """df to path; an existing output is an error unless overwrite is set."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
        df = df.withColumns({c: F.to_json(c) for c in nested})
        df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_or_reuse(df: DataFrame, path: str) -> DataFrame:
    """The table at path, written from df only if it is not there yet."""
    spark = df.sparkSession
    if not readers.exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_splits(df: DataFrame, path: str, columns: list[str], suffix: str = "_empty", sentinel: str = "<EMPTY>") -> None:
    """Rows with the sentinel to path + suffix, the others to path + '_non_empty'."""
    empty, full = relational.split_sentinel(df, columns, sentinel)
    write(empty, path + suffix)
    write(full, path + "_non_empty")


def write_train_test(df: DataFrame, path: str, key: list[str], share: float = 0.15, seed: int = 42) -> None:
    """Subfolders train and test, by exact hash split."""
    marked = relational.split_exact(df, key, share, seed)
    write(marked.where(~F.col("is_test")).drop("is_test"), f"{path}/train")
    write(marked.where("is_test").drop("is_test"), f"{path}/test")


def prompts(df: DataFrame, messages: str, extra: list[str] | None = None) -> DataFrame:
    """The prompt-dump form: prompt and further columns, without any call."""
    return df.select(F.col(messages).alias("prompt"), *(extra or []))


def metrics_json(row_df: DataFrame) -> str:
    """A one-row table of metrics as JSON text."""
    rows = row_df.take(2)
    if len(rows) != 1:
        raise ValueError("metrics are one row")
    return json.dumps(rows[0].asDict(recursive=True), ensure_ascii=False, sort_keys=True)
