"""Grading of rollouts: joins with ground truth and checklists, scoring by an injected model, and counters."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.functions import text as T
from verisift.operators import relational, rewards, verify

#: Scores texts in fixed batches: (prompts, responses) -> scores.
Scorer = Callable[[list[str], list[str]], list[float]]


def with_truth(rollouts: DataFrame, truth: DataFrame, columns: list[str], key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(rollouts INNER JOIN truth on key, the rollouts without a match); the last truth row of a key counts."""
    side = relational.last_wins(truth.where(F.col(key).isNotNull()).select(key, "_row_idx", *columns), [key], "_row_idx").drop("_row_idx")
    return rollouts.join(side, key), rollouts.join(side.select(key), key, "left_anti")


def grade_rollouts(rollouts: DataFrame, key: str = "key", ids: list[str] | None = None) -> DataFrame:
    """rollouts (key, responses, ground_truth) plus scores, passed, constraint_results and the roll-up.

    Thinking is cut off each response; an empty response scores 0, does not pass and adds no constraint results.
    """
    each = rollouts.select(key, F.posexplode("responses").alias("pos", "response"), verify.ground_truth(rollouts).alias("t"))
    each = each.withColumn("response", T.strip_thinking(F.col("response")))
    rows = verify.explode_constraints(each.where(F.col("response") != "").withColumn("rollout", F.struct(key, F.col("pos").alias("rollout_pos"))).select("rollout", "response", "t"), F.col("t")).drop("t")
    checked = verify.check_rows(rows, "response", ids).groupBy("rollout").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "followed"))), lambda r: r["followed"]).alias("results"))
    none = F.array().cast("array<boolean>")
    joined = each.select(key, "pos", (F.coalesce("response", F.lit("")) == "").alias("empty")).join(checked.select(F.col(f"rollout.{key}").alias(key), F.col("rollout.rollout_pos").alias("pos"), "results"), [key, "pos"], "left")
    scored = joined.withColumn("results", F.coalesce("results", none))
    scored = scored.withColumns({"score": rewards.score_of(F.col("results")), "ok": ~F.col("empty") & F.forall("results", lambda b: b)})
    grouped = scored.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "score", "ok", "results"))).alias("x"))
    lists = grouped.select(key, F.transform("x", lambda v: v["score"]).alias("scores"), F.transform("x", lambda v: v["ok"]).alias("passed"), F.transform("x", lambda v: v["results"]).alias("constraint_results"))
    kinds = {"scores": "array<double>", "passed": "array<boolean>", "constraint_results": "array<array<boolean>>"}
    joined = rollouts.join(lists, key, "left")
    return rewards.roll_up(joined.withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in kinds.items()}))


def with_checklist(rollouts: DataFrame, checklists: DataFrame, dataset: str, index: str = "_row_idx") -> tuple[DataFrame, DataFrame]:
    """(rollouts (key, instruction, responses) with the checklist of their key, the rollouts without one).

    A checklist row's key is its example key; rows without a checklist do not count, and the
    last row of a key does. A rollout without an instruction takes the checklist row's.
    """
    kinds = dict(checklists.dtypes)
    own = [F.when(T.truthy(F.col(c), kinds[c]), F.col(c)) for c in ("raw_instruction", "instruction") if c in kinds]
    side = checklists.where(T.truthy(F.col("checklist"), kinds["checklist"]))
    side = side.select(T.example_key(checklists, dataset, index).alias("key"), F.col(index).alias("_i"), "checklist", F.coalesce(*own, F.lit(None).cast("string")).alias("_instruction"))
    # the last checklist and the last instruction of a key, which may come from different rows
    side = side.groupBy("key").agg(F.max_by("checklist", "_i").alias("checklist"), F.max_by("_instruction", F.when(F.col("_instruction").isNotNull(), F.col("_i"))).alias("_instruction"))
    given = F.when(F.col("instruction") != "", F.col("instruction"))
    joined = rollouts.join(side, "key").withColumn("instruction", F.coalesce(given, "_instruction", F.lit(""))).drop("_instruction")
    return joined, rollouts.join(side.select("key"), "key", "left_anti")


def with_results(dataset: DataFrame, results: DataFrame, columns: list[str], key: str = "key") -> DataFrame:
    """dataset LEFT JOIN the last result of each key, with has_result."""
    side = relational.last_wins(results.where(F.col(key).isNotNull()).select(key, "_row_idx", *columns), [key], "_row_idx").drop("_row_idx")
    return dataset.join(side.withColumn("has_result", F.lit(True)), key, "left").withColumn("has_result", F.coalesce("has_result", F.lit(False)))


def result_counts(joined: DataFrame) -> DataFrame:
    """One row: total_rows, rows_with_results, missing_results."""
    return joined.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("has_result").alias("rows_with_results"), F.count_if(~F.col("has_result")).alias("missing_results"))


def append_scores(dataset: DataFrame, graded: DataFrame, key: str = "key") -> DataFrame:
    """dataset plus scores, soft_rewards, hard_rewards and verifiable_has_variance; empty lists and 0 where ungraded."""
    side = graded.select(key, "scores", F.transform("passed", lambda p: p.cast("int")).alias("hard_rewards"))
    out = dataset.join(side, key, "left")
    out = out.withColumns({"scores": F.coalesce("scores", F.array().cast("array<double>")), "hard_rewards": F.coalesce("hard_rewards", F.array().cast("array<int>"))})
    return out.withColumns({"soft_rewards": F.col("scores"), "verifiable_has_variance": (rewards.distinct_values(F.col("scores")) > 1).cast("int")})


def append_columns(df: DataFrame, columns: dict[str, Column], replace: bool = False) -> DataFrame:
    """df with new columns; a name that is there already is an error unless replace is set."""
    clash = sorted(set(columns) & set(df.columns))
    if clash and not replace:
        raise ValueError(f"columns exist: {clash}")
    return df.drop(*clash).withColumns(columns)


def model_scores(df: DataFrame, prompt: str, responses: str, scorer: Scorer, out: str = "reward_scores", batch: int = 8, key: str = "key") -> DataFrame:
    """df plus out: an injected reward model's score of each response, in order. key must be unique."""
    rows = df.select(key, F.posexplode(responses).alias("pos", "r"), F.col(prompt).alias("p"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found: list[float] = []
            for at in range(0, len(part), batch):
                piece = part.iloc[at : at + batch]
                found += [float(s) for s in scorer(piece["p"].tolist(), piece["r"].tolist())]
            yield pd.DataFrame({key: part[key], "pos": part["pos"], "score": found})

    kind = df.schema[key].dataType.simpleString()
    scored = rows.mapInPandas(run, f"{key} {kind}, pos int, score double").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "score"))).alias("x"))
    lists = scored.select(key, F.transform("x", lambda v: v["score"]).alias(out))
    return df.join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<double>")))


def safe_name(model: str) -> str:
    """A model's name as part of a column name."""
    return re.sub(r"[^A-Za-z0-9]+", "_", model).strip("_")


def merge_statistics(merged: DataFrame, filtered: str, checklist: str) -> DataFrame:
    """One row: total, and rows with and without each of the two columns."""
    have = lambda c: F.count_if(F.col(c).isNotNull())
    n = F.count(F.lit(1))
    return merged.agg(n.alias("total"), have(filtered).alias("matched_filtered"), (n - have(filtered)).alias("missing_filtered"), have(checklist).alias("matched_checklist"), (n - have(checklist)).alias("missing_checklist"))


def error_counts(df: DataFrame, reason: str = "error_reason") -> DataFrame:
    """How often each failure reason occurs; rows without one do not count."""
    return df.where(F.col(reason).isNotNull()).groupBy(reason).count()


def plain_chat(messages: Column) -> Column:
    """A chat as plain text, for models without a template."""
    lines = F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["content"], F.lit(""))))
    return F.concat(F.array_join(lines, "\n"), F.lit("\nassistant: "))
