"""Rewards of rollout groups: array columns per prompt, no shuffle until a corpus metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KS = (1, 2, 4, 8, 16)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    """Mean of an array, 0 if it is empty or null."""
    return F.when(F.size(a) > 0, total(a) / F.size(a)).otherwise(0.0)


def first_k(a: Column, k: int) -> Column:
    return F.slice(a, 1, k)


def best_of_k(scores: Column, k: int) -> Column:
    """The largest of the first k scores, 0 if there is none."""
    return F.coalesce(F.array_max(first_k(scores, k)), F.lit(0.0))


def nonzero_at_k(hard: Column, k: int, least: float | None = None) -> Column:
    """Whether one of the first k rewards is above 0, or at least `least`."""
    return F.coalesce(F.exists(first_k(hard, k), lambda r: r > 0 if least is None else r >= least), F.lit(False))


def variance(scores: Column) -> Column:
    """Population variance; 0 for one score or none."""
    return F.when(F.size(scores) > 1, total(F.transform(scores, lambda s: (s - mean(scores)) * (s - mean(scores)))) / F.size(scores)).otherwise(0.0)


def advantages(scores: Column) -> Column:
    """(score - mean) / (population deviation + 1e-8)."""
    return F.transform(scores, lambda s: (s - mean(scores)) / (F.sqrt(variance(scores)) + 1e-8))


def score_of(individual: Column) -> Column:
    """Share of constraints that hold; 0 if there are none."""
    return mean(F.transform(individual, lambda b: b.cast("double")))


def distinct_values(a: Column) -> Column:
    return F.size(F.array_distinct(a))


def has_no_variance(a: Column) -> Column:
    """At most one value; a null array has none."""
    return F.coalesce((F.size(a) <= 1) | (distinct_values(a) <= 1), F.lit(True))


def roll_up(df: DataFrame, scores: str = "scores", passed: str = "passed", results: str = "constraint_results") -> DataFrame:
    """num_rollouts, num_passed, pass_rate, constraint_accuracy, best_soft_reward_at_{1,8,16} and advantages of each group.

    passed is an array of booleans and results an array of arrays of booleans, both by rollout.
    """
    each = F.flatten(results)
    n_pass = F.size(F.filter(passed, lambda p: p))
    good = F.size(F.filter(each, lambda b: b))
    return df.withColumns(
        {
            "num_rollouts": F.size(scores),
            "num_passed": n_pass,
            "pass_rate": F.when(F.size(passed) > 0, n_pass / F.size(passed)).otherwise(0.0),
            "constraint_accuracy": F.when(F.size(each) > 0, good / F.size(each)).otherwise(0.0),
            **{f"best_soft_reward_at_{k}": best_of_k(F.col(scores), k) for k in (1, 8, 16)},
            "advantages": advantages(F.col(scores)),
        }
    )


def analyze(df: DataFrame, scores: str = "scores", passed: str = "passed", results: str = "constraint_results", ks: tuple[int, ...] = KS) -> DataFrame:
    """One row of corpus metrics.

    Groups without scores stay in every denominator and count as mixed.
    """
    s, p, each = F.col(scores), F.col(passed), F.flatten(results)
    n = F.nullif(F.count(F.lit(1)), F.lit(0))
    some = F.size(s) > 0
    perfect = some & F.forall(s, lambda x: x >= 1.0)
    failed = some & F.forall(s, lambda x: x == 0.0)
    same = some & ~perfect & ~failed & (distinct_values(s) == 1)
    metrics = {
        "total_prompts": F.count(F.lit(1)),
        "total_rollouts": F.coalesce(F.sum(F.size(s)), F.lit(0)),
        "passed_rollouts": F.coalesce(F.sum(F.size(F.filter(s, lambda x: x >= 1.0))), F.lit(0)),
        "pass_rate": F.coalesce(F.sum(F.size(F.filter(s, lambda x: x >= 1.0))) / F.nullif(F.sum(F.size(s)), F.lit(0)), F.lit(0.0)),
        "constraint_accuracy": F.coalesce(F.sum(F.size(F.filter(each, lambda b: b))) / F.nullif(F.sum(F.size(each)), F.lit(0)), F.lit(0.0)),
        "perfect": F.count_if(perfect),
        "failed": F.count_if(failed),
        "identical_partial": F.count_if(same),
        "mixed": F.count_if(~perfect & ~failed & ~same),
    }
    hard = F.transform(p, lambda b: b.cast("int"))
    for k in ks:
        metrics[f"best_at_{k}"] = F.coalesce(F.sum(best_of_k(s, k)) / n, F.lit(0.0))
        metrics[f"nonzero_at_{k}"] = F.coalesce(F.count_if(nonzero_at_k(hard, k)) / n, F.lit(0.0))
    return df.agg(*[c.alias(name) for name, c in metrics.items()])


def soft_rewards(scores: Column, items: Column) -> Column:
    """Scores if there are any, else the mean of each rollout's item scores."""
    return F.when(F.size(scores) > 0, scores).otherwise(F.transform(items, lambda i: mean(F.transform(i, lambda x: x.cast("double")))))


def hard_rewards(scores: Column, items: Column) -> Column:
    """1 where all of a rollout's items are 1 (an empty list counts), else 1 where its score is at least 1."""
    by_items = F.transform(items, lambda i: F.forall(i, lambda x: x == 1).cast("int"))
    return F.when(F.size(items) > 0, by_items).otherwise(F.transform(scores, lambda s: (s >= 1.0).cast("int")))


def reward_distribution(df: DataFrame, soft: str, hard: str, epsilon: float = 1e-12) -> DataFrame:
    """Counts of all-zero, all-one and zero-variance groups, over rows with results."""
    rows = df.where(F.size(soft) > 0)
    every = lambda c, v: F.count_if(F.forall(c, lambda x: x == v))
    flat = lambda c: F.count_if(variance(F.col(c).cast("array<double>")) <= epsilon)
    return rows.agg(F.count(F.lit(1)).alias("rows_with_results"), every(soft, 0).alias("soft_all_zero"), every(soft, 1).alias("soft_all_one"), flat(soft).alias("soft_zero_variance"), every(hard, 0).alias("hard_all_zero"), every(hard, 1).alias("hard_all_one"), flat(hard).alias("hard_zero_variance"))


def merge_rewards(base: DataFrame, checklist: DataFrame, verifiable: DataFrame, key: str = "key") -> DataFrame:
    """base with checklist_soft/hard, verifiable_soft/hard (empty where missing) and no_variance.

    The right sides have soft and hard arrays; the last row of a key wins (by _row_idx).
    """
    from verisift.operators.relational import last_wins

    out = base
    for name, side in (("checklist", checklist), ("verifiable", verifiable)):
        own = last_wins(side, [key], "_row_idx").select(key, F.col("soft").alias(f"{name}_soft"), F.col("hard").alias(f"{name}_hard"))
        out = out.join(own, key, "left")
    empty = {f"{n}_soft": "array<double>" for n in ("checklist", "verifiable")} | {f"{n}_hard": "array<int>" for n in ("checklist", "verifiable")}
    out = out.withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in empty.items()})
    return out.withColumn("no_variance", has_no_variance(F.col("checklist_hard")) | has_no_variance(F.col("verifiable_soft")))


def filter_rewards(df: DataFrame, rewards: str, kind: str) -> DataFrame:
    """Rows whose rewards are all_zero, all_one or all_zero_or_one; rows without rewards never match."""
    r = F.col(rewards)
    tests = {"all_zero": F.forall(r, lambda x: x == 0), "all_one": F.forall(r, lambda x: x == 1)}
    tests["all_zero_or_one"] = tests["all_zero"] | tests["all_one"]
    return df.where((F.size(r) > 0) & tests[kind])
