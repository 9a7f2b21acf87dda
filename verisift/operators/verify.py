"""Verification of responses against ground-truth constraints, and its statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from verisift.functions import checkers
from verisift.operators.constraints import DYNAMIC_PATTERN, REGISTRY

#: Ground truth: a JSON list of groups of constraint ids and their parameters.
GROUND_TRUTH = "array<struct<instruction_id:array<string>,kwargs:array<string>>>"


@F.pandas_udf(BooleanType())
def check_with_python(id_: pd.Series, response: pd.Series, kwargs: pd.Series) -> pd.Series:
    """The Arrow-batched check of any constraint; parameters are a JSON object."""
    return pd.Series([checkers.check_json(*x) for x in zip(id_, response, kwargs, strict=True)], dtype="bool")


def register(spark: SparkSession) -> None:
    """SQL function check_constraint(response, id, kwargs_json)."""

    def check(response: pd.Series, id_: pd.Series, kwargs: pd.Series) -> pd.Series:
        return pd.Series([checkers.check_json(i, r, k) for r, i, k in zip(response, id_, kwargs, strict=True)], dtype="bool")

    spark.udf.register("check_constraint", F.pandas_udf(check, BooleanType()))


def register_constraint(id_: str, ddl: str, template: str, check: Callable) -> None:
    """Adds a Python-checked constraint: check(response, **params) -> bool.

    Workers know it only if they import the module that registers it.
    """
    from verisift.operators.constraints import python_only

    python_only(id_, ddl, template)
    checkers.CHECKS[id_] = check


def ground_truth(df: DataFrame) -> Column:
    """The ground truth of a row: ground_truth_verifiable if it is not empty, else ground_truth. Null where it is not JSON."""
    named = [F.when(F.col(c) != "", F.col(c)) for c in ("ground_truth_verifiable", "ground_truth") if c in df.columns]
    return F.from_json(F.coalesce(*named), GROUND_TRUTH)


def constraint_pairs(truth: Column) -> Column:
    """(constraint_id, kwargs) of a ground truth in order; ids and parameters of a group pair up to the shorter list."""

    def group(g: Column) -> Column:
        n = F.least(F.size(g["instruction_id"]), F.size(g["kwargs"]))
        return F.zip_with(F.slice(g["instruction_id"], 1, n), F.slice(g["kwargs"], 1, n), lambda i, k: F.struct(i.alias("constraint_id"), k.alias("kwargs")))

    return F.flatten(F.transform(truth, group))


def explode_constraints(df: DataFrame, truth: Column) -> DataFrame:
    """One row for each constraint: pos, constraint_id, kwargs (JSON)."""
    return df.select("*", F.posexplode(constraint_pairs(truth)).alias("pos", "_c")).select(*df.columns, "pos", "_c.constraint_id", "_c.kwargs")


def _native_ids(ids: list[str] | None) -> list[str]:
    return [c for c in (ids or sorted(REGISTRY)) if c in REGISTRY and REGISTRY[c].native and c not in DYNAMIC_PATTERN]


def _inside(id_: Column, native: list[str]) -> Column:
    return F.coalesce(id_.isin(native), F.lit(False)) if native else F.lit(False)


def native_result(id_: Column, kwargs: Column, response: Column, native: list[str]) -> Column:
    """The result of the native check of that id; false for other ids."""
    result = F.lit(False)
    for c in native:
        params = REGISTRY[c].params
        parsed = F.from_json(F.coalesce(kwargs, F.lit("{}")), REGISTRY[c].ddl) if params else None
        ok = REGISTRY[c].follows(response, **{p: parsed[p] for p in params})
        result = F.when(id_ == c, ok).otherwise(result)
    return result


def check_rows(rows: DataFrame, response: str, ids: list[str] | None = None) -> DataFrame:
    """rows (with constraint_id, kwargs) plus followed, in one pass.

    Constraints whose check is native and safe for parameters from data stay in the
    JVM; for them Python gets nulls only. ids limits the native branch to ids that may occur.
    """
    native = _native_ids(ids)
    inside = _inside(F.col("constraint_id"), native)
    other = [F.when(~inside, F.col(c)) for c in ("constraint_id", response, "kwargs")]
    result = native_result(F.col("constraint_id"), F.col("kwargs"), F.col(response), native)
    return rows.withColumn("followed", F.when(inside, result).otherwise(check_with_python(*other)))


@F.pandas_udf(ArrayType(BooleanType()))
def check_list_with_python(ids: pd.Series, response: pd.Series, kwargs: pd.Series) -> pd.Series:
    """check_with_python for a list of constraints of one response; a null id is no constraint and gives null."""
    none = [None] * 3
    return pd.Series([None if i is None else [None if c is None else checkers.check_json(c, r, k) for c, k in zip(i, none if p is None else p, strict=False)] for i, r, p in zip(ids, response, kwargs, strict=True)])


def verify(df: DataFrame, key: str, response: str, ids: list[str] | None = None) -> DataFrame:
    """key, individual_results (in the order of the ground truth), verification_passed.

    Every row is judged where it is: native checks in the JVM, the others in one Arrow
    batch pass that gets nulls for rows without them. A row without constraints passes with no results.
    """
    native = _native_ids(ids)
    base = df.select(F.col(key), F.col(response).alias("_response"), ground_truth(df).alias("_truth"))
    base = base.withColumn("_pairs", F.coalesce(constraint_pairs(F.col("_truth")), F.array().cast("array<struct<constraint_id:string,kwargs:string>>"))).drop("_truth")
    some = F.exists("_pairs", lambda c: ~_inside(c["constraint_id"], native))
    other = F.transform("_pairs", lambda c: F.when(~_inside(c["constraint_id"], native), F.coalesce(c["constraint_id"], F.lit(""))))
    asked = [F.when(some, c) for c in (other, F.col("_response"), F.transform("_pairs", lambda c: c["kwargs"]))]
    base = base.withColumn("_python", check_list_with_python(*asked))
    each = F.transform("_pairs", lambda c, i: F.coalesce(F.when(_inside(c["constraint_id"], native), native_result(c["constraint_id"], c["kwargs"], F.col("_response"), native)).otherwise(F.get("_python", i)), F.lit(False)))
    out = base.select(key, each.alias("individual_results"))
    return out.select(key, "individual_results", F.forall("individual_results", lambda b: b).alias("verification_passed"))


def verification_stats(verified: DataFrame) -> DataFrame:
    """Totals, passes, example_accuracy and constraint_accuracy; 0 on empty input."""
    n = F.count(F.lit(1))
    passed = F.count_if("verification_passed")
    total = F.coalesce(F.sum(F.size("individual_results")), F.lit(0))
    good = F.coalesce(F.sum(F.size(F.filter("individual_results", lambda b: b))), F.lit(0))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return verified.agg(n.alias("total"), passed.alias("passed"), total.alias("total_constraints"), good.alias("passed_constraints"), share(passed, n).alias("example_accuracy"), share(good, total).alias("constraint_accuracy"))


def python_checks(df: DataFrame, key: str, response: str, constraints: list[tuple[str, str | None]]) -> DataFrame:
    """key and one boolean column for each (id, kwargs JSON), by one pass of Arrow batches."""
    names = [i.split(":")[1] for i, _ in constraints]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], **{n: [checkers.check_json(i, r, k) for r in batch["r"]] for n, (i, k) in zip(names, constraints, strict=True)}})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(response).alias("r")).mapInPandas(run, f"{key} {kind}, " + ", ".join(f"{n} boolean" for n in names))
