"""Grading of rollouts."""

import json

import pytest
from pyspark.sql import functions as F

from verisift.operators import grading


def test_grade_rollouts(spark):
    gt = json.dumps([{"instruction_id": ["punctuation:no_comma", "keywords:existence"], "kwargs": [None, {"keywords": ["b"]}]}])
    df = spark.createDataFrame([("k", ["a, b", "<think>x, y</think> a b", "", "a, c"], gt), ("e", [], gt), ("f", ["x"], "[]")], "key string, responses array<string>, ground_truth string").repartition(3)
    got = {r["key"]: r for r in grading.grade_rollouts(df).collect()}
    assert got["k"]["scores"] == [0.5, 1.0, 0.0, 0.0] and got["k"]["passed"] == [False, True, False, False]
    assert got["k"]["constraint_results"] == [[False, True], [True, True], [], [False, False]]
    assert got["k"]["constraint_accuracy"] == pytest.approx(0.5) and got["k"]["pass_rate"] == 0.25
    assert got["f"]["scores"] == [0.0] and got["f"]["passed"] == [True]
    out = {r["key"]: r for r in grading.append_scores(df.select("key"), grading.grade_rollouts(df)).collect()}
    assert out["k"]["hard_rewards"] == [0, 1, 0, 0] and out["k"]["verifiable_has_variance"] == 1 and out["e"]["scores"] == []


def test_joins_and_counters(spark):
    rolls = spark.createDataFrame([("a", 1), ("b", 2)], "key string, x int")
    truth = spark.createDataFrame([("a", "t1", 0), ("a", "t2", 1), (None, "t3", 2)], "key string, ground_truth string, _row_idx int")
    hit, miss = grading.with_truth(rolls, truth, ["ground_truth"])
    assert [tuple(r) for r in hit.collect()] == [("a", 1, "t2")] and [r["key"] for r in miss.collect()] == ["b"]
    with pytest.raises(ValueError):
        grading.append_columns(rolls, {"x": F.lit(1)})
    assert grading.append_columns(rolls, {"x": F.lit(9)}, replace=True).first()["x"] == 9
    assert grading.safe_name("org/My-Model v2.") == "org_My_Model_v2"
    s = grading.merge_statistics(rolls.withColumns({"f": F.lit(None).cast("string"), "c": F.lit("y")}), "f", "c").first()
    assert tuple(s) == (2, 0, 2, 2, 0)
    assert grading.error_counts(spark.createDataFrame([("t",), ("t",), (None,)], "error_reason string")).first()["count"] == 2
    chat = spark.createDataFrame([([("user", "hi"), ("assistant", None)],)], "m array<struct<role:string,content:string>>")
    assert chat.select(grading.plain_chat(F.col("m"))).first()[0] == "user: hi\nassistant: \nassistant: "


def test_model_scores(spark):
    df = spark.createDataFrame([("k", "p", ["aa", "b", "ccc"]), ("e", "p", [])], "key string, p string, r array<string>")
    got = {r["key"]: r["reward_scores"] for r in grading.model_scores(df, "p", "r", lambda p, r: [len(x) for x in r], batch=2).collect()}
    assert got == {"k": [2.0, 1.0, 3.0], "e": []}
