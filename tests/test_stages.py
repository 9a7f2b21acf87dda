"""Windows, samples, searches, joins of stages, sources and named pipelines."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from verisift.operators import compare, grading, model_calls, reshape, sampling
from verisift.plans import catalogue, pipeline, stage_queries
from verisift.sources import folders, readers

ITEMS = [f"{k}. Rule {k}" for k in range(1, 9)]


def test_reference_sample_is_the_generator_of_each_row(spark):
    draw = sampling.sample_reference(ITEMS, 3, 42)
    got = {r["id"]: r["s"] for r in spark.range(20).repartition(3).select("id", draw(F.col("id")).alias("s")).collect()}
    for i in range(20):
        want = [re.sub(r"^\d+\.\s*", "", x) for x in random.Random(42 + i).sample(ITEMS, 3)]
        assert got[i] == "\n".join(f"{k}. {x}" for k, x in enumerate(want, 1))
    everything = spark.range(1).select(sampling.sample_reference(ITEMS, None)(F.col("id")).alias("s")).first()["s"]
    assert everything == "\n".join(ITEMS)


@pytest.mark.parametrize("n", [0, 1, 13, 50, 80])
def test_samples_are_exact_and_do_not_depend_on_partitions(spark, n):
    a, b = (spark.range(50).repartition(p).withColumnRenamed("id", "_row_idx") for p in (1, 7))
    one, two = ({r["_row_idx"] for r in sampling.sample_rows(x, n).collect()} for x in (a, b))
    assert one == two and len(one) == min(n, 50)
    drawn = sorted((r["_draw"], r["_row_idx"]) for r in sampling.draw_rows(a, n, 5).collect())
    assert [d for d, _ in drawn] == list(range(1, min(n, 5, 50) + 1)) and {i for _, i in drawn} <= one


def test_windows_and_counters(spark):
    df = spark.range(10).select(F.col("id").alias("_row_idx"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("v"))
    assert [r[0] for r in sampling.submitted(df, 4, 3).collect()] == [4, 5, 6]
    assert [r[0] for r in sampling.successful(df, F.col("v") > 3, 2).collect()] == [4, 5]
    assert sampling.skip_counts(df, {"null": F.col("v").isNotNull(), "odd": F.col("v") % 2 == 0}).first().asDict() == {"total": 10, "kept": 3, "null": 4, "odd": 3}
    assert sampling.search(df, "v", "7").count() == 1 and sampling.search(df, "v", "NONE").count() == 4 and sampling.search(df, "w", "x").count() == 0


def test_checklist_join_falls_back_on_the_checklist_rows_instruction(spark):
    rollouts = spark.createDataFrame([("a", "own", ["r"]), ("b", "", ["r"]), ("c", None, ["r"]), ("d", "x", ["r"])], "key string, instruction string, responses array<string>")
    lists = spark.createDataFrame([("a", "l1", "raw", 0), ("b", "old", "first", 1), ("b", "new", "", 2), ("c", "l3", None, 3), ("d", "", "raw", 4)], "key string, checklist string, raw_instruction string, _row_idx int")
    joined, left = grading.with_checklist(rollouts, lists, "set")
    assert {r["key"]: (r["instruction"], r["checklist"]) for r in joined.collect()} == {"a": ("own", "l1"), "b": ("first", "new"), "c": ("", "l3")}
    assert [r["key"] for r in left.collect()] == ["d"]


def test_format_template_fills_once():
    with pytest.raises(KeyError):
        reshape.format_template("{a}{b}", {"a": F.lit("x")})


def test_format_template_keeps_braces(spark):
    assert spark.range(1).select(reshape.format_template("{{x}} {a}{b}", {"a": F.lit("{b}"), "b": F.lit("1")})).first()[0] == "{x} {b}1"


def test_external_results_and_browsing(spark, tmp_path):
    rows = [{"input": "user\nhi\nassistant\n", "output": f"o{k}", "gts": f"g{k}"} for k in range(2)] + [{"input": "user\nyo\nassistant\n", "output": "p", "gts": "h"}]
    path = tmp_path / "x.jsonl"
    path.write_text("\n\n".join(json.dumps(r) for r in rows) + "\n  \n")
    got = {r["user_message"]: (r["gts"], r["outputs"]) for r in readers.load_external(spark, str(path)).collect()}
    assert got == {"hi": ("g0", ["o0", "o1"]), "yo": ("h", ["p"])}
    (tmp_path / "l.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "o.json").write_text(json.dumps(rows[0], indent=1))
    assert readers.browse(spark, str(tmp_path / "l.json")).count() == 3
    assert readers.browse(spark, str(tmp_path / "l.json"), 2).count() == 2
    assert readers.browse(spark, str(tmp_path / "o.json")).count() == 1


def test_quality_of_two_models(spark):
    def reply(messages, settings):
        n = len(messages[-1]["content"])
        return ["" if "silent" in messages[-1]["content"] else json.dumps({"repetitive_expression": 1, "notes": f"n{n}"}) if n % 2 else "no"]

    m1 = spark.createDataFrame([(0, "ab", ["x"]), (1, "ab", ["xy"]), (2, "", ["x"]), (3, "ab", []), (4, "ab", ["silent"])], "_row_idx int, instruction string, responses array<string>")
    m2 = spark.createDataFrame([(0, "zz", ["xy"]), (1, "zz", ["xy"]), (2, "zz", ["x"]), (3, "zz", ["x"]), (4, "zz", ["x"])], m1.schema)
    out, failed, _ = model_calls.analyze_quality(m1, m2, "{instruction}{response}", reply)
    got = {r["idx"]: (r["m1_analysis"]["notes"], r["m2_analysis"]["notes"]) for r in out.collect()}
    assert got == {0: ("n3", ""), 3: ("", "n3"), 4: ("", "n3")}
    assert {r["reason"]: r["count"] for r in failed.collect()} == {"json_parse_fail": 3, "empty_instruction": 2, "empty_response": 1, "empty_reply": 1}


def test_comparison_view(spark):
    items = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 1.0)], "_row_idx int, score_delta double")
    assert [r[0] for r in compare.viewer_sort(items, "score_delta_desc").collect()] == [1, 0, 2]
    assert [r[0] for r in compare.viewer_sort(items, "other").collect()] == [0, 1, 2]


def test_providers_have_their_retry_plans():
    assert model_calls.provider("chat", "u", "m").waits == (5, 10, 30, 60, 120)
    assert model_calls.provider("reasoner", "u", "m", "k").headers == {"Authorization": "Bearer k"}
    with pytest.raises(ValueError):
        model_calls.provider("other", "u", "m")


def test_a_stored_stage_is_not_planned_again(spark, tmp_path):
    calls = []
    plan = pipeline.Pipeline(str(tmp_path), [("one", lambda df: calls.append(1) or df)])
    assert plan.run(spark.range(3)).count() == plan.run(spark.range(9)).count() == 3
    assert calls == [1]


def test_shared_folder(spark):
    assert folders.shared_dir(spark) in folders.new_path(spark, "x")


def test_stage_queries_equal_duckdb(spark):
    duckdb = pytest.importorskip("duckdb")
    base, con = "/root/testdata/sf0.001", duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{base}/documents.parquet'")
    assert set(stage_queries.ORACLES) == set(stage_queries.QUERIES) <= set(catalogue.queries())
    for name, run in stage_queries.QUERIES.items():
        got, want = run(spark, base).toPandas(), con.sql(catalogue.oracle_sql()[name]).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols, name
        tidy = lambda x: x[cols].astype(str).sort_values(cols).reset_index(drop=True)  # noqa: B023, E731
        assert tidy(got).equals(tidy(want)), name
