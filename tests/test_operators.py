"""Relational, reward, reshape, comparison, generation, model-call, source, sink and streaming operators."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from verisift.functions import replies
from verisift.functions import text as T
from verisift.operators import compare, generation, model_calls, relational, reshape, rewards, verify
from verisift.operators import constraints as C
from verisift.plans.pipeline import Pipeline
from verisift.sources import readers, writers
from verisift.streaming import verify_stream


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# --- relational


def test_dedup_keeps_the_first_and_is_idempotent(spark):
    df = spark.createDataFrame([(3, " A  b"), (1, "a B"), (2, None), (4, ""), (5, "c")], "i int, t string").repartition(3)
    out = relational.dedup_texts(df, "t", ["i"])
    assert sorted(values(out, "i")) == [(1,), (2,), (5,)]
    assert sorted(values(relational.dedup_texts(out, "t", ["i"]), "i")) == [(1,), (2,), (5,)]


def test_anti_and_semi_join_make_the_whole(spark):
    left = spark.createDataFrame([(1, "x "), (2, None), (3, "y"), (4, "z  z")], "i int, k string")
    right = spark.createDataFrame([("X",), ("",), ("z z",)], "k string")
    out = relational.anti_join_normalized(left, right, "k", "k")
    assert sorted(values(out, "i")) == [(1,), (3,)]
    assert sorted(values(relational.anti_join_normalized(left, right, "k", "k", lower=True), "i")) == [(3,)]


def test_last_wins_and_fallback(spark):
    left = spark.createDataFrame([("a", " t1 "), ("b", "t2"), ("c", "t3")], "key string, t string")
    right = spark.createDataFrame([("a", "q", "1", 0), ("a", "q", "2", 1), ("b", "q", "", 2), ("z", "t2 ", "9", 3), ("y", "t2", "8", 4)], "key string, t string, v string, _row_idx int")
    got = dict(values(relational.lookup_with_fallback(left, right, "key", "t", "v"), "key", "v"))
    assert got == {"a": "2", "b": "8", "c": None}
    assert dict(values(relational.join_last_wins(left, right, "key", ["v"]), "key", "v")) == {"a": "2", "b": "", "c": None}


def test_positional_join_needs_equal_sides(spark):
    a, b = (relational.with_row_idx(spark.range(n).toDF(c), [c]) for n, c in ((3, "x"), (3, "y")))
    assert sorted(values(relational.positional_join(a, b), "x", "y")) == [(0, 0), (1, 1), (2, 2)]
    with pytest.raises(ValueError):
        relational.positional_join(a, b.limit(2))


def test_row_index_is_contiguous_at_any_partitioning(spark):
    for n in (1, 8):
        df = relational.with_row_idx(spark.range(50).repartition(n), ["id"])
        assert all(r["id"] == r["_row_idx"] for r in df.collect())
    parts = [relational.round_robin(df, k, 3) for k in range(3)]
    assert sum(p.count() for p in parts) == 50
    with pytest.raises(ValueError):
        relational.round_robin(df, 3, 3)


@pytest.mark.parametrize(("n", "share"), [(1, 0.15), (7, 0.5), (1000, 0.15), (20, 0.0), (20, 1.0)])
def test_exact_split(spark, n, share):
    out = relational.split_exact(spark.range(n), ["id"], share)
    assert out.count() == n and out.where("is_test").count() == math.ceil(n * share)
    again = relational.split_exact(spark.range(n).repartition(5), ["id"], share)
    assert sorted(values(out.where("is_test"), "id")) == sorted(values(again.where("is_test"), "id"))


def test_merge_steps_keeps_rows_without_a_label(spark):
    aug = spark.createDataFrame([("d_1", "p1", 0), ("d_2", "p2", 1), (None, "p3", 2)], "key string, augmented_prompt string, _row_idx int")
    fil = spark.createDataFrame([("e_1", "Contradictory", 0), ("e_1", "Not Contradictory", 1)], "key string, contradiction_label string, _row_idx int")
    chk = spark.createDataFrame([("f_2", "items", 0)], "key string, checklist string, _row_idx int")
    out = relational.merge_steps(aug, fil, chk, ["contradiction_label"], ["checklist"], drop_contradictory=True)
    assert sorted(values(out, "core_key", "contradiction_label", "checklist"), key=str) == [("1", "Not Contradictory", None), ("2", None, "items")]


def test_union_and_sentinel(spark):
    a, b = spark.createDataFrame([("<EMPTY>", None), (None, " <EMPTY> "), ("x", "<EMPTY>"), (None, None)], "a string, b string"), spark.range(2)
    empty, full = relational.split_sentinel(a, ["a", "b"])
    assert (empty.count(), full.count()) == (2, 2)
    assert relational.union_all([("p", a), ("q", b)]).count() == 6


def test_keys(spark):
    df = spark.createDataFrame([("x_0A1b2c3d-1111-2222-3333-444455556666_z",), ("ds_12",), ("plain",)], "k string")
    assert values(df.select(T.core_key(F.col("k")).alias("c")), "c") == [("0A1b2c3d-1111-2222-3333-444455556666",), ("12",), ("plain",)]
    df = spark.createDataFrame([(None, 0, 7), ("", 3, 8), ("u", 0, 9)], "id string, idx int, r int")
    assert values(df.select(T.example_key(df, "ds", "r").alias("k")), "k") == [("ds_7",), ("3",), ("u",)]


# --- rewards


def test_rewards_on_edge_groups(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 0.5]), (2, []), (3, [1.0]), (4, [0.5, 0.5]), (5, [0.0, 0.0])], "i int, scores array<double>")
    s = F.col("scores")
    got = {r["i"]: r for r in df.select("i", rewards.best_of_k(s, 1).alias("b1"), rewards.best_of_k(s, 8).alias("b8"), rewards.nonzero_at_k(s, 1).alias("n1"), rewards.advantages(s).alias("adv"), rewards.variance(s).alias("var"), rewards.has_no_variance(s).alias("flat")).collect()}
    assert (got[1]["b1"], got[1]["b8"], got[1]["n1"]) == (0.0, 1.0, False) and (got[2]["b8"], got[2]["n1"]) == (0.0, False)
    assert got[1]["adv"] == pytest.approx([-1.2247448, 1.2247448, 0.0], abs=1e-5) and got[4]["adv"] == [0.0, 0.0]
    assert [got[k]["flat"] for k in range(1, 6)] == [False, True, True, True, True]
    full = df.withColumns({"passed": F.transform("scores", lambda x: x >= 1.0), "constraint_results": F.transform("scores", lambda x: F.array(x > 0))})
    m = rewards.analyze(full).first()
    assert (m["total_prompts"], m["total_rollouts"], m["perfect"], m["failed"], m["identical_partial"], m["mixed"]) == (5, 8, 1, 1, 1, 2)
    assert m["best_at_1"] == pytest.approx((0 + 0 + 1 + 0.5 + 0) / 5)
    assert rewards.analyze(full.limit(0)).first()["pass_rate"] == 0.0


def test_reward_merge_and_filters(spark):
    base = spark.createDataFrame([("a",), ("b",)], "key string")
    side = spark.createDataFrame([("a", [0.0, 1.0], [0, 1], 0), ("a", [1.0, 1.0], [1, 0], 1)], "key string, soft array<double>, hard array<int>, _row_idx int")
    got = {r["key"]: r for r in rewards.merge_rewards(base, side, side).collect()}
    assert got["a"]["checklist_soft"] == [1.0, 1.0] and got["a"]["no_variance"] and got["b"]["verifiable_hard"] == [] and got["b"]["no_variance"]
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0, 1.0]), (3, []), (4, [0.0, 1.0])], "i int, r array<double>")
    assert values(rewards.filter_rewards(df, "r", "all_zero_or_one"), "i") == [(1,), (2,)]


# --- replies and reshape


def test_reply_parsers(spark):
    rows = [("a\t1\nb\t0\n\nc 1", 3), ("item 10", 2), ("a\t7\nb\tx 1", 1), ("", 2), ("a\t+1\nb\t01", 2)]
    df = spark.createDataFrame(rows, "r string, n int")
    assert [r[0] for r in df.select(replies.eval_scores(F.col("r"), F.col("n"))).collect()] == [[1, 0, 1], [0, 0], [1], [0, 0], [1, 1]]
    rows = ["Label: Contradictory\nJustification: x", "LABEL : not contradictory", "so it is not contradictory", "none", "label: maybe\nnot contradictory at all"]
    df = spark.createDataFrame([(r,) for r in rows], "r string")
    assert [r[0] for r in df.select(replies.contradiction_label(F.col("r"))).collect()] == ["Contradictory", "Not Contradictory", "Not Contradictory", None, "Not Contradictory"]
    assert [r[0] for r in df.select(replies.justification(F.col("r"))).collect()][:2] == ["x", "LABEL : not contradictory"]


def test_quality_reply(spark):
    body = json.dumps({"incoherent_expression": 1, "logical_inconsistency": "1", "repetitive_expression": 2, "notes": None})
    rows = [f"<result> {body} </result>", f"text ```json\n{body}\n``` more", json.dumps(body), f"x {body} y", "[1] {}", "no", None]
    df = spark.createDataFrame([(r,) for r in rows], "r string")
    got = [r[0] for r in df.select(replies.quality_analysis("r")).collect()]
    assert all((g["incoherent_expression"], g["logical_inconsistency"], g["repetitive_expression"], g["notes"]) == (1, 1, 0, "None") for g in got[:4])
    assert all(g["notes"] is None for g in got[4:])


def test_instruction_lookup(spark):
    schema = "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, prompt string"
    rows = [([("system", "s"), ("user", "u")], None, "p"), ([("assistant", "a")], [("human", "h")], "p"), (None, [("gpt", "g")], "p"), ([], None, "")]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(reshape.original_instruction(df)).collect()] == ["u", "h", "p", None]
    assert [r[0] for r in df.select(reshape.original_instruction(df, strict_order=True)).collect()] == ["u", None, None, None]


def test_small_text_helpers(spark):
    df = spark.createDataFrame([("a</think>b </think> c ", "user\nhi\nassistant\n", "do it. Use X.  ", " Use X. ")], "r string, m string, p string, c string")
    r = df.select(T.strip_thinking(F.col("r")), T.user_message(F.col("m")), T.strip_suffix(F.col("p"), F.col("c")), reshape.cell(F.lit("x\n" * 40), 10)).first()
    assert list(r) == ["c", "hi", "do it.", "x↵ x↵ x..."]


def test_training_format_variants(spark):
    df = spark.createDataFrame([("k", "do", "it", "sys", "", 3)], "key string, instruction string, input string, system string, ground_truth string, x int")
    r = reshape.training_format(df, "My Creative set").first()
    assert [m["content"] for m in r["prompt"]] == ["sys", "do\nit"] and r["ability"] == "creative_writing" and r["reward_model"]["ground_truth"] == "no_answer"
    assert r["extra_info"].asDict() == {"key": "k", "x": 3}


# --- comparison


def test_comparison(spark):
    side = lambda rows: spark.createDataFrame(rows, "_row_idx int, avg_score double, pass_rate double, char_count int, reward_a double, reward_b double")
    items = compare.compare(side([(0, 1.0, 1.0, 5, 1.0, 3.0), (1, 0.0, 0.0, 5, 0.0, 0.0)]), side([(0, 0.5, 0.0, 7, 1.0, 1.0), (1, 0.0, 0.0, 1, 0.0, 2.0)]), ("x", "y"))
    assert values(items.orderBy("_row_idx"), "winner", "reward_delta", "length_delta") == [("x", 1.0, -2), ("tie", -1.0, 4)]
    s = compare.comparison_summary(items, ("x", "y")).first()
    assert (s["m1_wins"], s["m2_wins"], s["ties"], s["m1_win_rate"]) == (1, 0, 1, 50.0)
    assert compare.viewer_filter(items, winner="x", passed=(True, False)).count() == 1
    g = compare.group_by_prompt(spark.createDataFrame([("p", "b", "g2", 1), ("p", "a", "g1", 0), ("q", "c", None, 2)], "p string, o string, t string, i int"), "p", "o", "t", "i")
    assert sorted(values(g, "p", "t", "outputs"), key=str) == [("p", "g1", ["a", "b"]), ("q", None, ["c"])]


# --- generation


def test_conflicts_are_symmetric_and_samples_keep_them(spark):
    graph = generation.conflict_graph()
    assert all(a in graph[b] for a in graph for b in graph[a]) and all(a in graph[a] for a in graph)
    assert graph["copy:copy"] == set(C.REGISTERED)
    for seed in range(200):
        got = [i for i, _, _ in generation.sample_constraints(4, "write a short story now", random.Random(seed), graph)]
        assert all(b not in graph[a] for k, a in enumerate(got) for b in got[k + 1 :])


def test_generated_records_do_not_depend_on_partitions_and_can_be_verified(spark):
    df = spark.createDataFrame([(i, f"write text number {i}") for i in range(40)] + [(99, "")], "id int, t string")
    one, many = (sorted(map(str, generation.constrained_records(df.repartition(n), "id", "t", "ds").collect())) for n in (1, 6))
    assert one == many and 30 < len(one) <= 40
    rows = generation.constrained_records(df, "id", "t", "ds").withColumn("response", F.lit("some response"))
    out = verify.verify(rows, "key", "response")
    sizes = {r["key"]: len(json.loads(r["ground_truth"])) for r in rows.collect()}
    assert all(len(r["individual_results"]) == sizes[r["key"]] for r in out.collect())


def test_every_description_can_be_written():
    for id_ in C.REGISTERED:
        params = generation.sample_params(id_, random.Random(1), "say it again please")
        assert "{" not in generation.describe(id_, params).replace("{}", "")


# --- model calls


def test_calls_are_cached(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def client(messages, settings):
        import tempfile

        tempfile.NamedTemporaryFile(dir=str(calls), delete=False).close()
        return ["a</think> b </think> c", "please provide more"]

    df = spark.createDataFrame([("k1", "x"), ("k2", "x"), ("k3", "y")], "key string, instruction string")
    asked = df.withColumn("m", reshape.build_messages(F.col("instruction")))
    _, fresh = model_calls.call(asked, "m", client)
    fresh.write.parquet(str(tmp_path / "cache"))
    n = len(list(calls.iterdir()))
    assert n == 2
    cache = spark.read.parquet(str(tmp_path / "cache"))
    out, fresh = model_calls.call(asked, "m", client, cache=cache)
    assert fresh.count() == 0 and [r["replies"] for r in out.collect()] == [["b", ""]] * 3
    assert len(list(calls.iterdir())) == n
    assert model_calls.answer("x</think> y </think> z") == "y" and model_calls.answer("As an AI language model") == ""


def test_checklist_grading_and_rollouts(spark):
    df = spark.createDataFrame([("k", "do", "a\nb", ["r1", "r2"])], "key string, instruction string, checklist string, responses array<string>")
    grader = lambda messages, settings: ["a\t1\nb\t0"]
    out, _ = model_calls.grade_checklists(df, "{instruction} {checklist} {response}", grader)
    r = out.first()
    assert r["individual_scores"] == [[1, 0], [1, 0]] and r["scores"] == [0.5, 0.5]
    rolls, _ = model_calls.rollouts(df.select("key", "instruction"), model_calls.stub_client, n=3)
    assert len(rolls.first()["responses"]) == 3


# --- sources, sinks, streams, pipelines


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x"]), ("b", None)], "key string, responses array<string>")
    p = str(tmp_path)
    writers.write(df, f"{p}/one.jsonl", "json")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        writers.write(df, f"{p}/one.jsonl", "json")
    assert readers.read_any(spark, f"{p}/one.jsonl", "key string, responses array<string>").count() == 2
    writers.write(df, f"{p}/t.csv", "csv")
    assert sorted(values(readers.read_any(spark, f"{p}/t.csv"), "responses"), key=str) == [('["x"]',), (None,)]
    for path in readers.partition_paths(f"{p}/roll_p9_of_9.jsonl", 2)[:1]:
        writers.write(df, path, "json")
    paths = readers.partition_paths(f"{p}/roll.jsonl", 2)
    assert paths[1].endswith("roll_p1_of_2.jsonl")
    with pytest.raises(FileNotFoundError):
        readers.read_partitions(spark, paths)
    assert readers.read_partitions(spark, paths, missing="skip").count() == 2
    writers.write_train_test(spark.range(20), f"{p}/ds", ["id"], 0.2)
    assert readers.read_any(spark, f"{p}/ds").count() == 16 and readers.read_any(spark, f"{p}/ds", split="test").count() == 4
    assert readers.numbered_items("1. a\nb\n2. c\n\n3. d") == ["1. a\nb", "2. c", "3. d"]
    assert json.loads(writers.metrics_json(spark.range(1))) == {"id": 0}


def test_streams(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    gt = json.dumps([{"instruction_id": ["punctuation:no_comma"], "kwargs": [None]}])
    rows = [{"key": str(i), "response": r, "ground_truth": gt, "at": "2024-01-01T00:00:00"} for i, r in enumerate(["a", "a, b", " A "])]
    (folder / "f.json").write_text("\n".join(map(json.dumps, rows)))
    stream = verify_stream.read_responses(spark, str(folder))
    verify_stream.verify_stream(stream, str(out), str(tmp_path / "cp")).awaitTermination()
    assert sorted(values(spark.read.parquet(str(out)), "key", "verification_passed")) == [("0", True), ("1", False), ("2", True)]
    q = verify_stream.drop_repeats(stream, "response", "at").writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fresh").count() == 2
    q = verify_stream.constraint_rate(stream, "at").writeStream.format("memory").queryName("rate").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert values(spark.table("rate"), "n", "n_followed") == [(3, 2)]


def test_pipeline_does_not_repeat_a_stage(spark, tmp_path):
    seen = []

    def stage(df):
        seen.append(1)
        return df.withColumn("x", F.lit(len(seen)))

    for _ in range(2):
        out = Pipeline(str(tmp_path), [("s", stage)]).run(spark.range(3))
    assert {r["x"] for r in out.collect()} == {1}


# --- registered queries


def test_entry_and_oracles(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
    from verisift.plans import catalogue

    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    base, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark", "lineitem", "orders", "customer", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    for name in ("verify_multi", "dedup_first_wins", "hash_split_exact", "analyze_metrics", "merge_rewards_no_variance", "review_explode", "quality_stats", "verify_copy_repeat_phrase", "verify_detectable_format_title"):
        got = catalogue.queries()[name](spark, base).toPandas()
        want = con.sql(catalogue.oracle_sql()[name]).df()
        cols = sorted(want.columns)
        tidy = lambda x: x[cols].astype(str).sort_values(cols).reset_index(drop=True)  # noqa: B023, E731
        assert tidy(got).equals(tidy(want)), name
