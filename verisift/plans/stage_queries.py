"""Queries for sources, sinks, windows, samples, joins of stages and model calls, with their DuckDB counterparts.

A sink is checked by what a source reads back from the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.functions import replies
from verisift.functions import text as T
from verisift.operators import compare, grading, model_calls, relational, reshape, sampling
from verisift.plans import oracles as O
from verisift.plans import pipeline
from verisift.sources import folders, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.with_row_idx(docs(spark, sf_dir), ["doc_id"])


_ALL = "SELECT doc_id, text, lang, source, n_chars FROM documents"
_RANKED = "SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents"

# --- sources and sinks


def _back(df: DataFrame, fmt: str, schema: str | None = None) -> DataFrame:
    path = folders.new_path(df.sparkSession, "table") + {"json": ".jsonl", "csv": ".csv", "orc": ".orc"}.get(fmt, "")
    writers.write(df, path, fmt)
    return readers.read_any(df.sparkSession, path, schema)


_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@query(_ALL)
def table_as_parquet(spark, sf_dir):
    return _back(docs(spark, sf_dir), "parquet")


@query(_ALL)
def table_as_json_lines(spark, sf_dir):
    return _back(docs(spark, sf_dir), "json", _DDL)


@query("SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def table_as_csv(spark, sf_dir):
    out = _back(docs(spark, sf_dir).withColumn("text_md5", F.md5("text")).drop("text"), "csv", "doc_id bigint, lang string, source string, n_chars bigint, text_md5 string")
    return out.select("doc_id", "text_md5", "lang", "source", "n_chars")


@query(_ALL)
def table_as_orc(spark, sf_dir):
    return _back(docs(spark, sf_dir), "orc")


@query("SELECT doc_id, rk <= ceil(n * 0.15) AS is_test FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS rk, count(*) OVER () AS n FROM documents)")
def table_with_splits(spark, sf_dir):
    path = folders.new_path(spark, "splits")
    writers.write_train_test(docs(spark, sf_dir).select("doc_id"), path, ["doc_id"])
    parts = [readers.read_any(spark, path, split=s).withColumn("is_test", F.lit(s == "test")) for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query(f"SELECT doc_id, idx % 3 AS part FROM ({_RANKED})")
def partitioned_output(spark, sf_dir):
    base = folders.new_path(spark, "parts")
    paths, rows = readers.partition_paths(base, 3), indexed(spark, sf_dir).select("doc_id", "_row_idx")
    for k, path in enumerate(paths):
        writers.write(relational.round_robin(rows, k, 3), path)
    return readers.read_partitions(spark, paths).select("doc_id", (F.col("_row_idx") % 3).alias("part"))


@query("SELECT CASE WHEN lang = 'en' THEN '<EMPTY>' ELSE lang END AS v, lang = 'en' AS empty, count(*) AS n FROM documents GROUP BY 1, 2")
def sentinel_output(spark, sf_dir):
    path = folders.new_path(spark, "sentinel")
    writers.write_splits(docs(spark, sf_dir).select(F.expr("CASE WHEN lang = 'en' THEN '<EMPTY>' ELSE lang END").alias("v")), path, ["v"])
    parts = [spark.read.parquet(path + s).withColumn("empty", F.lit(s == "_empty")) for s in ("_empty", "_non_empty")]
    return parts[0].unionByName(parts[1]).groupBy("v", "empty").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {O.strip('source')} AS user_message, arg_min(lang, doc_id) AS gts, count(*) AS n, md5(string_agg(text, '|' ORDER BY doc_id)) AS outputs_md5 FROM documents GROUP BY 1")
def external_results(spark, sf_dir):
    rows = docs(spark, sf_dir).orderBy("doc_id").select(F.concat(F.lit("user\n"), "source", F.lit("\nassistant\n")).alias("input"), F.col("text").alias("output"), F.col("lang").alias("gts"))
    path = folders.new_path(spark, "external") + ".jsonl"
    rows.coalesce(1).write.option("ignoreNullFields", False).json(path)
    out = readers.load_external(spark, path)
    return out.select("user_message", "gts", F.size("outputs").cast("long").alias("n"), F.md5(F.array_join("outputs", "|")).alias("outputs_md5"))


@query("SELECT count(*) AS n, cast(sum(n_chars) AS BIGINT) AS n_chars FROM documents")
def metrics_output(spark, sf_dir):
    row = docs(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))
    found = json.loads(writers.metrics_json(row))
    return spark.createDataFrame([(found["n"], found["n_chars"])], "n long, n_chars long")


@query("SELECT doc_id, [{'role': 'user', 'content': text}][1].content AS content, lang FROM documents")
def prompt_dump(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", reshape.build_messages(F.col("text")).alias("messages"), "lang")
    return writers.prompts(rows, "messages", ["doc_id", "lang"]).select("doc_id", F.col("prompt")[0]["content"].alias("content"), "lang")


# --- windows, samples, searches


@query(f"SELECT doc_id, idx FROM ({_RANKED}) WHERE idx >= 17 AND idx < 17 + 100")
def limit_submitted(spark, sf_dir):
    return sampling.submitted(indexed(spark, sf_dir), 17, 100).select("doc_id", F.col("_row_idx").alias("idx"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 50")
def limit_successful(spark, sf_dir):
    return sampling.successful(docs(spark, sf_dir), F.col("lang") == "en", 50, "doc_id").select("doc_id")


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 30")
def limit_first(spark, sf_dir):
    return sampling.first_rows(docs(spark, sf_dir), 30, "doc_id").select("doc_id")


@query("SELECT doc_id FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 101")
def sample_exact(spark, sf_dir):
    return sampling.sample_rows(docs(spark, sf_dir).select("doc_id"), 101, 7, "doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS draw FROM documents QUALIFY draw <= 60")
def sample_in_draw_order(spark, sf_dir):
    return sampling.draw_rows(docs(spark, sf_dir).select("doc_id"), 200, 60, 42, "doc_id").select("doc_id", F.col("_draw").alias("draw"))


@query("SELECT doc_id, '1. Use no commas.' || chr(10) || '2. Write in verse.' AS reference FROM documents")
def reference_constraints(spark, sf_dir):
    draw = sampling.sample_reference(["1. Use no commas.", "2. Write in verse."], 2)
    return docs(spark, sf_dir).select("doc_id", draw(F.col("doc_id")).alias("reference"))


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'st')")
def column_search(spark, sf_dir):
    return sampling.search(docs(spark, sf_dir), "text", "ST").select("doc_id")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE text <> '' AND lang = 'en') AS kept, count(*) FILTER (WHERE text IS NULL OR text = '') AS no_instruction, count(*) FILTER (WHERE text <> '' AND lang <> 'en') AS no_truth FROM documents")
def skipped_rows(spark, sf_dir):
    return sampling.skip_counts(docs(spark, sf_dir), {"no_instruction": F.col("text") != "", "no_truth": F.col("lang") == "en"})


# --- joins of stages


@query(f"SELECT doc_id, len({O.words('coalesce(text, chr(32))')}) AS word_count, coalesce(length(text), 0) AS char_count, round((n_chars % 5) / 4.0, 6) AS avg_score, round(n_chars % 7 * 1.0, 6) AS reward_judge FROM documents")
def model_rows(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("_row_idx", F.col("doc_id"))
    rollouts = rows.select("_row_idx", F.array("text").alias("responses"))
    graded = rows.select("_row_idx", F.expr("(n_chars % 5) / 4.0").cast("double").alias("avg_score"), F.expr("n_chars % 7").cast("double").alias("avg_reward_root_models_judge"))
    out = compare.model_rows(rollouts, graded)
    return out.select(F.col("_row_idx").alias("doc_id"), "word_count", "char_count", F.round("avg_score", 6).alias("avg_score"), F.round("reward_judge", 6).alias("reward_judge"))


@query("SELECT doc_id, row_number() OVER (ORDER BY n_chars % 11 - n_chars % 5 DESC, doc_id) AS place FROM documents QUALIFY place <= 40")
def viewer_sort(spark, sf_dir):
    items = docs(spark, sf_dir).select(F.col("doc_id").alias("_row_idx"), F.expr("n_chars % 11 - n_chars % 5").alias("score_delta"))
    first = relational.with_row_idx(compare.viewer_sort(items, "score_delta_desc").limit(40), None, "place")
    return first.select(F.col("_row_idx").alias("doc_id"), (F.col("place") + 1).alias("place"))


@query("SELECT d.doc_id, coalesce(nullif(CASE WHEN d.doc_id % 2 = 0 THEN d.lang ELSE '' END, ''), CASE WHEN d.doc_id % 3 = 0 THEN d.source END, '') AS instruction, 'list of ' || d.source AS checklist FROM documents d WHERE d.doc_id % 5 <> 0 AND d.doc_id > 0")
def checklist_join(spark, sf_dir):
    base = docs(spark, sf_dir).where("doc_id > 0")
    rollouts = base.select(F.col("doc_id").cast("string").alias("key"), F.expr("CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END").alias("instruction"), F.array("text").alias("responses"))
    lists = base.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("_row_idx"), F.expr("CASE WHEN doc_id % 5 <> 0 THEN concat('list of ', source) END").alias("checklist"), F.expr("CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END").alias("raw_instruction"))
    joined, _ = grading.with_checklist(rollouts, lists, "docs")
    return joined.select(F.col("key").cast("long").alias("doc_id"), "instruction", "checklist")


@query("SELECT count(*) AS total_rows, count(*) FILTER (WHERE doc_id % 3 = 0) AS rows_with_results, count(*) FILTER (WHERE doc_id % 3 <> 0) AS missing_results FROM documents")
def missing_results(spark, sf_dir):
    base = docs(spark, sf_dir).select(F.col("doc_id").alias("key"))
    results = base.where("key % 3 = 0").withColumns({"_row_idx": F.lit(0), "s": F.lit(1)})
    return grading.result_counts(grading.with_results(base, results, ["s"]))


@query("SELECT doc_id, CASE WHEN doc_id > 0 AND doc_id % 2 = 0 THEN 2 ELSE 0 END AS n_soft, CASE WHEN doc_id > 0 AND doc_id % 2 = 0 THEN doc_id % 7 * 0.5 END AS first_soft FROM documents")
def review_rewards(spark, sf_dir):
    base = docs(spark, sf_dir)
    graded = base.where("doc_id % 2 = 0").select(F.col("doc_id").alias("uuid"), F.col("doc_id").alias("_row_idx"), F.expr("array(doc_id % 7 * 0.5D, 1D)").alias("soft_rewards"), F.expr("array(1, 0)").alias("hard_rewards"))
    out = reshape.review_rewards(base.select(F.col("doc_id").cast("string").alias("key")), graded)
    return out.select(F.col("key").cast("long").alias("doc_id"), F.size("soft_rewards").alias("n_soft"), F.get("soft_rewards", F.lit(0)).alias("first_soft"))


@query(f"SELECT doc_id, doc_id % 3 = 0 AS has_quality, CASE WHEN doc_id % 3 = 0 THEN doc_id % 2 ELSE -1 END AS {replies.DIMENSIONS[0]} FROM documents")
def attached_quality(spark, sf_dir):
    base = docs(spark, sf_dir).select(F.col("doc_id").alias("_row_idx"))
    flags = F.struct(*[F.expr("cast(_row_idx % 2 AS INT)" if k == 0 else "0").alias(d) for k, d in enumerate(replies.DIMENSIONS)], F.lit("").alias("notes"))
    found = base.where("_row_idx % 3 = 0").select(F.col("_row_idx").alias("idx"), flags.alias("m1_analysis"), flags.alias("m2_analysis"))
    out = compare.attach_quality(base, found)
    return out.select(F.col("_row_idx").alias("doc_id"), F.col("m1_quality").isNotNull().alias("has_quality"), F.coalesce(F.col(f"m2_quality.{replies.DIMENSIONS[0]}").cast("long"), F.lit(-1)).alias(replies.DIMENSIONS[0]))


@query("SELECT doc_id, 'Q {response} ' || source || ' A ' || lang AS prompt FROM documents")
def format_template(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", reshape.format_template("Q {instruction} A {response}", {"instruction": F.concat(F.lit("{response} "), "source"), "response": F.col("lang")}).alias("prompt"))


# --- model calls with offline clients


def judge(messages: list[dict], settings: dict) -> list[str]:
    """Flags repetition by the length of the prompt; fails to give JSON for every seventh."""
    n = len(messages[-1]["content"])
    return ["no idea" if n % 7 == 0 else "<result>" + json.dumps({replies.DIMENSIONS[3]: n % 2, "notes": str(n)}) + "</result>"]


_QUALITY = "SELECT doc_id, length('rate ' || lang || ': ' || text) AS n FROM documents WHERE text <> '' AND lang <> ''"


@query(f"SELECT doc_id AS idx, n % 2 AS repetition, cast(n AS STRING) AS notes FROM ({_QUALITY}) WHERE n % 7 <> 0")
def analyze_quality(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("doc_id").alias("_row_idx"), F.col("lang").alias("instruction"), F.array("text").alias("responses"))
    out, _, _ = model_calls.analyze_quality(rows, None, "rate {instruction}: {response}", judge)
    return out.select("idx", F.col(f"m1_analysis.{replies.DIMENSIONS[3]}").cast("long").alias("repetition"), "m1_analysis.notes")


@query(f"SELECT 'json_parse_fail' AS reason, count(*) AS count FROM ({_QUALITY}) WHERE n % 7 = 0 HAVING count(*) > 0 UNION ALL SELECT 'empty_response', count(*) FROM documents WHERE (text = '' OR text IS NULL) AND lang <> '' HAVING count(*) > 0 UNION ALL SELECT 'empty_instruction', count(*) FROM documents WHERE lang = '' OR lang IS NULL HAVING count(*) > 0")
def quality_failures(spark, sf_dir):
    rows = docs(spark, sf_dir).select(F.col("doc_id").alias("_row_idx"), F.col("lang").alias("instruction"), F.array("text").alias("responses"))
    return model_calls.analyze_quality(rows, None, "rate {instruction}: {response}", judge)[1]


def grader(messages: list[dict], settings: dict) -> list[str]:
    """Two items, scored by the length of the prompt."""
    n = len(messages[-1]["content"])
    return [f"first\t{n % 2}\nsecond\t1"]


def actor(messages: list[dict], settings: dict) -> list[str]:
    """As many replies as are asked for, each longer by one mark than the one before."""
    text = messages[-1]["content"]
    return ["<think>x</think>" + text + "!" * k for k in range(int(settings.get("n", 1)))]


_ROLL = "list_transform([0, 1, 2], lambda k: (length('grade ') + length(source) + length('a' || chr(10) || 'b') + length(source) + 2 + k) % 2)"


@query(f"SELECT doc_id, len(s) AS n, list_sum(list_transform(s, lambda v: (v + 1) / 2.0)) AS total FROM (SELECT doc_id, {_ROLL} AS s FROM documents WHERE doc_id % 4 <> 0 AND doc_id > 0)")
def rollouts_and_grades(spark, sf_dir):
    base = docs(spark, sf_dir).where("doc_id > 0")
    lists = base.where("doc_id % 4 <> 0").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("_row_idx"), F.lit("a\nb").alias("checklist"))
    plan = pipeline.rollouts_and_grades(folders.new_path(spark, "rollouts"), actor, grader, lists, "grade {instruction} {checklist} {response}", "docs", 3)
    out = plan.run(base.select(F.col("doc_id").cast("string").alias("key"), F.col("source").alias("instruction")))
    return out.select(F.col("key").cast("long").alias("doc_id"), F.size("scores").cast("long").alias("n"), F.aggregate("scores", F.lit(0.0), lambda a, x: a + x).alias("total"))


def says(messages: list[dict], settings: dict) -> list[str]:
    """An echo, a label or a list, by the first word of the prompt."""
    word, _, rest = messages[-1]["content"].partition(" ")
    return [{"augment": rest + " now", "label": "Label: " + ("contradictory" if len(rest) % 3 == 0 else "not contradictory") + "\nJustification: " + rest}.get(word, "1. " + rest)]


@query("SELECT cast(doc_id AS STRING) AS key, source || ' now' AS augmented_prompt, '1. ' || source || ' now' AS checklist FROM documents WHERE length(source || ' now') % 3 <> 0")
def instruction_pipeline(spark, sf_dir):
    plan = pipeline.instructions(folders.new_path(spark, "instructions"), says, {"augment": "augment {instruction}", "contradict": "label {instruction}", "checklist": "list {instruction}"}, drop_contradictory=True)
    out = plan.run(docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("key"), F.col("source").alias("instruction")))
    return out.select("key", "augmented_prompt", "checklist")
