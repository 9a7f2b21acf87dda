"""The registered queries and their DuckDB counterparts.

A response is a document's text; messages are conversations by turn; a rollout
group is an order's line items in a fixed order, with scores from l_discount.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.functions import replies
from verisift.functions import text as T
from verisift.operators import compare, generation, grading, model_calls, relational, reshape, rewards, verify
from verisift.operators import constraints as C
from verisift.plans import oracles as O
from verisift.plans import stage_queries
from verisift.plans.verify_queries import CASES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


for _case in CASES:
    QUERIES[_case.name] = _case.spark
    if _case.test:
        ORACLES[_case.name] = _case.sql

# --- verification of several constraints

TRUTH = '[{"instruction_id": ["punctuation:no_comma", "length_constraints:number_words"], "kwargs": [null, {"num_words": 200, "relation": "less than"}]}, {"instruction_id": ["count:lowercase_counting"], "kwargs": [{"N": 200}]}]'
TRUTH_IDS = ["punctuation:no_comma", "length_constraints:number_words", "count:lowercase_counting"]
_TOKENS = f"regexp_extract_all(text, '{O.WORD}+')"
_THREE = f"SELECT doc_id, NOT contains(text, ',') AS a, len({_TOKENS}) < 200 AS b, len(list_filter({_TOKENS}, lambda t: regexp_matches(t, '^[a-z]+$'))) <= 200 AS c FROM documents"


def _truth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(TRUTH).alias("ground_truth"))


@query(f"SELECT doc_id, concat_ws(',', a::STRING, b::STRING, c::STRING) AS results, a AND b AND c AS verification_passed FROM ({_THREE})")
def verify_multi(spark, sf_dir):
    out = verify.verify(_truth_rows(spark, sf_dir), "doc_id", "text", TRUTH_IDS)
    return out.select("doc_id", F.array_join(F.transform("individual_results", lambda b: b.cast("string")), ",").alias("results"), "verification_passed")


@query(f"SELECT count(*) AS total, count_if(a AND b AND c) AS passed, 3 * count(*) AS total_constraints, cast(sum(a::INT + b::INT + c::INT) AS BIGINT) AS passed_constraints, round(avg((a AND b AND c)::INT), 6) AS example_accuracy, round(sum(a::INT + b::INT + c::INT) / (3 * count(*)), 6) AS constraint_accuracy FROM ({_THREE})")
def verification_stats(spark, sf_dir):
    out = verify.verification_stats(verify.verify(_truth_rows(spark, sf_dir), "doc_id", "text", TRUTH_IDS))
    return out.withColumns({c: F.round(c, 6) for c in ("example_accuracy", "constraint_accuracy")})


@query(f"SELECT category, count(*) AS n, cast(sum(ok::INT) AS BIGINT) AS n_followed, round(avg(ok::INT), 6) AS accuracy FROM (SELECT unnest(['punctuation', 'length_constraints', 'count']) AS category, unnest([a, b, c]) AS ok FROM ({_THREE})) GROUP BY category")
def constraint_accuracy_by_category(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    checks = [("punctuation:no_comma", {}), ("length_constraints:number_words", {"num_words": 200, "relation": "less than"}), ("count:lowercase_counting", {"N": 200})]
    each = F.array(*[F.struct(F.lit(i.split(":")[0]).alias("category"), verify.REGISTRY[i].follows(F.col("text"), **p).alias("ok")) for i, p in checks])
    rows = docs.select(F.explode(each).alias("c")).select("c.*")
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("n_followed"), F.round(F.avg(F.col("ok").cast("int")), 6).alias("accuracy"))


@query("SELECT doc_id, pos, category, detail FROM (SELECT doc_id, unnest([0, 1, 2]) AS pos, unnest(['punctuation', 'length_constraints', 'count']) AS category, unnest(['no_comma', 'number_words', 'lowercase_counting']) AS detail FROM documents)")
def constraint_parts(spark, sf_dir):
    rows = _truth_rows(spark, sf_dir)
    return reshape.constraint_parts(rows.select("doc_id", verify.ground_truth(rows).alias("t")), F.col("t")).select("doc_id", "pos", "category", "detail")


# --- deduplication, joins, splits

_NORM = O.normalize("text")


@query(f"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY sha1({_NORM}) ORDER BY doc_id) = 1")
def dedup_first_wins(spark, sf_dir):
    return relational.dedup_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"]).select("doc_id")


@query(f"SELECT doc_id, source FROM documents WHERE {_NORM} <> '' QUALIFY row_number() OVER (PARTITION BY {_NORM}, source ORDER BY doc_id) = 1")
def dedup_lower_drop_empty(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    key = F.sha1(T.normalize(F.col("text")))
    return relational.first_wins(docs.where(T.normalize(F.col("text")) != ""), [key, "source"], ["doc_id"]).select("doc_id", "source")


@query(f"WITH k AS (SELECT doc_id, source, {_NORM} AS k FROM documents) SELECT doc_id FROM k WHERE k NOT IN (SELECT k FROM k WHERE source = 'src0')")
def anti_join_normalized(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return relational.anti_join_normalized(docs, docs.where("source = 'src0'"), "text", "text", lower=True).select("doc_id")


@query(f"WITH r AS (SELECT DISTINCT sha256({_NORM}) AS k FROM benchmark) SELECT doc_id FROM documents WHERE sha256({_NORM}) NOT IN (SELECT k FROM r)")
def anti_join_hashed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return relational.anti_join_normalized(docs, table(spark, sf_dir, "benchmark"), "text", "text", lower=True).select("doc_id")


@query("SELECT source_path, count(*) AS n, count(role) AS n_role FROM (SELECT 'documents' AS source_path, NULL AS role FROM documents UNION ALL SELECT 'benchmark', NULL FROM benchmark UNION ALL SELECT 'conversations', role FROM conversations) GROUP BY 1")
def union_sources(spark, sf_dir):
    parts = [(n, table(spark, sf_dir, n).select(*c)) for n, c in (("documents", ["text"]), ("benchmark", ["text"]), ("conversations", ["text", "role"]))]
    return relational.union_all(parts).groupBy("source_path").agg(F.count(F.lit(1)).alias("n"), F.count("role").alias("n_role"))


@query("SELECT doc_id, i AS _row_idx FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i % 4 = 1")
def round_robin_partition(spark, sf_dir):
    return relational.round_robin(relational.with_row_idx(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"]), 1, 4)


@query("SELECT doc_id, rk <= ceil(n * 0.15) AS is_test FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS rk, count(*) OVER () AS n FROM documents)")
def hash_split_exact(spark, sf_dir):
    return relational.split_exact(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 0.15).select("doc_id", "is_test")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def ordered_limit(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def merge_last_wins_left(spark, sf_dir):
    right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("_row_idx"), "o_orderkey", "o_totalprice")
    return relational.join_last_wins(table(spark, sf_dir, "customer").select("c_custkey"), right, "c_custkey", ["o_orderkey", "o_totalprice"])


@query("""WITH r AS (SELECT doc_id, ' ' || source AS t, CASE WHEN lang = 'en' THEN lang ELSE '' END AS v FROM documents WHERE source <> 'src0'),
bt AS (SELECT trim(t) AS t, arg_max(v, doc_id) AS v2 FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(nullif(r.v, ''), bt.v2) AS v FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN bt ON bt.t = d.source""")
def fallback_lookup_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    right = docs.where("source <> 'src0'").select(F.col("doc_id").alias("key"), F.concat(F.lit(" "), "source").alias("t"), F.expr("CASE WHEN lang = 'en' THEN lang ELSE '' END").alias("v"), F.col("doc_id").alias("_row_idx"))
    left = docs.select(F.col("doc_id").alias("key"), F.col("source").alias("t"))
    return relational.lookup_with_fallback(left, right, "key", "t", "v").select(F.col("key").alias("doc_id"), "v")


_KEYS = "CASE WHEN doc_id % 3 = 0 THEN concat('a_', substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12), '_x') WHEN doc_id % 3 = 1 THEN concat(source, '_', doc_id) ELSE source END"


@query(f"SELECT doc_id, CASE WHEN regexp_extract(k, '(?i)[a-f0-9]{{8}}-([a-f0-9]{{4}}-){{3}}[a-f0-9]{{12}}') <> '' THEN regexp_extract(k, '(?i)[a-f0-9]{{8}}-([a-f0-9]{{4}}-){{3}}[a-f0-9]{{12}}') ELSE regexp_extract(k, '[^_]*$') END AS core_key FROM (SELECT doc_id, {_KEYS} AS k FROM (SELECT *, md5(cast(doc_id AS STRING)) AS h FROM documents))")
def core_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("h", F.md5(F.col("doc_id").cast("string")))
    return docs.select("doc_id", T.core_key(F.expr(_KEYS)).alias("core_key"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND lang <> '' THEN lang WHEN doc_id % 5 <> 0 THEN cast(doc_id % 5 AS STRING) ELSE 'docs_' || doc_id END AS example_key FROM documents")
def example_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END").alias("uuid"), F.expr("doc_id % 5").alias("idx"))
    return docs.select("doc_id", T.example_key(docs, "docs", "doc_id").alias("example_key"))


# --- messages


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return turns.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


@query("SELECT conv_id, arg_min(text, turn) FILTER (WHERE role IN ('user', 'human') AND text <> '') AS instruction FROM conversations GROUP BY conv_id")
def first_user_message(spark, sf_dir):
    chats = _chats(spark, sf_dir)
    return chats.select("conv_id", reshape.original_instruction(chats).alias("instruction"))


@query("SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n, coalesce(string_agg(coalesce(text, ''), '|' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS responses FROM conversations GROUP BY conv_id")
def assistant_responses(spark, sf_dir):
    own = reshape.assistant_responses(F.col("messages"))
    return _chats(spark, sf_dir).select("conv_id", F.size(own).cast("long").alias("n"), F.array_join(own, "|").alias("responses"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {O.strip('text')} ELSE text END AS stripped FROM documents")
def strip_thinking(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", T.strip_thinking(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("a </think> b </think>\n"), "text")).otherwise(F.col("text"))).alias("stripped"))


@query(f"SELECT doc_id, {O.strip('text')} AS message FROM documents")
def user_message(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.user_message(F.concat(F.lit("user\n"), "text", F.lit("\nassistant\n"))).alias("message"))


@query(f"SELECT doc_id, regexp_replace(text, '{O.SPACE}+$', '') AS prompt FROM documents")
def strip_constraint_suffix(spark, sf_dir):
    c = F.lit("Use no commas. ")
    return table(spark, sf_dir, "documents").select("doc_id", T.strip_suffix(F.concat("text", F.lit(" "), c), c).alias("prompt"))


@query("SELECT doc_id, CASE WHEN length(t) > 50 THEN substr(t, 1, 47) || '...' ELSE t END AS cell FROM (SELECT doc_id, coalesce(replace(text, chr(10), '↵ '), '<null>') AS t FROM documents)")
def browse_cell(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reshape.cell(F.col("text")).alias("cell"))


# --- rewards

_SCORE = "(cast(round(l_discount * 100) AS BIGINT) % 3) / 2.0"
_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_GROUPS = f"SELECT l_orderkey, list(cast({_SCORE} AS DOUBLE) ORDER BY {_ORDER}) AS s FROM lineitem GROUP BY 1"


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.expr(_SCORE).cast("double")
    row = F.struct(*[F.col(c.strip()) for c in _ORDER.split(",")], score.alias("score"))
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("r"))
    return grouped.select("l_orderkey", F.transform("r", lambda x: x["score"]).alias("scores"))


def _rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts with two constraint results each: whether the score is positive, and whether it is 1."""
    g = _groups(spark, sf_dir)
    return g.withColumns({"passed": F.transform("scores", lambda s: s >= 1.0), "constraint_results": F.transform("scores", lambda s: F.array(s > 0, s >= 1.0))})


_BEST = ", ".join(f"coalesce(list_max(s[1:{k}]), 0) AS best_at_{k}" for k in rewards.KS)


@query(f"SELECT l_orderkey, {_BEST} FROM ({_GROUPS})")
def best_at_k(spark, sf_dir):
    return _groups(spark, sf_dir).select("l_orderkey", *[rewards.best_of_k(F.col("scores"), k).alias(f"best_at_{k}") for k in rewards.KS])


@query("SELECT l_orderkey, " + ", ".join(f"len(list_filter(s[1:{k}], lambda v: v > 0)) > 0 AS soft_at_{k}, len(list_filter(s[1:{k}], lambda v: v >= 1)) > 0 AS full_at_{k}" for k in rewards.KS) + f" FROM ({_GROUPS})")
def nonzero_at_k(spark, sf_dir):
    s = F.col("scores")
    return _groups(spark, sf_dir).select("l_orderkey", *[c for k in rewards.KS for c in (rewards.nonzero_at_k(s, k).alias(f"soft_at_{k}"), rewards.nonzero_at_k(s, k, 1.0).alias(f"full_at_{k}"))])


@query(f"SELECT l_orderkey, pos, round((v - list_avg(s)) / (sqrt(list_avg(list_transform(s, lambda x: (x - list_avg(s)) * (x - list_avg(s))))) + 1e-8), 6) AS advantage FROM (SELECT l_orderkey, s, unnest(s) AS v, generate_subscripts(s, 1) - 1 AS pos FROM ({_GROUPS}))")
def advantages(spark, sf_dir):
    return _groups(spark, sf_dir).select("l_orderkey", F.posexplode(rewards.advantages(F.col("scores"))).alias("pos", "a")).select("l_orderkey", F.col("pos").cast("long").alias("pos"), F.round("a", 6).alias("advantage"))


@query(f"SELECT l_orderkey, len(s) AS num_rollouts, len(list_filter(s, lambda v: v >= 1)) AS num_passed, round(len(list_filter(s, lambda v: v >= 1)) / len(s), 6) AS pass_rate, round((len(list_filter(s, lambda v: v > 0)) + len(list_filter(s, lambda v: v >= 1))) / (2 * len(s)), 6) AS constraint_accuracy, round(list_avg(list_transform(s, lambda x: (x - list_avg(s)) * (x - list_avg(s)))), 6) AS variance, len(list_distinct(s)) > 1 AS has_variance FROM ({_GROUPS})")
def rollout_scores(spark, sf_dir):
    r = rewards.roll_up(_rollouts(spark, sf_dir))
    return r.select("l_orderkey", F.col("num_rollouts").cast("long").alias("num_rollouts"), F.col("num_passed").cast("long").alias("num_passed"), F.round("pass_rate", 6).alias("pass_rate"), F.round("constraint_accuracy", 6).alias("constraint_accuracy"), F.round(rewards.variance(F.col("scores")), 6).alias("variance"), (~rewards.has_no_variance(F.col("scores"))).alias("has_variance"))


_KIND = "CASE WHEN list_min(s) >= 1 THEN 'perfect' WHEN list_max(s) = 0 THEN 'failed' WHEN len(list_distinct(s)) = 1 THEN 'identical_partial' ELSE 'mixed' END"


@query("SELECT count(*) AS total_prompts, cast(sum(len(s)) AS BIGINT) AS total_rollouts, cast(sum(len(list_filter(s, lambda v: v >= 1))) AS BIGINT) AS passed_rollouts, round(sum(len(list_filter(s, lambda v: v >= 1))) / sum(len(s)), 6) AS pass_rate, round(sum(len(list_filter(s, lambda v: v > 0)) + len(list_filter(s, lambda v: v >= 1))) / sum(2 * len(s)), 6) AS constraint_accuracy, " + ", ".join(f"count_if(k = '{k}') AS {k}" for k in ("perfect", "failed", "identical_partial", "mixed")) + ", " + ", ".join(f"round(avg(coalesce(list_max(s[1:{k}]), 0)), 6) AS best_at_{k}, round(count_if(len(list_filter(s[1:{k}], lambda v: v >= 1)) > 0) / count(*), 6) AS nonzero_at_{k}" for k in rewards.KS) + f" FROM (SELECT s, {_KIND} AS k FROM ({_GROUPS}))")
def analyze_metrics(spark, sf_dir):
    out = rewards.analyze(_rollouts(spark, sf_dir))
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


@query("SELECT count(*) AS rows_with_results, " + f"count_if(list_min(s) = 0 AND list_max(s) = 0) AS soft_all_zero, count_if(list_min(s) = 1 AND list_max(s) = 1) AS soft_all_one, count_if(len(list_distinct(s)) = 1) AS soft_zero_variance, count_if(list_max(s) < 1) AS hard_all_zero, count_if(list_min(s) >= 1) AS hard_all_one, count_if(list_max(s) < 1 OR list_min(s) >= 1) AS hard_zero_variance FROM ({_GROUPS})")
def reward_variance(spark, sf_dir):
    rows = _groups(spark, sf_dir).withColumn("items", F.transform("scores", lambda s: F.array((s > 0).cast("int"), (s >= 1).cast("int"))))
    rows = rows.select(rewards.soft_rewards(F.array().cast("array<double>"), F.col("items")).alias("soft"), rewards.hard_rewards(F.array().cast("array<double>"), F.col("items")).alias("hard"))
    return rewards.reward_distribution(rows, "soft", "hard")


@query(f"WITH g AS ({_GROUPS}) SELECT o_orderkey AS key, CASE WHEN len(s) >= 4 THEN coalesce(len(s), 0) ELSE 0 END AS n_checklist, CASE WHEN len(s) <= 5 THEN coalesce(len(s), 0) ELSE 0 END AS n_verifiable, (CASE WHEN len(s) >= 4 THEN coalesce(len(list_distinct(list_transform(s, lambda v: v >= 1))), 0) ELSE 0 END <= 1 OR CASE WHEN len(s) <= 5 THEN coalesce(len(list_distinct(s)), 0) ELSE 0 END <= 1) AS no_variance FROM orders LEFT JOIN g ON o_orderkey = l_orderkey")
def merge_rewards_no_variance(spark, sf_dir):
    g = _groups(spark, sf_dir).select(F.col("l_orderkey").alias("key"), F.col("scores").alias("soft"), F.transform("scores", lambda s: (s >= 1).cast("int")).alias("hard"), F.lit(0).alias("_row_idx"))
    out = rewards.merge_rewards(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")), g.where("size(soft) >= 4"), g.where("size(soft) <= 5"))
    return out.select("key", F.size("checklist_hard").cast("long").alias("n_checklist"), F.size("verifiable_soft").cast("long").alias("n_verifiable"), "no_variance")


@query(f"SELECT l_orderkey FROM ({_GROUPS}) WHERE (list_min(s) = 0 AND list_max(s) = 0) OR (list_min(s) = 1 AND list_max(s) = 1)")
def filter_rewards(spark, sf_dir):
    return rewards.filter_rewards(_groups(spark, sf_dir), "scores", "all_zero_or_one").select("l_orderkey")


# --- grading, comparison, quality

_CHAT_TOKENS = f"regexp_extract_all(text, '{O.WORD}+')"


@query(f"""WITH r AS (SELECT conv_id, coalesce(text, '') AS text FROM conversations WHERE role = 'assistant'),
c AS (SELECT conv_id, text <> '' AS full_, (NOT contains(text, ','))::INT AS a, (len({_CHAT_TOKENS}) < 200)::INT AS b, (len(list_filter({_CHAT_TOKENS}, lambda t: regexp_matches(t, '^[a-z]+$'))) <= 200)::INT AS c FROM r),
g AS (SELECT conv_id, count(*) AS n, count_if(full_ AND a + b + c = 3) AS p, sum(CASE WHEN full_ THEN a + b + c ELSE 0 END) / nullif(3 * count_if(full_), 0) AS acc, max(CASE WHEN full_ THEN (a + b + c) / 3 ELSE 0 END) AS best FROM c GROUP BY conv_id)
SELECT k.conv_id, coalesce(n, 0) AS num_rollouts, coalesce(p, 0) AS num_passed, round(coalesce(acc, 0), 6) AS constraint_accuracy, round(coalesce(best, 0), 6) AS best_soft_reward_at_16
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN g USING (conv_id)""")
def grade_rollouts(spark, sf_dir):
    chats = _chats(spark, sf_dir).select("conv_id", reshape.assistant_responses(F.col("messages")).alias("responses"), F.lit(TRUTH).alias("ground_truth"))
    out = grading.grade_rollouts(chats, "conv_id", TRUTH_IDS)
    return out.select("conv_id", F.col("num_rollouts").cast("long").alias("num_rollouts"), F.col("num_passed").cast("long").alias("num_passed"), F.round("constraint_accuracy", 6).alias("constraint_accuracy"), F.round("best_soft_reward_at_16", 6).alias("best_soft_reward_at_16"))



@query("SELECT source AS prompt, count(*) AS n_outputs, arg_min(lang, doc_id) AS gts, md5(string_agg(text, '|' ORDER BY doc_id)) AS outputs_md5, min(doc_id) AS first_row FROM documents GROUP BY source")
def group_external(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("prompt"), F.col("text").alias("output"), F.col("lang").alias("gts"), "doc_id")
    out = compare.group_by_prompt(docs, "prompt", "output", "gts", "doc_id")
    return out.select("prompt", F.size("outputs").cast("long").alias("n_outputs"), "gts", F.md5(F.array_join("outputs", "|")).alias("outputs_md5"), F.col("doc_id").alias("first_row"))


@query("SELECT * FROM (VALUES ('avg_score'), ('avg_reward_a'), ('avg_reward_b')) m(metric) JOIN (SELECT unnest(['avg_score', 'avg_reward_a', 'avg_reward_b']) AS metric, unnest([round(avg((n_chars % 5) / 4.0), 6), round(avg(CASE WHEN doc_id % 2 = 0 THEN n_chars % 7 END), 6), round(avg(CASE WHEN doc_id % 3 = 0 THEN n_chars % 3 END), 6)]) AS value FROM documents) USING (metric)")
def avg_metrics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.expr("(n_chars % 5) / 4.0").cast("double").alias("avg_score"), F.expr("CASE WHEN doc_id % 2 = 0 THEN n_chars % 7 END").cast("double").alias("avg_reward_a"), F.expr("CASE WHEN doc_id % 3 = 0 THEN n_chars % 3 END").cast("double").alias("avg_reward_b"))
    return compare.average_metrics(docs).withColumn("value", F.round("value", 6))


_SIDES = "SELECT doc_id, (n_chars % 5) / 4.0 AS s1, (n_chars % 3) / 2.0 AS s2, n_chars AS c1, length(source) AS c2, (n_chars % 7 + n_chars % 2) / 2.0 AS r1, n_chars % 4 * 1.0 AS r2 FROM documents"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    side = lambda score, chars, *r: docs.select(F.col("doc_id").alias("_row_idx"), F.expr(score).cast("double").alias("avg_score"), (F.expr(score) >= 1).cast("double").alias("pass_rate"), F.expr(chars).cast("long").alias("char_count"), *[F.expr(x).cast("double").alias(f"reward_{k}") for k, x in enumerate(r)])
    return compare.compare(side("(n_chars % 5) / 4.0", "n_chars", "n_chars % 7", "n_chars % 2"), side("(n_chars % 3) / 2.0", "length(source)", "n_chars % 4"))


@query(f"SELECT doc_id AS idx, CASE WHEN s1 > s2 THEN 'm1' WHEN s2 > s1 THEN 'm2' ELSE 'tie' END AS winner, round(cast(s1 - s2 AS DOUBLE), 6) AS score_delta, round(cast(r1 - r2 AS DOUBLE), 6) AS reward_delta, c1 - c2 AS length_delta FROM ({_SIDES})")
def positional_compare(spark, sf_dir):
    return _items(spark, sf_dir).select(F.col("_row_idx").alias("idx"), "winner", F.round("score_delta", 6).alias("score_delta"), F.round("reward_delta", 6).alias("reward_delta"), "length_delta")


@query(f"SELECT count(*) AS total, count_if(s1 > s2) AS m1_wins, count_if(s2 > s1) AS m2_wins, count_if(s1 = s2) AS ties, round(count_if(s1 > s2) / count(*) * 100, 6) AS m1_win_rate, round(count_if(s2 > s1) / count(*) * 100, 6) AS m2_win_rate, round(count_if(s1 = s2) / count(*) * 100, 6) AS tie_rate, round(avg(s1), 6) AS m1_avg_score, round(count_if(s1 >= 1) / count(*), 6) AS m1_pass_rate, round(avg(r1), 6) AS m1_avg_reward, round(avg(s2), 6) AS m2_avg_score, round(count_if(s2 >= 1) / count(*), 6) AS m2_pass_rate, round(avg(r2), 6) AS m2_avg_reward FROM ({_SIDES})")
def compare_summary(spark, sf_dir):
    out = compare.comparison_summary(_items(spark, sf_dir))
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in out.dtypes])


_FLAGS = [f"cast(doc_id % {k} = 0 AS INT)" for k in (2, 3, 5, 7, 11)]


def _analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    struct = F.struct(*[F.expr(x).alias(d) for x, d in zip(_FLAGS, replies.DIMENSIONS, strict=True)], F.expr("CASE WHEN doc_id % 4 = 0 THEN lang ELSE ' ' END").alias("notes"))
    return docs.select("doc_id", struct.alias("m1_analysis"), F.when(F.col("doc_id") % 2 == 1, struct).alias("m2_analysis"))


def _stats_sql(model: str, where: str) -> str:
    any_ = " OR ".join(f"{x} = 1" for x in _FLAGS)
    return f"SELECT '{model}' AS model, count_if({where}) AS present, count_if(NOT ({where})) AS missing, count_if(({where}) AND ({any_})) AS any_issue, count_if(({where}) AND doc_id % 4 = 0 AND lang <> '') AS notes_nonempty, " + ", ".join(f"count_if(({where}) AND {x} = 1) AS {d}" for x, d in zip(_FLAGS, replies.DIMENSIONS, strict=True)) + " FROM documents"


@query(_stats_sql("m1", "true") + " UNION ALL " + _stats_sql("m2", "doc_id % 2 = 1"))
def quality_stats(spark, sf_dir):
    return compare.quality_stats(_analyses(spark, sf_dir))


@query("SELECT doc_id, " + ", ".join(f"CASE WHEN doc_id % 2 = 1 THEN {x} ELSE -1 END AS quality_{d}" for x, d in zip(_FLAGS, replies.DIMENSIONS, strict=True)) + ", CASE WHEN doc_id % 2 = 0 THEN '' WHEN doc_id % 4 = 0 THEN lang ELSE ' ' END AS quality_notes, cast(doc_id % 2 = 1 AND (" + " OR ".join(f"{x} = 1" for x in _FLAGS) + ") AS INT) AS quality_any_issue FROM documents")
def quality_enrich(spark, sf_dir):
    return compare.quality_enrich(_analyses(spark, sf_dir), "m2_analysis").drop("m1_analysis", "m2_analysis")


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Contradictory' WHEN 1 THEN 'Not Contradictory' WHEN 2 THEN 'Contradictory' END AS label, CASE WHEN doc_id % 4 < 2 THEN 'because of ' || lang WHEN doc_id % 4 = 2 THEN 'it is contradictory' ELSE 'nothing to say' END AS justification, doc_id % 2 = 1 AS kept FROM documents")
def parse_contradiction(spark, sf_dir):
    reply = F.expr("CASE doc_id % 4 WHEN 0 THEN concat('Label: contradictory\nJustification: because of ', lang, ' ') WHEN 1 THEN concat('x\nlabel : Not Contradictory.\njustification:  because of ', lang) WHEN 2 THEN ' it is contradictory' ELSE 'nothing to say' END")
    docs = table(spark, sf_dir, "documents").select("doc_id", reply.alias("r"))
    label = replies.contradiction_label(F.col("r"))
    return docs.select("doc_id", label.alias("label"), replies.justification(F.col("r")).alias("justification"), (~relational.contradictory(label)).alias("kept"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '1,0,1' WHEN 1 THEN '0,0,0' ELSE '1,1,0' END AS scores FROM documents")
def parse_eval(spark, sf_dir):
    reply = F.expr("CASE doc_id % 3 WHEN 0 THEN 'first item\t1\n\nsecond\t0 \nthird 1\nfourth\t1' WHEN 1 THEN 'item 10\nmore\t7' ELSE 'a\t1\nb\t 1' END")
    docs = table(spark, sf_dir, "documents").select("doc_id", replies.eval_scores(reply, F.lit(3)).alias("s"))
    return docs.select("doc_id", F.array_join(F.transform("s", lambda v: v.cast("string")), ",").alias("scores"))


@query(f"""WITH g AS ({_GROUPS}), r AS (SELECT l_orderkey, s, unnest(s) AS llm_score, generate_subscripts(s, 1) - 1 AS response_index FROM g)
SELECT l_orderkey AS key, response_index, llm_score, llm_score >= 1 AS llm_pass, CASE WHEN response_index = 0 THEN 'a:1,b:0' ELSE 'a:,b:' END AS items, response_index <> 0 AS items_mismatch, list_max(s) = 0 AS soft_rewards_all_zero FROM r""")
def review_explode(spark, sf_dir):
    g = _groups(spark, sf_dir).select(
        F.col("l_orderkey").alias("key"), F.lit("do it").alias("instruction"), F.lit("a\n\n b ").alias("checklist"), F.transform("scores", lambda s: s.cast("string")).alias("responses"),
        "scores", F.array(F.array(F.lit(1), F.lit(0))).alias("individual_scores"), F.array(F.lit("raw")).alias("grader_outputs"), F.col("scores").alias("soft_rewards"), F.transform("scores", lambda s: (s >= 1).cast("int")).alias("hard_rewards"),
    )
    spell = F.array_join(F.transform("items", lambda i: F.concat(i["item"], F.lit(":"), F.coalesce(i["llm_score"].cast("string"), F.lit("")))), ",")
    out = reshape.review_rows(g)
    return out.select("key", F.col("response_index").cast("long").alias("response_index"), "llm_score", "llm_pass", spell.alias("items"), "items_mismatch", "soft_rewards_all_zero")


@query("SELECT doc_id, text AS content, CASE WHEN doc_id % 2 = 0 THEN 'creative-set' ELSE source END AS data_source, CASE WHEN doc_id % 2 = 0 THEN 'creative_writing' ELSE 'general' END AS ability, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'no_answer' END AS ground_truth, 'rule' AS style, n_chars FROM documents")
def training_format(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "n_chars", F.col("text").alias("instruction"), F.expr("CASE WHEN doc_id % 2 = 0 THEN 'creative-set' ELSE source END").alias("dataset"), F.expr("CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END").alias("ground_truth"))
    out = reshape.training_format(docs, "documents")
    return out.select(F.col("extra_info.key").alias("doc_id"), F.col("prompt")[0]["content"].alias("content"), "data_source", "ability", "reward_model.ground_truth", "reward_model.style", "extra_info.n_chars")


@query("SELECT count(*) AS n, cast(sum(doc_id) AS BIGINT) AS id_sum, flag AS empty FROM (SELECT doc_id, coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN '<EMPTY>' ELSE lang END, CASE WHEN doc_id % 2 = 0 THEN '<EMPTY>' END) = '<EMPTY>' AS f, coalesce(f, false) AS flag FROM documents) GROUP BY flag")
def split_sentinel(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN ' <EMPTY> ' ELSE lang END").alias("a"), F.expr("CASE WHEN doc_id % 2 = 0 THEN '<EMPTY>' END").alias("b"))
    empty, full = relational.split_sentinel(docs, ["a", "b"])
    both = empty.withColumn("empty", F.lit(True)).unionByName(full.withColumn("empty", F.lit(False)))
    return both.groupBy("empty").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"))


@query("SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def category_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("lang") == "en").select("doc_id", "lang")


@query("SELECT doc_id, 'Q: ' || coalesce(source, '') || ' A: ' || coalesce(lang, '') AS prompt FROM documents")
def fill_template(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", reshape.fill_template("Q: {instruction} A: {response}", {"instruction": F.coalesce("source", F.lit("")), "response": F.coalesce("lang", F.lit(""))}).alias("prompt"))


# --- generation and model calls


def _values(rows, *names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows) + f") t({', '.join(names)})"


_IDS = _values([(i,) for i in C.REGISTERED], "i")


@query(f"""WITH ids AS (SELECT i FROM {_IDS}),
edges AS (SELECT a, b FROM {_values([(a, b) for a, bs in generation.CONFLICTS.items() for b in bs], "a", "b")} UNION ALL SELECT i, i FROM ids
  UNION ALL SELECT a, i FROM {_values([(a,) for a in generation.ALL_CONFLICT], "a")}, ids
  UNION ALL SELECT x.a, i FROM (SELECT DISTINCT a FROM {_values([(a, b) for a, bs in generation.ALL_BUT.items() for b in bs], "a", "b")}) x, ids WHERE NOT EXISTS (SELECT 1 FROM {_values([(a, b) for a, bs in generation.ALL_BUT.items() for b in bs], "a2", "b2")} WHERE a2 = x.a AND b2 = i))
SELECT a, b FROM edges UNION SELECT b, a FROM edges""")
def conflict_graph(spark, sf_dir):
    return generation.conflict_table(spark)


@query()
def sample_constraints(spark, sf_dir):
    return generation.constrained_records(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "documents")


def _stub(prompt: str) -> str:
    """What the offline client says to a prompt, after its thinking."""
    return f"'reply ' || substr(sha256('0:' || {prompt}), 1, 8) || ': ' || array_to_string({O.words(prompt)}[1:12], ' ')"


@query(f"WITH a AS (SELECT doc_id, {_stub(chr(39) + 'Add a constraint to: ' + chr(39) + ' || text')} AS p FROM documents), b AS (SELECT doc_id, {_stub(chr(39) + 'Is this consistent? ' + chr(39) + ' || p')} AS r FROM a) SELECT cast(doc_id AS STRING) AS key, CASE WHEN contains(lower(r), 'not contradictory') THEN 'Not Contradictory' WHEN contains(lower(r), 'contradictory') THEN 'Contradictory' END AS contradiction_label, trim(r) AS justification FROM b")
def llm_stub_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("instruction"))
    augmented, _ = model_calls.augment(docs, "Add a constraint to: {instruction}", model_calls.stub_client)
    labelled, _ = model_calls.label_contradictions(augmented, "Is this consistent? {instruction}", model_calls.stub_client)
    return labelled.select("key", "contradiction_label", "justification")


def queries() -> dict[str, Query]:
    return QUERIES | stage_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    """DuckDB counts conditions in 128 bits; the queries count in 64."""
    return {k: re.sub(r"count_if\(", "count(*) FILTER (WHERE ", v) for k, v in (ORACLES | stage_queries.ORACLES).items()}
