"""Projections between the record forms of the pipeline."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.functions import replies
from verisift.functions import text as T

TEXT_FIELDS = ("prompt", "instruction", "text", "input", "question")
#: Columns that do not go into extra_info.
NOT_EXTRA = ["messages", "conversations", "response", "output", "answer", "label", "dataset", "ability", "ground_truth", "instruction", "input", "system"]


def first_message(messages: Column, role: str = "role", content: str = "content", roles: tuple[str, ...] = ("user", "human")) -> Column:
    """Content of the first message of one of the roles that is not empty."""
    return F.get(F.filter(messages, lambda m: m[role].isin(*roles) & (m[content] != "")), F.lit(0))[content]


def original_instruction(df: DataFrame, field: str | None = None, strict_order: bool = False) -> Column:
    """The instruction of a row: a named field, else the first user message, else a text field.

    With strict_order a messages list without a user message ends the search.
    """
    kinds = dict(df.dtypes)
    full = lambda c: F.when(T.truthy(F.col(c), "string"), F.col(c))
    found = []
    if field and field in kinds:
        found.append(full(field) if kinds[field] == "string" else first_message(F.col(field)))
    chats = [(c, *names) for c, names in (("messages", ("role", "content")), ("conversations", ("from", "value"))) if c in kinds]
    flat = [full(c) for c in TEXT_FIELDS if kinds.get(c) == "string"]
    if not strict_order:
        return F.coalesce(*found, *[first_message(F.col(c), r, v) for c, r, v in chats], *flat, F.lit(None).cast("string"))
    rest = F.coalesce(*flat, F.lit(None).cast("string"))
    for c, r, v in reversed(chats):
        rest = F.when(F.col(c).isNotNull() & (F.size(c) > 0), first_message(F.col(c), r, v)).otherwise(rest)
    return F.coalesce(*found, rest)


def assistant_responses(messages: Column) -> Column:
    return F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: F.coalesce(m["content"], F.lit("")))


def build_messages(user: Column, system: Column | None = None, merged: bool = False) -> Column:
    """System and user messages, or both texts in one user message."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    if system is None:
        return F.array(message("user", user))
    if merged:
        return F.array(message("user", F.concat(system, F.lit("\n\n"), user)))
    return F.array(message("system", system), message("user", user))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """template with {name} replaced one after the other, in the order given."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def constraint_parts(df: DataFrame, truth: Column) -> DataFrame:
    """One row for each constraint of a ground truth: pos, category, detail, kwargs."""
    ids = F.flatten(F.transform(truth, lambda g: F.transform(g["instruction_id"], lambda i, k: F.struct(i.alias("id"), F.get(g["kwargs"], k).alias("kwargs")))))
    out = df.select("*", F.posexplode(ids).alias("pos", "_c"))
    return out.select(*df.columns, "pos", F.substring_index("_c.id", ":", 1).alias("category"), F.regexp_extract("_c.id", "^[^:]*:(.*)$", 1).alias("detail"), F.col("_c.kwargs").alias("kwargs"))


def training_format(df: DataFrame, data_source: str, ground_truth: str = "ground_truth_verifiable", messages: str = "messages_verifiable") -> DataFrame:
    """prompt, data_source, ability, reward_model and extra_info of each row."""
    have = set(df.columns)
    chat = next((c for c in (messages, "messages", "conversations") if c in have), None)
    if chat:
        prompt = F.col(chat)
    elif have & {"instruction", "input"}:
        part = lambda c: F.coalesce(c, F.lit("")) if c in have else F.lit("")
        user = F.when(part("input") != "", T.strip(F.concat(part("instruction"), F.lit("\n"), part("input")))).otherwise(part("instruction"))
        with_system = build_messages(user, F.col("system")) if "system" in have else None
        prompt = build_messages(user) if with_system is None else F.when(F.coalesce(F.col("system"), F.lit("")) != "", with_system).otherwise(build_messages(user))
    else:
        prompt = F.array().cast("array<struct<role:string,content:string>>")
    source = F.col("dataset") if "dataset" in have else F.lit(data_source)
    ability = F.col("ability") if "ability" in have else F.when(F.lower(source).contains("creative"), "creative_writing").otherwise("general")
    truths = [F.when(F.col(c) != "", F.col(c)) for c in (ground_truth, "ground_truth") if c in have]
    extra = [c for c in df.columns if c == "key" or c not in {*NOT_EXTRA, ground_truth, messages}]
    return df.select(
        prompt.alias("prompt"), source.alias("data_source"), ability.alias("ability"),
        F.struct(F.coalesce(*truths, F.lit("no_answer")).alias("ground_truth"), F.lit("rule").alias("style")).alias("reward_model"),
        (F.struct(*extra) if extra else F.struct(F.lit(None).cast("string").alias("key"))).alias("extra_info"),
    )


def item_rows(items: Column, scores: Column) -> Column:
    """(item, llm_score) pairs up to the longer list; a missing item is empty, a missing score null."""
    return F.transform(F.arrays_zip(items.alias("a"), scores.alias("b")), lambda z: F.struct(F.coalesce(z["a"], F.lit("")).alias("item"), z["b"].alias("llm_score")))


def review_rows(df: DataFrame) -> DataFrame:
    """One row for each response of a checklist-graded record, for human review.

    df: key, instruction, checklist, responses, scores, individual_scores, grader_outputs, soft_rewards, hard_rewards.
    """
    items = df.withColumn("checklist_items", replies.checklist_items(F.col("checklist")))
    rows = items.select("*", F.posexplode("responses").alias("response_index", "response"))
    own = F.coalesce(F.get("individual_scores", F.col("response_index")), F.array().cast("array<int>"))
    rows = rows.withColumn("llm_individual_scores", own).withColumn("llm_score", F.get("scores", F.col("response_index")))
    every = lambda v: (F.size("soft_rewards") > 0) & F.forall("soft_rewards", lambda r: r == v)
    return rows.select(
        "key", "response_index", "instruction", "response", "checklist", "checklist_items",
        item_rows(F.col("checklist_items"), F.col("llm_individual_scores")).alias("items"),
        (F.size("checklist_items") != F.size("llm_individual_scores")).alias("items_mismatch"),
        "llm_individual_scores", "llm_score", F.coalesce(F.col("llm_score") >= 1.0, F.lit(False)).alias("llm_pass"),
        F.coalesce(F.get("grader_outputs", F.col("response_index")), F.lit("")).alias("llm_raw_output"),
        F.size("checklist_items").alias("num_items"), "soft_rewards", "hard_rewards",
        every(0).alias("soft_rewards_all_zero"), every(1).alias("soft_rewards_all_one"),
    )


def review_rewards(records: DataFrame, graded: DataFrame, soft: str = "soft_rewards", hard: str = "hard_rewards", index: str = "_row_idx") -> DataFrame:
    """records LEFT JOIN the soft and hard rewards of graded rows by their own key; empty lists where there are none, and the last row of a key counts."""
    from verisift.operators.relational import last_wins

    kinds = dict(graded.dtypes)
    own = [F.when(T.truthy(F.col(c), kinds[c]), F.col(c).cast("string")) for c in ("id", "uuid", "key", "idx", "index") if c in kinds]
    side = graded.select(F.coalesce(*own, F.lit(None).cast("string")).alias("key"), F.col(index).alias("_i"), *[(F.col(c) if c in kinds else F.array()).cast(t).alias(n) for c, n, t in ((soft, "soft_rewards", "array<double>"), (hard, "hard_rewards", "array<int>"))])
    side = last_wins(side.where(F.col("key").isNotNull()), ["key"], "_i").drop("_i")
    out = records.drop("soft_rewards", "hard_rewards").join(side, "key", "left")
    return out.withColumns({"soft_rewards": F.coalesce("soft_rewards", F.array().cast("array<double>")), "hard_rewards": F.coalesce("hard_rewards", F.array().cast("array<int>"))})


def column_instruction(df: DataFrame, field: str) -> Column:
    """A column as an instruction: text as it is, or the first user message of a chat."""
    return F.col(field) if dict(df.dtypes)[field] == "string" else first_message(F.col(field))


def format_template(template: str, values: dict[str, Column]) -> Column:
    """template with its {name} fields filled all at once: what a value holds is not filled again; {{ and }} are braces."""
    parts = [(text, name) for text, name, _, _ in string.Formatter().parse(template)]
    unknown = {name for _, name in parts if name is not None} - set(values)
    if unknown:
        raise KeyError(sorted(unknown)[0])
    return F.concat(F.lit(""), *[c for text, name in parts for c in (F.lit(text), *([values[name]] if name is not None else []))])


def cell(value: Column, width: int = 50) -> Column:
    """A value as one line of at most width characters."""
    x = F.replace(value.cast("string"), F.lit("\n"), F.lit("↵ "))
    return F.coalesce(F.when(F.length(x) > width, F.concat(F.substring(x, 1, width - 3), F.lit("..."))).otherwise(x), F.lit("<null>"))
