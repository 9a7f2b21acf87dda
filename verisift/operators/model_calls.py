"""The model-call operator: cached, bounded, and with an injected client.

Calls run inside Arrow batches, a few at a time per task. The cache is a Parquet
table keyed by a hash of model, generation settings and messages: only misses
reach the client, and empty replies are not kept, so they are asked again.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.functions import replies
from verisift.functions import text as T
from verisift.operators import reshape

#: A client takes messages and settings and returns one or more reply texts.
Client = Callable[[list[dict], dict], list[str]]
#: Replies with these words are refusals.
REFUSALS = ["please provide", "to assist you", "as an ai language model"]
#: Seconds to wait before each retry.
WAITS = {"reasoner": (5, 10), "chat": (5, 10, 30, 60, 120), "plain": ()}
CACHE = "cache_key string, replies array<string>"


def stub_client(messages: list[dict], settings: dict) -> list[str]:
    """Deterministic offline replies: a digest of the prompt and an echo of its first words."""
    text = "\n".join(m["content"] or "" for m in messages)
    n = int(settings.get("n", 1))
    return [f"<think>{k}</think> reply {hashlib.sha256(f'{k}:{text}'.encode()).hexdigest()[:8]}: {' '.join(text.split()[:12])}" for k in range(n)]


@dataclass
class HttpClient:
    """Posts to a chat-completions endpoint; a failed call is repeated after the given waits, then gives no reply."""

    url: str
    model: str
    headers: dict = field(default_factory=dict)
    timeout: float = 120.0
    waits: tuple[float, ...] = (5, 10)

    def __call__(self, messages: list[dict], settings: dict) -> list[str]:
        body = json.dumps({"model": self.model, "messages": messages} | settings).encode()
        for wait in (*self.waits, None):
            try:
                request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"} | self.headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    found = [text for text in _texts(json.load(reply)) if text]
                return found
            except (OSError, ValueError):
                if wait is not None:
                    time.sleep(wait)
        return []


def provider(kind: str, url: str, model: str, api_key: str | None = None) -> HttpClient:
    """A client with the retry plan of a kind: reasoner (two retries), chat (five, longer and longer) or plain (none)."""
    if kind not in WAITS:
        raise ValueError(f"unknown kind of provider: {kind}")
    headers = {"Authorization": f"Bearer {api_key}"} if api_key else {}
    return HttpClient(url, model, headers, waits=WAITS[kind])


def _texts(value) -> list[str]:
    """Reply texts in a response of unknown form: choices, then the usual field names, at any depth."""
    if isinstance(value, str):
        return [value]
    if isinstance(value, list):
        return [t for v in value for t in _texts(v)]
    if isinstance(value, dict):
        for name in ("choices", "message", "content", "output", "response", "result", "data", "text", "reply"):
            if value.get(name):
                return _texts(value[name])
    return []


def answer(reply: str) -> str:
    """The second part of a reply split at </think>, stripped; refusals are empty."""
    out = reply.split("</think>")[1].strip() if "</think>" in reply else reply
    return "" if any(r in out.lower() for r in REFUSALS) else out


def cache_key(model: str, settings: dict, messages: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(model), F.lit(json.dumps(settings, sort_keys=True)), F.to_json(messages)), 256)


def call(df: DataFrame, messages: str, client: Client, model: str = "stub", settings: dict | None = None, cache: DataFrame | None = None, in_flight: int = 4, out: str = "replies") -> tuple[DataFrame, DataFrame]:
    """(df with out: array of answers, rows to add to the cache: cache_key, replies).

    Equal prompts are asked once. Store the new rows before using them twice, else
    the calls run again.
    """
    settings = settings or {}
    keyed = df.withColumn("cache_key", cache_key(model, settings, F.col(messages)))
    asked = keyed.groupBy("cache_key").agg(F.first(messages).alias("messages"))
    if cache is not None:
        asked = asked.join(cache.select("cache_key"), "cache_key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(chat) -> list[str]:
            return client([{"role": m["role"], "content": m["content"]} for m in chat], settings)

        with ThreadPoolExecutor(in_flight) as pool:
            for batch in batches:
                found = list(pool.map(one, batch["messages"]))
                yield pd.DataFrame({"cache_key": batch["cache_key"], "replies": found})

    fresh = asked.mapInPandas(run, CACHE)
    known = fresh if cache is None else cache.select("cache_key", "replies").unionByName(fresh)
    spoken = F.transform("replies", lambda r: _answer(r))
    answered = known.select("cache_key", spoken.alias("_replies"))
    joined = keyed.join(answered, "cache_key", "left").withColumn(out, F.coalesce("_replies", F.array().cast("array<string>"))).drop("cache_key", "_replies")
    return joined, fresh.where(F.exists("replies", lambda r: r != ""))


def _answer(reply: Column) -> Column:
    """answer() as a native column."""
    from verisift.functions.text import strip

    out = F.when(reply.contains("</think>"), strip(F.get(F.split(reply, "</think>"), F.lit(1)))).otherwise(reply)
    refused = F.lit(False)
    for r in REFUSALS:
        refused = refused | F.lower(out).contains(r)
    return F.when(refused, "").otherwise(out)


def augment(df: DataFrame, template: str, client: Client, **options) -> tuple[DataFrame, DataFrame]:
    """key, raw_prompt, augmented_prompt, messages of df (key, instruction)."""
    prompt = reshape.fill_template(template, {"instruction": F.col("instruction")})
    asked, fresh = call(df.withColumn("_m", reshape.build_messages(prompt)), "_m", client, **options)
    text = F.get("replies", F.lit(0))
    return asked.select("key", F.col("instruction").alias("raw_prompt"), text.alias("augmented_prompt"), reshape.build_messages(text).alias("messages")), fresh


def label_contradictions(df: DataFrame, template: str, client: Client, **options) -> tuple[DataFrame, DataFrame]:
    """key, raw_prompt, contradiction_label, justification, raw_response of df (key, augmented_prompt)."""
    prompt = reshape.fill_template(template, {"instruction": F.col("augmented_prompt")})
    asked, fresh = call(df.withColumn("_m", reshape.build_messages(prompt)), "_m", client, **options)
    text = F.get("replies", F.lit(0))
    return asked.select("key", F.col("augmented_prompt").alias("raw_prompt"), replies.contradiction_label(text).alias("contradiction_label"), replies.justification(text).alias("justification"), text.alias("raw_response")), fresh


def extract_checklists(df: DataFrame, template: str, client: Client, **options) -> tuple[DataFrame, DataFrame]:
    """key, raw_instruction, checklist of df (key, augmented_prompt)."""
    prompt = reshape.fill_template(template, {"instruction": F.col("augmented_prompt")})
    asked, fresh = call(df.withColumn("_m", reshape.build_messages(prompt)), "_m", client, **options)
    return asked.select("key", F.col("augmented_prompt").alias("raw_instruction"), F.get("replies", F.lit(0)).alias("checklist")), fresh


def grade_checklists(df: DataFrame, template: str, client: Client, **options) -> tuple[DataFrame, DataFrame]:
    """df (key, instruction, checklist, responses) plus individual_scores, grader_outputs and scores, by response."""
    rows = df.select("key", "instruction", "checklist", F.posexplode("responses").alias("pos", "response"))
    prompt = reshape.fill_template(template, {"instruction": F.col("instruction"), "checklist": F.col("checklist"), "response": F.col("response")})
    asked, fresh = call(rows.withColumn("_m", reshape.build_messages(prompt)), "_m", client, **options)
    text = F.coalesce(F.get("replies", F.lit(0)), F.lit(""))
    n = F.size(replies.checklist_items(F.col("checklist")))
    each = asked.select("key", F.struct("pos", replies.eval_scores(text, n).alias("s"), text.alias("t")).alias("x"))
    graded = each.groupBy("key").agg(F.array_sort(F.collect_list("x")).alias("x"))
    from verisift.operators.rewards import mean

    lists = graded.select("key", F.transform("x", lambda v: v["s"]).alias("individual_scores"), F.transform("x", lambda v: v["t"]).alias("grader_outputs"))
    scored = lists.withColumn("scores", F.transform("individual_scores", lambda s: mean(F.transform(s, lambda v: v.cast("double")))))
    return df.join(scored, "key", "left"), fresh


def rollouts(df: DataFrame, client: Client, n: int = 16, **options) -> tuple[DataFrame, DataFrame]:
    """key, instruction, responses: n replies to each instruction."""
    settings = {"n": n} | options.pop("settings", {})
    asked, fresh = call(df.withColumn("_m", reshape.build_messages(F.col("instruction"))), "_m", client, settings=settings, **options)
    return asked.select("key", "instruction", F.col("replies").alias("responses")), fresh


def analyze_quality(m1: DataFrame, m2: DataFrame | None, template: str, client: Client, system: str | None = None, merged: bool = False, order: str = "_row_idx", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(idx, m1_analysis, m2_analysis; failures: reason, count; rows to add to the cache).

    Both sides have an index, instruction and responses; the first response of each is judged by
    itself. A side that fails has no issues and empty notes; rows where no side succeeds are left out.
    """
    sides = [("m1", m1)] + ([("m2", m2)] if m2 is not None else [])
    parts = []
    for name, df in sides:
        response = F.coalesce(F.get("responses", F.lit(0)), F.lit(""))
        parts.append(df.select(F.col(order).alias("idx"), F.lit(name).alias("side"), F.coalesce("instruction", F.lit("")).alias("instruction"), response.alias("response")))
    if m2 is not None:
        # the first model's instruction is the one that both are judged by
        parts[1] = parts[1].drop("instruction").join(parts[0].select("idx", "instruction"), "idx").select(*parts[0].columns)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    reason = F.when(F.col("instruction") == "", "empty_instruction").when(F.col("response") == "", "empty_response")
    prompt = reshape.fill_template(template, {"instruction": F.col("instruction"), "response": F.col("response")})
    rows = rows.withColumn("reason", reason).withColumn("_m", reshape.build_messages(prompt, F.lit(system) if system is not None else None, merged))
    asked, fresh = call(rows.where(F.col("reason").isNull()), "_m", client, **options)
    judged = asked.withColumn("reply", T.strip(F.coalesce(F.get("replies", F.lit(0)), F.lit("")))).withColumn("a", replies.quality_analysis("reply"))
    judged = judged.withColumn("reason", F.when(F.col("reply") == "", "empty_reply").when(F.col("a.notes").isNull(), "json_parse_fail")).select("idx", "side", "reason", "a")
    every = judged.unionByName(rows.where(F.col("reason").isNotNull()).select("idx", "side", "reason", F.lit(None).cast(replies.ANALYSIS).alias("a")))
    empty = F.struct(*[F.lit(0).alias(d) for d in replies.DIMENSIONS], F.lit("").alias("notes"))
    picked = {f"{s}_analysis": F.coalesce(F.any_value(F.when((F.col("side") == s) & F.col("reason").isNull(), F.col("a")), F.lit(True)), empty) for s, _ in sides}
    done = every.groupBy("idx").agg(*[c.alias(n) for n, c in picked.items()], F.count_if(F.col("reason").isNull()).alias("_ok"))
    return done.where(F.col("_ok") > 0).drop("_ok"), every.where(F.col("reason").isNotNull()).groupBy("reason").count(), fresh
