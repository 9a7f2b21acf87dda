"""Sampling of constraints that do not conflict, and building of constrained records."""

from __future__ import annotations

import json
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from verisift.operators import constraints as C

#: Constraints that must not meet (each also conflicts with itself, and conflicts hold both ways).
CONFLICTS = {
    "language:response_language": ["detectable_format:multiple_sections", "keywords:existence", "keywords:frequency", "keywords:forbidden_words", "startend:end_checker", "change_case:english_capital", "change_case:english_lowercase"],
    "length_constraints:number_paragraphs": ["length_constraints:nth_paragraph_first_word", "length_constraints:number_sentences"],
    "length_constraints:nth_paragraph_first_word": ["length_constraints:number_paragraphs"],
    "detectable_format:multiple_sections": ["language:response_language", "detectable_format:number_highlighted_sections"],
    "change_case:capital_word_frequency": ["change_case:english_lowercase", "change_case:english_capital"],
    "change_case:english_lowercase": ["change_case:english_capital"],
    "startend:quotation": ["detectable_format:title"],
    "paragraphs:paragraphs": ["paragraphs:paragraphs2"],
    "first_word:first_word_sent": ["first_word:first_word_answer"],
    "count:counting_composition": ["count:count_unique", "count:count_increment_word", "paragraphs:paragraphs", "paragraphs:paragraphs2", "keywords:letter_frequency", "keywords:frequency"],
}
#: Constraints that conflict with everything, and with everything but a few.
ALL_CONFLICT = ["detectable_format:constrained_response", "copy:copy", "new:copy_span_idx", "copy:copying_simple", "copy:copying_multiple"]
ALL_BUT = {
    "detectable_format:json_format": ["keywords:forbidden_words", "keywords:existence"],
    "combination:two_responses": ["keywords:forbidden_words", "keywords:existence", "language:response_language", "detectable_format:title", "punctuation:no_comma"],
    "combination:repeat_prompt": ["keywords:existence", "detectable_format:title", "punctuation:no_comma"],
}
#: The languages that may be asked for.
LANGUAGES = ["en", "es", "pt", "ar", "hi", "fr", "ru", "de", "ja", "it", "bn", "uk", "th", "ur", "ta", "te", "bg", "ko", "pl", "he", "fa", "vi", "ne", "sw", "kn", "mr", "gu", "pa", "ml", "fi"]
LANGUAGE_NAMES = ["English", "Spanish", "Portuguese", "Arabic", "Hindi", "French", "Russian", "German", "Japanese", "Italian", "Bengali", "Ukrainian", "Thai", "Urdu", "Tamil", "Telugu", "Bulgarian", "Korean", "Polish", "Hebrew", "Persian", "Vietnamese", "Nepali", "Swahili", "Kannada", "Marathi", "Gujarati", "Punjabi", "Malayalam", "Finnish"]
#: Our own keyword list.
KEYWORDS = "anchor basket bridge candle castle circle cloud copper corner cotton desert dinner dream engine evening fabric feather forest garden glass harbor history honey island journey kitchen ladder lantern market meadow mirror moment mountain music notebook ocean orange painter paper pattern pencil picture planet pocket promise puzzle rabbit ribbon river season shadow signal silver spring station stone story summer sunset table tower travel valley village violin water weather window winter wonder".split()


def conflict_graph() -> dict[str, set[str]]:
    """Symmetric closure of the conflicts over the registered constraints, self-conflicts included."""
    ids = set(C.REGISTERED)
    out = {i: {i} for i in ids}
    pairs = [(a, b) for a, bs in CONFLICTS.items() for b in bs]
    pairs += [(a, b) for a in ALL_CONFLICT for b in ids]
    pairs += [(a, b) for a, free in ALL_BUT.items() for b in ids - set(free)]
    for a, b in pairs:
        out[a].add(b)
        out[b].add(a)
    return out


def conflict_table(spark: SparkSession) -> DataFrame:
    """a, b: the conflict graph as edges."""
    return spark.createDataFrame(sorted((a, b) for a, bs in conflict_graph().items() for b in bs), "a string, b string")


def sample_params(id_: str, rng: random.Random, instruction: str) -> dict | None:
    """Random parameters of a constraint; raises ValueError where the instruction has nothing to draw from."""
    words = instruction.split()
    relation = rng.choice(C.RELATIONS)
    own = {
        "keywords": lambda: rng.sample(KEYWORDS, 2),
        "forbidden_words": lambda: sorted(rng.sample(KEYWORDS, 2)),
        "keyword": lambda: rng.choice(words) if id_ == "keywords:exclude_word_harder" and words else rng.choice(KEYWORDS),
        "keyword1": lambda: rng.choice(KEYWORDS), "keyword2": lambda: rng.choice(KEYWORDS),
        "first_word": lambda: rng.choice(KEYWORDS), "last_word": lambda: rng.choice(KEYWORDS),
        "frequency": lambda: rng.randint(1, 3), "relation": lambda: relation, "let_relation": lambda: relation, "capital_relation": lambda: relation,
        "letter": lambda: rng.choice("abcdefghijklmnopqrstuvwxyz"), "let_frequency": lambda: rng.randint(1, 10),
        "capital_frequency": lambda: rng.randint(1, 20), "language": lambda: rng.choice(LANGUAGES),
        "num_sentences": lambda: rng.randint(1, 20), "num_paragraphs": lambda: rng.randint(1, 5), "num_words": lambda: rng.randint(100, 500),
        "num_placeholders": lambda: rng.randint(1, 4), "num_bullets": lambda: rng.randint(1, 5), "num_highlights": lambda: rng.randint(1, 4),
        "num_sections": lambda: rng.randint(1, 5), "section_spliter": lambda: rng.choice(C.SECTIONS), "postscript_marker": lambda: rng.choice(C.POSTSCRIPTS),
        "end_phrase": lambda: rng.choice(C.ENDINGS), "phrase": lambda: rng.choice(C.PHRASES), "small_n": lambda: rng.randint(2, 3),
        "prompt_to_repeat": lambda: instruction, "n_sent": lambda: rng.randint(2, 3), "n_words": lambda: rng.randint(2, 3),
        "n": lambda: rng.randint(1, 20), "m": lambda: rng.randint(1, 30),
    }
    out: dict = {}
    for p in C.REGISTRY[id_].params:
        if p == "N":
            out[p] = rng.randint(200, 700) if id_ == "letters:letter_counting" else rng.randint(2, 3)
        elif p == "nth_paragraph":
            out[p] = rng.randint(1, out["num_paragraphs"])
        elif p == "n_start":
            if not instruction:
                raise ValueError("no prompt to copy from")
            out[p] = rng.randint(0, len(instruction) - 1)
        elif p == "n_end":
            out[p] = rng.randint(out["n_start"] + 1, len(instruction))
        else:
            out[p] = own[p]()
    return out or None


def describe(id_: str, params: dict | None) -> str:
    shown = dict(params or {})
    if "language" in shown:
        shown["language"] = LANGUAGE_NAMES[LANGUAGES.index(shown["language"])]
    return C.describe(id_, **shown)


def sample_constraints(n: int, instruction: str, rng: random.Random, graph: dict[str, set[str]] | None = None) -> list[tuple[str, dict | None, str]]:
    """Up to n constraints of which no two conflict; a draw that fails is used up."""
    graph = graph or conflict_graph()
    chosen, drawn = [], []
    pool = list(C.REGISTERED)
    rng.shuffle(pool)
    for _ in range(n):
        if not pool:
            pool = [c for c in C.REGISTERED if not any(c in graph[d] for d in drawn)]
            rng.shuffle(pool)
        if not pool:
            break
        id_ = pool.pop()
        drawn.append(id_)
        try:
            params = sample_params(id_, rng, instruction)
        except ValueError:
            continue
        chosen.append((id_, params, describe(id_, params)))
        pool = [c for c in pool if c not in graph[id_]]
    return chosen


RECORD = "key string, messages array<struct<role:string,content:string>>, ground_truth string, dataset string, constraint_type string, constraint string"


def constrained_records(df: DataFrame, key: str, instruction: str, dataset: str, low: int = 1, high: int = 3, seed: int = 42) -> DataFrame:
    """Records with sampled constraints appended to each instruction.

    Every row has its own generator, seeded with the seed and its key, so results do
    not depend on partitions. Rows without an instruction are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = conflict_graph()
        for batch in batches:
            rows = []
            for k, text in zip(batch["k"], batch["i"], strict=True):
                rng = random.Random(f"{seed}:{k}")
                got = sample_constraints(rng.randint(low, high), text, rng, graph)
                if got:
                    suffix = " ".join(d for _, _, d in got)
                    truth = json.dumps([{"instruction_id": [i], "kwargs": [p]} for i, p, _ in got], ensure_ascii=False)
                    rows.append((k, [{"role": "user", "content": f"{text} {suffix}"}], truth, dataset, "single" if len(got) == 1 else "multi", suffix))
            yield pd.DataFrame(rows, columns=["key", "messages", "ground_truth", "dataset", "constraint_type", "constraint"])

    from pyspark.sql import functions as F

    rows = df.where(F.col(instruction) != "").select(F.col(key).cast("string").alias("k"), F.col(instruction).alias("i"))
    return rows.mapInPandas(run, RECORD)
