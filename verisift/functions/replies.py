"""Parsers of model replies."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from verisift.functions import text as T

#: The dimensions of a quality analysis.
DIMENSIONS = ["incoherent_expression", "logical_inconsistency", "inappropriate_word_choice", "repetitive_expression", "language_inconsistency"]
ANALYSIS = StructType([*(StructField(d, IntegerType()) for d in DIMENSIONS), StructField("notes", StringType())])


def eval_scores(reply: Column, n: Column) -> Column:
    """Item scores of a checklist reply: the 0 or 1 at the end of each line, padded with 0 and cut to n."""
    lines = F.filter(F.transform(F.split(T.strip(reply), "\n", -1), T.strip), lambda s: s != "")

    def score(s: Column) -> Column:
        tail = T.strip(F.substring_index(s, "\t", -1))
        after_tab = F.when(s.contains("\t") & tail.rlike(r"\A[+-]?0*[01]\z") & ~tail.rlike(r"\A-0*1\z"), tail.cast("int"))
        at_end = F.regexp_extract(s, r"([01])\z", 1)
        return F.coalesce(after_tab, F.when(at_end != "", at_end.cast("int")))

    found = F.filter(F.transform(lines, score), lambda v: v.isNotNull())
    return F.slice(F.concat(found, F.array_repeat(F.lit(0), n)), F.lit(1), n)


def checklist_items(checklist: Column) -> Column:
    """Non-blank lines, stripped; every line break of Python's splitlines counts."""
    return F.filter(F.transform(F.split(checklist, r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"), T.strip), lambda s: s != "")


def contradiction_label(reply: Column) -> Column:
    """'Contradictory', 'Not Contradictory', or null."""
    named = F.lower(F.regexp_extract(reply, r"(?i)label[ \t]*:[ \t]*(not contradictory|contradictory)", 1))
    low = F.lower(reply)
    return (
        F.when(named.startswith("contradictory"), "Contradictory").when(named != "", "Not Contradictory").when(low.contains("not contradictory"), "Not Contradictory").when(low.contains("contradictory"), "Contradictory")
    )


def justification(reply: Column) -> Column:
    """What follows the first 'justification:' on its line, else the whole reply."""
    own = T.strip(F.regexp_extract(reply, r"(?i)justification[ \t]*:[ \t]*([^\n]*)", 1))
    return F.when(own != "", own).otherwise(T.strip(reply))


def _json_object(text: str) -> dict | None:
    try:
        value = json.loads(text.strip())
        if isinstance(value, str):
            value = json.loads(value)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def find_json_object(reply: str) -> dict | None:
    """The JSON object of a reply: in result tags, as the whole, in a code fence, or as the first JSON value in it."""
    for pattern in (r"(?is)<result>\s*(.*?)\s*</result>", r"(?s)\A(.*)\Z", r"(?s)```(?:json)?\s*\n?(.*?)\n?\s*```"):
        found = re.search(pattern, reply)
        if found and (value := _json_object(found[1])) is not None:
            return value
    decoder = json.JSONDecoder()
    for m in re.finditer(r"[{\[]", reply):
        try:
            value, _ = decoder.raw_decode(reply, m.start())
        except ValueError:
            continue
        return value if isinstance(value, dict) else None
    return None


def quality_flags(value: dict | None) -> dict | None:
    """Dimensions as 0 or 1 (anything else as 0) and notes as text."""
    if value is None:
        return None
    flag = lambda v: int(v) if isinstance(v, (int, float, str)) and v in (0, 1, "0", "1") else 0
    return {d: flag(value.get(d)) for d in DIMENSIONS} | {"notes": str(value.get("notes", ""))}


@F.pandas_udf(ANALYSIS)
def quality_analysis(reply: pd.Series) -> pd.DataFrame:
    """The quality analysis in a reply; null fields where there is none."""
    rows = [quality_flags(find_json_object(r)) if r is not None else None for r in reply]
    return pd.DataFrame([r or dict.fromkeys([*DIMENSIONS, "notes"]) for r in rows], columns=[*DIMENSIONS, "notes"]).astype({d: "Int32" for d in DIMENSIONS})
