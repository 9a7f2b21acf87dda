"""Text helpers as native columns, with Python's notion of white space and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verisift.functions import tokens as K

#: Character classes of Java patterns that equal Python's \s and \w.
SPACE = r"[\s\x{1c}-\x{1f}]"
WORD = r"[\p{L}\p{N}_]"


def strip(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, rf"(?U)\A{SPACE}+", ""), rf"(?U)(?<!{SPACE}){SPACE}+\z", "")


def rstrip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)(?<!{SPACE}){SPACE}+\z", "")


def words(x: Column) -> Column:
    """Tokens between white space."""
    return F.filter(F.split(x, rf"(?U){SPACE}+"), lambda w: w != "")


def count(x: Column, pattern: str | Column) -> Column:
    return F.regexp_count(x, F.lit(pattern) if isinstance(pattern, str) else pattern)


def word_count(x: Column) -> Column:
    return count(x, rf"{WORD}+")


def blank(x: Column) -> Column:
    return ~x.rlike(rf"(?U)[^\s\x{{1c}}-\x{{1f}}]")


def truthy(x: Column, kind: str) -> Column:
    """Whether a value counts as true: not null, and not empty or zero."""
    if kind == "string":
        ok = x != ""
    elif kind.startswith(("array", "map")):
        ok = F.size(x) > 0
    elif kind == "boolean":
        ok = x
    else:
        ok = x != 0
    return F.coalesce(ok, F.lit(False))


def normalize(x: Column, lower: bool = True) -> Column:
    """Null as empty; stripped, white space runs as one space, lower case."""
    out = F.array_join(words(F.coalesce(x.cast("string"), F.lit(""))), " ")
    return F.lower(out) if lower else out


def _one_of(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


def _border(quote: str) -> str:
    """What holds right after a lone full stop, and a quotation mark if that is given, that ends a sentence."""
    stop, letter = rf"\.{quote}", "[A-Za-z]"
    anew = rf"(?= (?:{_one_of(K.TITLES_AND_MORE)}|{_one_of(K.OPENERS)}\s))"
    no_name = rf"(?<!{_one_of(K.TITLES)}{stop})(?<!{_one_of(K.SUFFIXES)}{stop})(?<!Ph\.D{stop})(?<! {letter}{stop})"
    # a letter before: it must be the last of letters with stops, and one that is left over by threes and twos
    alone = rf"(?:(?<!{letter}{stop})|(?<=(?<!{letter}\.)(?:{letter}\.{letter}\.{letter}\.){{0,30}}{letter}{stop}))"
    if quote:
        return rf"(?<=[^.]{stop}){no_name}{alone}"
    whole = rf"(?!{_one_of(K.DOMAINS)})(?!(?<=Ph\.)D\.)(?!(?<=\s{letter}\.) )(?!(?<={letter}\.){letter}\.)"
    # between digits: every second one of single digits with stops
    number = r"(?:(?<![0-9]\.)|(?![0-9])|(?<=(?<![0-9]\.)[0-9](?:\.[0-9]\.[0-9]){0,40}\.[0-9]\.))"
    return rf"(?:(?<=[A-Z]\.[A-Z]\.){anew}|(?<=[^.]\.)(?![.\"”]){no_name}{whole}{alone}{number})"


#: Between two sentences; the full stop of a suffix before a new sentence is left out.
SENTENCE_BORDER = (
    r"(?U)(?:(?<=[.!?\"”])(?:(?<=\.\.)(?!\.)|(?<=[!?])(?!\")|(?<=[!?]\")|" + _border("") + "|" + _border('[\"”]') + ")"
    rf"|(?<={_one_of(K.SUFFIXES)})\.(?= (?:{_one_of(K.TITLES_AND_MORE)}|{_one_of(K.OPENERS)}\s)))"
)


def sentences(x: Column) -> Column:
    """Sentences by rule, stripped; one empty last sentence is left out. A quotation mark after an end mark goes before it."""
    parts = F.split(F.concat(F.lit(" "), F.replace(x, F.lit("\n"), F.lit(" ")), F.lit("  ")), SENTENCE_BORDER, -1)
    each = F.transform(parts, lambda s: strip(F.regexp_replace(s, r'(?<!\.\.)(?:([.!?])(")|(\.)(”))\z', "$2$4$1$3")))
    return F.get(F.transform(F.array(each), lambda a: F.when(F.element_at(a, -1) == "", F.slice(a, 1, F.size(a) - 1)).otherwise(a)), 0)


def relation(n: Column, kind: Column, threshold: Column) -> Column:
    """n against a threshold; null where the relation is neither of the two known ones."""
    return F.when(kind == "less than", n < threshold).when(kind == "at least", n >= threshold)


def core_key(key: Column) -> Column:
    """The first UUID in a key, else what follows its last underscore."""
    uuid = F.regexp_extract(key, r"(?i)[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}", 0)
    return F.when(uuid != "", uuid).otherwise(F.substring_index(key, "_", -1))


def example_key(df, dataset: str, index: str) -> Column:
    """The first true value of id, uuid, key, idx, index as a string, else dataset_index."""
    kinds = dict(df.dtypes)
    own = [F.when(truthy(F.col(c), kinds[c]), F.col(c).cast("string")) for c in ("id", "uuid", "key", "idx", "index") if c in kinds]
    return F.coalesce(*own, F.concat(F.lit(dataset), F.lit("_"), F.col(index).cast("string")))


def strip_thinking(x: Column) -> Column:
    """What follows the last </think>, stripped; texts without it stay."""
    return F.when(x.contains("</think>"), strip(F.substring_index(x, "</think>", -1))).otherwise(x)


def user_message(x: Column) -> Column:
    """The message of a flat prompt: without a leading 'user' line and a trailing 'assistant' line."""
    return strip(F.regexp_replace(F.regexp_replace(strip(x), r"\Auser\n", ""), r"\nassistant\n?\z", ""))


def strip_suffix(prompt: Column, constraint: Column) -> Column:
    """prompt without a constraint at its end."""
    p, c = rstrip(prompt), strip(constraint)
    cut = F.substring(p, F.lit(1), F.length(p) - F.length(c))
    return F.when((c != "") & p.endswith(c), rstrip(cut)).otherwise(p)
