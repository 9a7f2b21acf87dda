"""Secret scan: fixed patterns, then Markov models of random strings and ordinary identifiers.

The fixed patterns find assignments, access keys and hex strings. Other long
strings are scored by two first-order character models, one of random strings
and one of ordinary identifiers: the sum of log-likelihood ratios over a string's
character pairs must reach ``min_ratio``. Only strings with a letter and at least
MIN_DISTINCT distinct characters are scored: rules, fillers and plain numbers are no
secrets, however unlike words they are. The models are trained from labelled samples:
random strings are made by rule from digests, identifiers are all words (and joined
words) of about TRAIN_DOCS distinct texts. The counts are aggregated in Spark; only
the table of character pairs (fixed size) reaches the driver.

All work is done by native expressions. Patterns use possessive runs of single
characters, so that very long texts neither backtrack nor recurse.

Defined results: a null or empty text holds nothing; every input row gives one
output row, repeated rows included; further columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm import spans

KINDS = ["assign", "access", "hex", "markov"]
#: The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
#: Strings that the models score: long, and not part of a word.
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![\p{L}\p{N}])"
#: The alphabet of candidates; a pair's index is 65 * first + second.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Documents sampled for ordinary identifiers, and random strings made, at most about.
TRAIN_DOCS, TRAIN_RANDOM = 500, 4000
#: Fewer distinct characters than this are a rule or a filler, not a secret.
MIN_DISTINCT = 8
#: A string is a secret from this log-likelihood ratio on; e^14 is about a million to one.
MIN_RATIO = 14.0


def _pairs(strings: DataFrame) -> DataFrame:
    """pair, n of the character pairs of column s."""
    s = F.regexp_replace("s", "[^A-Za-z0-9+/_=-]", "")
    rows = strings.select(s.alias("s")).where(F.length("s") >= 4)
    pairs = spans.let(F.split("s", r"(?!^)(?!\z)"), lambda c: F.transform(F.slice(c, 1, F.size(c) - 1), lambda x, i: F.concat(x, F.get(c, i + 1))))
    return rows.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def sample_identifiers(df: DataFrame, text_col: str, n_docs: int = TRAIN_DOCS) -> DataFrame:
    """Column s: all words of about n_docs distinct texts, alone and joined as code joins them."""
    share = min(1.0, n_docs / max(1, df.count()))
    chosen = df.where((F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))) & F.col(text_col).isNotNull())
    words = F.filter(F.split("t", r"[^\p{L}]+"), lambda w: F.length(w) >= 2)
    # copies share their hash: each distinct text counts once, whether it has one copy or a third of all rows
    rows = chosen.groupBy(F.xxhash64(text_col).alias("h")).agg(F.first(text_col).alias("t")).select(words.alias("w")).where(F.size("w") > 1)
    signs = F.array(F.lit("_"), F.lit("-"), F.lit("/"), F.lit(""), F.lit(""))
    after = lambda i: F.coalesce(F.get("w", i + 1), F.lit(""))
    joined = F.transform("w", lambda w, i: F.concat(w, F.get(signs, i % 5), F.when(i % 5 == 3, F.initcap(after(i))).otherwise(after(i))))
    shouted = F.transform("w", lambda w: F.concat(F.upper(w), F.lit("_"), F.upper(w)))
    numbered = F.transform("w", lambda w, i: F.concat(w, (i % 12).cast("string")))
    # capitals and numbers are the rarer forms: every tenth word gives them
    rare = F.filter(F.concat(shouted, numbered), lambda s, i: i % 10 == 0)
    return rows.select(F.explode(F.concat(joined, rare)).alias("s"))


def sample_random(df: DataFrame, n: int = TRAIN_RANDOM) -> DataFrame:
    """Column s: strings without structure, as hex digits, as base64 and as letters and digits."""
    i = F.col("id").cast("string")
    b64 = F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), i), 256)))
    kinds = F.array(F.sha2(F.concat(F.lit("h"), i), 256), F.rtrim(F.translate(b64, "=", " ")), F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit("l"), i), 256))), "[^A-Za-z0-9]", ""))
    return df.sparkSession.range(n).select(F.explode(kinds).alias("s"))


def train(ordinary: DataFrame, random: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) by pair index, add-half smoothed."""
    size = len(ALPHABET)
    place = {c: k for k, c in enumerate(ALPHABET)}
    tables = []
    for strings in (random, ordinary):
        count = [0.5] * (size * size)
        for pair, n in _pairs(strings).collect():  # at most size * size rows
            count[size * place[pair[0]] + place[pair[1]]] += n
        row = [sum(count[size * a : size * a + size]) for a in range(size)]
        tables.append([math.log(count[k] / row[k // size]) for k in range(size * size)])
    return [a - b for a, b in zip(*tables, strict=True)]


def ratio(string: Column, model: list[float]) -> Column:
    """The sum of log-likelihood ratios over a string's character pairs."""
    table = F.lit(model)
    size = len(ALPHABET)
    codes = F.transform(F.split(string, r"(?!^)(?!\z)"), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    step = lambda a, c: F.struct((a["r"] + F.when(a["last"] >= 0, F.get(table, a["last"] * size + c)).otherwise(0.0)).alias("r"), c.alias("last"))
    start = F.struct(F.lit(0.0).alias("r"), F.lit(-1).alias("last"))
    return F.aggregate(codes, start, step)["r"]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO, model: list[float] | None = None) -> DataFrame:
    """id, text, base and spans: arrays of (start, rank, end), rank an index of KINDS; base ones come first in spans."""
    if model is None:
        model = train(sample_identifiers(df, text_col), sample_random(df))
    out = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    for name, pattern in (("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX), ("_other", CANDIDATE)):
        out = spans.with_matches(out, name, "_text", pattern)
    long_enough = F.filter("_assign", lambda m: F.length(F.regexp_extract(m["found"], ASSIGN_VALUE, 1)) >= 6)
    out = out.withColumn("base", F.concat(spans.tagged(long_enough, 0), spans.tagged(F.col("_access"), 1), spans.tagged(F.col("_hex"), 2)))

    def random_like(m: Column) -> Column:
        s = m["found"]
        varied = F.size(F.array_distinct(F.split(s, r"(?!^)(?!\z)"))) >= MIN_DISTINCT
        return varied & s.rlike("[A-Za-z]") & (ratio(s, model) >= min_ratio)

    out = out.withColumn("_clear", spans.clear_of(F.col("_other"), F.col("base")))
    out = out.withColumn("spans", F.concat("base", spans.tagged(F.filter("_clear", random_like), 3)))
    return out.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), "base", "spans")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, digest of base spans, and all spans as a string."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])],
        F.sha2(spans.spelled(F.col("base"), KINDS, by_kind=False), 256).alias("base_sha256"),
        spans.spelled(F.col("spans"), KINDS, by_kind=False).alias("spans"),
    )
