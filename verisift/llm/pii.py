"""Personal data: fixed patterns, then bootstrapped contextual extraction.

Base entities (e-mail, IP, card and phone numbers) are the seeds. The word that stands
before an entity, and the two words before it, are lexical patterns; words are runs of
letters, digits and underscores, and any white space or punctuation may lie between.
A bipartite graph joins patterns to instances: the seeds, and all other tokens of six
characters or more with a digit or @. Its counts are aggregated over the whole corpus.

Scores are iterated over this graph. A pattern takes part in a round once enough
distinct instances that follow it are seeds or score at least one half; its confidence
is the scored share of everything that follows it anywhere. An instance's score is the
noisy-or of the confidences of its accepted patterns (1 for a seed). So instances that
one pattern has found can induce further patterns in the next round. Patterns with
enough confidence at last mark the unseen instances that follow them.

All work is done by native expressions and joins; patterns and instances are
pre-aggregated before each shuffle, so a frequent word sends one row from each
task, and hot patterns and instances stay in place (``graphs.hot_join``). Single
characters stand in for separators inside entities while searching, so that patterns
are runs of one character class and neither backtrack nor recurse on very long texts.

Defined results: a null or empty text holds nothing; every input row gives one
output row, repeated rows included; a token without any word before it in its text has
no pattern; the two words are looked for back to the end of the match before the
previous one; overlapping spans are all reported, and in ``redact`` the first one names
the whole; further columns are left out by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm import graphs, scratch, spans

KINDS = ["email", "ip", "card", "phone", "context"]
#: Stand-ins for a separator that is inside an entity; texts that hold them get another character first.
DOT, GAP, AWAY = "\ue000", "\ue001", "\ue002"
#: The base patterns, over texts with stand-ins.
EMAIL = rf"(?:\G|(?<![A-Za-z0-9._%+{DOT}-]))[A-Za-z0-9._%+{DOT}-]++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"[0-9][0-9{GAP}]++"
CARD_HINT = r"[0-9](?:[ -]?[0-9]){12}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What patterns may discover: whole tokens with a digit or @; SHORTEST characters at least, without punctuation at the end.
INSTANCE = r"(?<![\p{L}\p{N}@._+#/-])(?=[\p{L}._+#/-]*+[0-9@])[\p{L}\p{N}@._+#/-]{6,}+"
SHORTEST = 6
#: A word, and the last one or two words of a text.
BETWEEN = r"[^\p{L}\p{N}_]+"
LAST_WORDS = r"(?<![\p{L}\p{N}_])(?:[\p{L}\p{N}_]++[^\p{L}\p{N}_]++)?[\p{L}\p{N}_]++[^\p{L}\p{N}_]*+\z"
#: A pattern needs so many distinct instances that count and this confidence; an instance counts from this score; rounds at most.
MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE, ROUNDS = 3, 0.5, 0.5, 5
#: Patterns that are broadcast while words are counted; more are joined by shuffle.
BROADCAST_PATTERNS = 50_000


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(number), r"(?!^)(?!\z)"), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN), lambda w: w != "")


def context(lead: Column) -> Column:
    """The last one or two words of what stands before a place, in lower case."""
    return words_of(F.regexp_extract(lead, LAST_WORDS, 0))


def patterns_of(words: Column) -> Column:
    """The patterns that the last words before a place make: the last one, and the last two."""
    n = F.size(words)
    return F.when(n == 0, F.array().cast("array<string>")).when(n == 1, words).otherwise(F.array(F.get(words, n - 1), F.concat_ws(" ", F.get(words, n - 2), F.get(words, n - 1))))


def base_entities(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _text, base: array of (start, rank, end), and seeds: array of (instance, patterns)."""
    out = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    safe = F.translate("_text", DOT + GAP, AWAY + AWAY)
    out = out.withColumn("_dotted", F.when(F.col("_text").contains("@"), F.regexp_replace(safe, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)))
    out = out.withColumn("_gapped", F.when(F.col("_text").rlike(CARD_HINT), F.regexp_replace(safe, "(?<=[0-9])[ -](?=[0-9])", GAP)))
    for name, text, pattern in (("_email", "_dotted", EMAIL), ("_ip", "_text", IP), ("_card", "_gapped", CARD), ("_phone", "_text", PHONE)):
        out = spans.with_matches(out, name, text, pattern, F.col(text).isNotNull(), context)
    out = out.withColumns(
        {
            "_ip": F.filter("_ip", lambda m: F.forall(F.split(m["found"], r"\."), lambda p: p.cast("double") <= 255)),
            "_card": F.filter("_card", lambda m: F.length(digits(m["found"])).between(13, 19) & luhn(digits(m["found"]))),
            "_phone": F.filter("_phone", lambda m: F.length(digits(m["found"])).between(9, 15)),
        }
    )
    kinds = ["_email", "_ip", "_card", "_phone"]
    seed = lambda m: F.struct(F.xxhash64(m["found"]).alias("instance"), patterns_of(m["lead"]).alias("patterns"))
    base = F.concat(*[spans.tagged(F.col(k), rank) for rank, k in enumerate(kinds)])
    seeds = F.concat(*[F.transform(k, seed) for k in kinds])
    return out.select("_id", "_text", base.alias("base"), seeds.alias("seeds"))


def candidates(df: DataFrame) -> DataFrame:
    """df (with _text and base) with fresh: array of (start, end, instance, patterns) of the tokens that are clear of base entities."""
    out = spans.with_matches(df, "_other", "_text", INSTANCE, F.col("_text").rlike("[0-9@]"), context)
    bare = lambda m: F.regexp_replace(m["found"], r"(?<![@._+#/-])[@._+#/-]++\z", "")
    trimmed = F.transform("_other", lambda m: spans.let(bare(m), lambda x: F.struct(m["start"].alias("start"), (m["start"] + F.length(x)).alias("end"), x.alias("found"), m["lead"].alias("lead"))))
    out = out.withColumn("_other", F.filter(trimmed, lambda m: (F.length(m["found"]) >= SHORTEST) & m["found"].rlike("[0-9@]")))
    out = out.withColumn("_other", spans.clear_of(F.col("_other"), F.col("base")))
    fresh = F.transform("_other", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.xxhash64(m["found"]).alias("instance"), patterns_of(m["lead"]).alias("patterns")))
    return out.withColumn("fresh", fresh).drop("_other")


def occurrences(found: DataFrame) -> DataFrame:
    """pattern, instance, n, seed: how often each pattern stands before each instance, and whether that was a seed."""
    seeds = F.transform("seeds", lambda s: F.struct(s["instance"], s["patterns"], F.lit(True).alias("seed")))
    others = F.transform("fresh", lambda m: F.struct(m["instance"], m["patterns"], F.lit(False).alias("seed")))
    rows = found.where((F.size("seeds") > 0) | (F.size("fresh") > 0)).select(F.explode(F.concat(seeds, others)).alias("x"))
    rows = rows.select("x.instance", "x.seed", F.explode("x.patterns").alias("pattern"))
    return rows.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))


def pattern_totals(found: DataFrame, patterns: DataFrame, most: int = BROADCAST_PATTERNS) -> DataFrame:
    """pattern, total: how often each of the patterns stands in all texts. At most ``most`` patterns are broadcast; the result is the same beyond."""
    pairs = lambda ws: F.transform(ws, lambda w, i: F.struct(F.get(ws, i - 1).alias("before"), w.alias("word")))
    rows = found.select(F.explode(spans.let(words_of(F.col("_text")), pairs)).alias("x")).select("x.*")
    last = patterns.select(F.substring_index("pattern", " ", -1).alias("word")).distinct()
    n, few = F.lit(1), patterns.count() <= most
    if few:
        rows = rows.join(F.broadcast(last), "word", "left_semi")
    else:
        rows, n = rows.groupBy("before", "word").agg(F.count(F.lit(1)).alias("n")), F.col("n")
    both = F.array(F.struct(F.col("word").alias("pattern"), n.alias("n")), F.struct(F.concat(F.col("before"), F.lit(" "), F.col("word")).alias("pattern"), n.alias("n")))
    each = rows.select(F.explode(both).alias("x")).select("x.*").where(F.col("pattern").isNotNull())
    if few:
        return each.join(F.broadcast(patterns.select("pattern")), "pattern", "left_semi").groupBy("pattern").agg(F.sum("n").alias("total"))
    return each.groupBy("pattern").agg(F.sum("n").alias("total")).join(patterns.select("pattern").hint("merge"), "pattern", "left_semi")


def learn(found: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """pattern, confidence of the accepted patterns. Rounds end early once the accepted patterns stay the same."""
    edges = scratch.stored(occurrences(found), "pii_edges")
    wanted = scratch.stored(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_seeds), "pii_patterns")
    totals = scratch.stored(pattern_totals(found, wanted), "pii_totals")
    graph = scratch.stored(graphs.hot_join(edges, totals, ["pattern"], wanted).where(F.col("total").isNotNull()), "pii_graph")
    size = graph.count()
    by_pattern = graphs.hot_keys(graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("_n")), ["pattern"], size)
    by_instance = graphs.hot_keys(graph.groupBy("instance").agg(F.count(F.lit(1)).alias("_n")), ["instance"], size)
    score, accepted, mark = F.when(F.col("seed"), 1.0).otherwise(0.0), None, None
    scored = graph
    for _ in range(rounds):
        rated = scored.withColumn("score", score).groupBy("pattern").agg((F.sum(F.col("n") * F.col("score")) / (F.max("total") + 1)).alias("confidence"), F.count_if(F.col("score") >= MIN_SCORE).alias("support"))
        good = (F.col("support") >= min_seeds) & (F.col("confidence") >= min_confidence)
        accepted = scratch.stored(rated.where(good).select("pattern", "confidence"), "pii_accepted")
        seen = tuple(accepted.agg(F.count(F.lit(1)), F.sum(F.xxhash64("pattern").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
        miss = F.sum(F.log(F.greatest(1 - F.least("confidence", F.lit(1.0)), F.lit(1e-9))))
        led = graphs.hot_join(graph.where(~F.col("seed")), accepted, ["pattern"], hot=by_pattern).where(F.col("confidence").isNotNull())
        scores = scratch.stored(led.groupBy("instance").agg((1 - F.exp(miss)).alias("s")), "pii_scores")
        scored = graphs.hot_join(graph, scores, ["instance"], hot=by_instance)
        score = F.when(F.col("seed"), 1.0).otherwise(F.coalesce("s", F.lit(0.0)))
    return accepted


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """id, text, base and spans: arrays of (start, rank, end), rank an index of KINDS; base ones come first in spans."""
    found = _scan(df, F.col(id_col), text_col, min_seeds, min_confidence, rounds)
    return found.select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), "base", "spans")


def redact(df: DataFrame, text_col: str = "text", min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """df with each span of its text replaced by [KIND]; a null text stays null."""
    other = [c for c in df.columns if c != text_col]
    kept = F.struct(F.col(text_col).isNull().alias("_null"), F.struct(*[F.col(f"`{c}`") for c in other], F.lit(1).alias("_one")).alias("_rest"))
    found = _scan(df, kept, text_col, min_seeds, min_confidence, rounds)
    clean = F.when(~F.col("_id._null"), spans.redacted(F.col("_text"), F.col("spans"), KINDS))
    columns = {c: F.col(f"_id._rest.`{c}`") for c in other} | {text_col: clean}
    return found.select(*[columns[c].alias(c) for c in df.columns])


def _scan(df: DataFrame, key: Column, text_col: str, min_seeds: int, min_confidence: float, rounds: int) -> DataFrame:
    """_id (key), _text, base, spans."""
    keyed = df.select(F.struct(F.monotonically_increasing_id().alias("row"), key.alias("id")).alias("_key"), F.col(text_col).alias("_body"))
    found = candidates(base_entities(keyed, "_key", "_body"))
    found = scratch.stored(found.select(F.col("_id.row").alias("_row"), F.col("_id.id").alias("_id"), "_text", "base", "seeds", "fresh"), "pii_found")
    good = learn(found, min_seeds, min_confidence, rounds)
    # only texts with candidates meet the patterns
    some = found.where(F.size("fresh") > 0)
    led = some.select("_row", F.explode("fresh").alias("m")).select("_row", "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
    hits = graphs.hot_join(led, good, ["pattern"]).where(F.col("confidence").isNotNull())
    hits = hits.groupBy("_row").agg(F.collect_set(F.struct("start", F.lit(4).alias("rank"), "end")).alias("more"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    some = some.join(scratch.stored(hits, "pii_hits"), "_row", "left").select("_id", "_text", "base", F.concat("base", F.sort_array(F.coalesce("more", none))).alias("spans"))
    rest = found.where(F.size("fresh") == 0).select("_id", "_text", "base", F.col("base").alias("spans"))
    return some.unionByName(rest)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, digest of base spans, and all spans as a string."""
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])],
        F.sha2(spans.spelled(F.col("base"), KINDS, by_kind=True), 256).alias("base_sha256"),
        spans.spelled(F.col("spans"), KINDS, by_kind=True).alias("spans"),
    )
