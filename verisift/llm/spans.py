"""Places of regex matches as native columns.

One pass of the pattern marks every match in the text; the marked text is split at
the marks, so the parts are gap, match, gap, match, ..., gap and the sums of their
lengths are the places. All places are in code points, end exclusive.

Running sums and maxima are taken in blocks, and texts are cut by chunks, so that the
work for one text is linear in its length and in its number of matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements of a block of a running sum, and code points of a chunk of a text.
BLOCK, CHUNK = 64, 1024
#: Private-use characters: the mark, and what stands for it in texts that hold it. No pattern may match either.
MARK, AWAY = "\uf8f0", "\uf8f1"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column], use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """use(upto), where upto(i) is zero stepped over values[0] to values[i], and zero itself for i = -1."""

    def bound(v: Column) -> Column:
        n_blocks = F.floor((F.size(v) + BLOCK - 1) / BLOCK).cast("int")
        total = lambda b: F.aggregate(F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), zero, step)
        totals = F.when(n_blocks > 0, F.transform(F.sequence(F.lit(0), n_blocks - 1), total)).otherwise(F.array().cast("array<int>"))
        before = F.aggregate(totals, F.array(zero), lambda a, x: F.concat(a, F.array(step(F.element_at(a, -1), x))))

        def with_blocks(sums: Column) -> Column:
            def upto(i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                own = F.aggregate(F.slice(v, block * BLOCK + 1, i - block * BLOCK + 1), F.get(sums, block), step)
                return F.when(i < 0, zero).otherwise(own)

            return use(upto)

        return let(before, with_blocks)

    return let(values, bound)


def with_matches(df: DataFrame, out: str, text: str, pattern: str, when: Column | None = None, lead: Callable[[Column], Column] | None = None) -> DataFrame:
    """df with column out: array of (start, end, found) of pattern's matches in text, leftmost and non-overlapping.

    The pattern must not match the empty string. Rows for which when is not true
    get no matches without a search. lead adds a field of that name: a function of
    the text from the end of the match before the previous one up to the match.
    """
    parts = f"_{out}_parts"
    safe = F.when(F.col(text).contains(MARK), F.translate(text, MARK, AWAY)).otherwise(F.col(text))
    marked = F.regexp_replace(safe, F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))
    cut = F.split(marked, MARK, -1)
    df = df.withColumn(parts, cut if when is None else F.when(when, cut))
    sizes = F.transform(parts, lambda x: F.length(x))

    def places(upto: Callable[[Column], Column]) -> Column:
        def one(i: Column) -> Column:
            start, found = upto(2 * i), F.get(parts, 2 * i + 1)
            fields = [start.alias("start"), found.alias("found")]
            if lead:
                near = [F.coalesce(F.get(parts, 2 * i + k), F.lit("")) for k in (-2, -1, 0)]
                fields.append(lead(F.concat(*near)).alias("lead"))
            return F.struct(*fields)

        return F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1), one)

    found = running(sizes, F.lit(0), lambda a, x: a + x, places)
    names = ["start", "found"] + (["lead"] if lead else [])
    kind = "array<struct<start:int,found:string" + (",lead:" + df.select(lead(F.lit("")).alias("x")).schema["x"].dataType.simpleString() if lead else "") + ">>"
    df = df.withColumn(out, F.when(F.size(parts) > 1, found).otherwise(F.array().cast(kind)))
    ended = lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["found"])).alias("end"), *[m[c].alias(c) for c in names[1:]])
    return df.withColumn(out, F.transform(out, ended)).drop(parts)


def tagged(matches: Column, rank: int) -> Column:
    """(start, rank, end) of each match."""
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))


def spelled(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """kind:start:end of (start, rank, end) spans, comma-joined, by start then kind or by kind then start."""
    names = F.array(*[F.lit(k) for k in kinds])
    if by_kind:
        spans = F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def clear_of(matches: Column, spans: Column) -> Column:
    """The matches that overlap none of the spans. Matches do not overlap each other; neither side holds empty ones.

    Spans by their starts and matches by their ends are sorted together; a match is
    clear if no span that starts before its end reaches beyond its start.
    """
    entry = lambda at, tag, reach, i: F.struct(at.alias("at"), F.lit(tag).alias("tag"), reach.alias("reach"), i.alias("i"))

    def clear(own: Column) -> Column:
        starts = F.transform(spans, lambda s: entry(s["start"], 1, s["end"], F.lit(-1)))
        ends = F.transform(own, lambda m, i: entry(m["end"], 0, F.lit(-1), i))

        def kept(line: Column) -> Column:
            def use(upto: Callable[[Column], Column]) -> Column:
                free = F.transform(line, lambda e, k: F.when((e["tag"] == 0) & (upto(k) <= F.get(own, e["i"])["start"]), F.get(own, e["i"])))
                return F.filter(free, lambda m: m.isNotNull())

            return running(F.transform(line, lambda e: e["reach"]), F.lit(-1), lambda a, x: F.greatest(a, x), use)

        return let(F.sort_array(F.concat(starts, ends)), kept)

    return F.when((F.size(spans) == 0) | (F.size(matches) == 0), matches).otherwise(let(matches, clear))


def redacted(text: Column, spans: Column, kinds: list[str]) -> Column:
    """text with each (start, rank, end) span replaced by [KIND]; of overlapping spans the first one names the whole."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in kinds])

    def cut(chunks: Column) -> Column:
        def part(a: Column, b: Column) -> Column:
            first, last = F.floor(a / CHUNK).cast("int"), F.floor(b / CHUNK).cast("int")
            return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), a - first * CHUNK + 1, b - a)

        def replace(line: Column) -> Column:
            def use(upto: Callable[[Column], Column]) -> Column:
                # a span that starts before all earlier ones have ended belongs to them
                pieces = F.transform(line, lambda s, i: let(upto(i - 1), lambda end: F.when(s["start"] >= end, F.concat(part(end, s["start"]), F.get(names, s["rank"]))).otherwise("")))
                tail = part(upto(F.size(line) - 1), F.length(text))
                return F.concat(F.array_join(pieces, ""), tail)

            return running(F.transform(line, lambda s: s["end"]), F.lit(0), lambda a, x: F.greatest(a, x), use)

        return let(F.sort_array(spans), replace)

    done = let(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0)), cut)
    return F.when(F.size(spans) > 0, done).otherwise(text)
