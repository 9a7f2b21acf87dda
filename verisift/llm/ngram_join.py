"""Jaccard self-join on word shingles with Bayesian candidate pruning.

A document's shingles are its runs of five words (a shorter text is one shingle);
words are separated by white space. Equal texts form one class. MinHash bands of a
class representative give its buckets, and a bucket joins each member to its
smallest one. Components of these candidate edges hold every pair that shares a
bucket, so each component is compared on its own: its documents are sent once
(large components as blocks that meet pairwise), pairs are compared by MinHash
values a few at a time, and a pair is dropped as soon as the posterior probability
that its similarity reaches the threshold falls below a tolerance. Pairs that
remain are verified exactly on their shingles.

A block pair returns, for each text with links, the number of linked documents and
one edge of a spanning star; pairs are never emitted. With 32 bands of 4 values a
pair of similarity 0.8 shares no bucket with probability 5e-8, and pruning drops it with
probability 3e-8.

Defined results: a null or blank text and a null id link with nothing; repeated
rows are one text with a count; long texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.llm import bpe, graphs, scratch
from verisift.llm.metric_join import star_edges

#: Words in a shingle; bands and MinHash values in each; values compared at a time; texts in a block.
WIDTH, BANDS, ROWS, STEP, BLOCK = 5, 32, 4, 16, 1024
HASHES = BANDS * ROWS
#: Pairs are dropped below this posterior probability of reaching the threshold: so small that pruning loses fewer pairs than the bands.
TOLERANCE = 3e-9
MIX = np.random.default_rng(20240229).integers(1, 1 << 63, (2, HASHES), dtype=np.uint64)
MIX[1] |= np.uint64(1)
#: Text bytes that are hashed together; the arrays take some forty times as much.
SLICE_BYTES = 2 << 20
#: Distinct shingles that a block pair multiplies at a time.
COLUMNS = 4096
#: Size of the filter that texts pass before they are sent, in 64-bit words, and its hash functions.
FILTER_WORDS, FILTER_HASHES = 1 << 18, 2


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of each text, with repeats, and offsets by text."""
    data, offset = bpe.flat_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    is_text = ~white[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offset] = True
    begins = np.flatnonzero(is_text & (cut[:-1] | np.r_[True, ~is_text[:-1]]))
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    ends = np.flatnonzero(is_text & (cut[1:] | np.r_[~is_text[1:], True])) + 1
    edges = np.empty(2 * len(begins), np.int64)
    edges[0::2], edges[1::2] = begins, ends
    codes, words = bpe.distinct_pieces(data, edges, every=2)
    word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))[codes]
    at = np.searchsorted(begins, offset)
    n_words = np.diff(at)
    n = np.where(n_words > 0, np.maximum(n_words - WIDTH + 1, 1), 0)
    out = np.r_[0, np.cumsum(n)]
    first = np.repeat(at[:-1] - out[:-1], n) + np.arange(out[-1])
    last = np.repeat(at[1:], n)
    value = np.full(len(first), 0x243F6A8885A308D3, np.uint64)
    for k in range(WIDTH):
        place = first + k
        w = np.where(place < last, word[np.minimum(place, len(word) - 1)], np.uint64(0))
        value = (value ^ w) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value, out


def signatures(value: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """MinHash values (upper 32 bits) of each text, one row each; zero rows for texts without shingles."""
    out = np.zeros((len(offset) - 1, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(offset) > 0)
    if not len(full):
        return out
    # a few texts at a time, so that the passes stay in cache
    bounds = np.searchsorted(offset[full], np.arange(0, offset[-1], 1 << 16))
    bounds = np.unique(np.r_[bounds, len(full)])
    for lo, hi in zip(np.r_[0, bounds[:-1]], bounds, strict=True):
        if lo == hi:
            continue
        rows = full[lo:hi]
        part = value[offset[rows[0]] : offset[rows[-1] + 1]]
        start = offset[rows] - offset[rows[0]]
        for k in range(HASHES):
            out[rows, k] = np.minimum.reduceat((part ^ MIX[0, k]) * MIX[1, k], start) >> np.uint64(32)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 63-bit key for each text and band."""
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(sig), 1))
    for k in range(ROWS):
        key = (key ^ sig[:, k::ROWS].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
    return (key >> np.uint64(1)).astype(np.int64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For n = STEP, 2 STEP, ...: the fewest equal MinHash values at which P(J >= threshold) still reaches the tolerance, for a uniform prior."""
    grid = (np.arange(4000) + 0.5) / 4000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(logs - logs.max())
            if p[grid >= threshold].sum() / p.sum() >= tolerance:
                break
        out.append(m)
    return tuple(out)


def prune(a: np.ndarray, b: np.ndarray, threshold: float, triangle: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that outlast the incremental comparison."""
    least = least_matches(threshold)
    keep_i, keep_j = [], []
    for lo in range(0, len(a), 256):
        part = a[lo : lo + 256]
        same = np.zeros((len(part), len(b)), np.uint8)
        for k in range(STEP):
            same += part[:, k, None] == b[None, :, k]
        ok = same >= least[0]
        if triangle:
            ok &= np.arange(len(b))[None] > np.arange(lo, lo + len(part))[:, None]
        i, j = np.nonzero(ok)
        count = same[i, j].astype(np.int64)
        for step, need in enumerate(least[1:], 1):
            cols = slice(step * STEP, (step + 1) * STEP)
            for at in range(0, len(i), 1 << 16):
                s = slice(at, at + (1 << 16))
                count[s] += (part[i[s], cols] == b[j[s], cols]).sum(1)
            ok = count >= need
            i, j, count = i[ok], j[ok], count[ok]
        keep_i.append(i + lo)
        keep_j.append(j)
    return (np.concatenate(keep_i), np.concatenate(keep_j)) if keep_i else (np.zeros(0, np.int64),) * 2


def overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets_a[i] and sets_b[j]; sets are sorted arrays."""
    if len(i) < 200:
        return np.array([len(np.intersect1d(sets_a[x], sets_b[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    rows, cols = np.unique(i), np.unique(j)
    flat = np.concatenate([*(sets_a[k] for k in rows), *(sets_b[k] for k in cols)])
    _, code, seen = np.unique(flat, return_inverse=True, return_counts=True)
    size = np.array([*(len(sets_a[k]) for k in rows), *(len(sets_b[k]) for k in cols)])
    owner = np.repeat(np.arange(len(size)), size)
    shared = seen[code] > 1
    order = np.argsort(code[shared], kind="stable")
    code, owner = code[shared][order], owner[shared][order]
    step = np.r_[True, code[1:] != code[:-1]] if len(code) else np.zeros(0, bool)
    code = np.cumsum(step) - 1
    total = np.zeros((len(rows), len(cols)), np.float32)
    n_cols = int(code[-1]) + 1 if len(code) else 0
    for lo in range(0, n_cols, COLUMNS):
        s = slice(*np.searchsorted(code, [lo, lo + COLUMNS]))
        dense = np.zeros((len(size), min(COLUMNS, n_cols - lo)), np.float32)
        dense[owner[s], code[s] - lo] = 1
        total += dense[: len(rows)] @ dense[len(rows) :].T
    return total[np.searchsorted(rows, i), np.searchsorted(cols, j)].round().astype(np.int64)


def similar(sig_a, sets_a, sig_b, sets_b, threshold: float, triangle: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose shingle sets have a Jaccard similarity of at least threshold."""
    i, j = prune(sig_a, sig_b, threshold, triangle)
    if not len(i):
        return i, j
    both = overlaps(sets_a, sets_b, i, j)
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    union = size_a[i] + size_b[j] - both
    ok = both >= threshold * union - 1e-9
    return i[ok], j[ok]


def _text_hash(text_col: str) -> dict:
    return {"h1": F.xxhash64(text_col), "h2": F.xxhash64(F.lit(1), text_col)}


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over column h1: the more values, the more others pass it; none of its own fails."""
    places = F.explode(F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(k), "h1"), 40) for k in range(FILTER_HASHES)]))
    bits = hashes.select(places.alias("p")).select(F.pmod(F.shiftrightunsigned("p", 6), F.lit(FILTER_WORDS)).alias("word"), F.expr("shiftleft(1L, cast(p & 63 AS INT))").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most FILTER_WORDS rows
    out = np.zeros(FILTER_WORDS, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def passes(table: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    ok = np.ones(len(places[0]), bool)
    for p in places:
        p = p.astype(np.uint64)
        ok &= (table[(p >> np.uint64(6)).astype(np.int64) % FILTER_WORDS] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return ok


def join(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_links, class_id (the smallest id that is reachable over links, itself included) for every row of df."""
    return classified(df, threshold, id_col, text_col).select(F.col("id").alias(id_col), "n_links", "class_id")


def classified(df: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """id, h1, h2 (of the text), n_links, class_id, root (a number of the class, null for blank texts and null ids) for every row of df."""
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumns(_text_hash("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in bpe.batch_slices(batch.column(3), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                value, offset = shingles(part.column(3))
                band = band_keys(signatures(value, offset))
                full = np.diff(offset) > 0
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(full * BANDS)].astype(np.int32)), pa.array(band[full].ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], lists], ["id", "h1", "h2", "keys"])
        bpe.give_back()

    known = docs.select("id", "h1", "h2", "text").mapInArrow(keys, f"id {kind}, h1 bigint, h2 bigint, keys array<bigint>")
    known = scratch.stored(known, "band_keys")
    part = known.where(F.col("id").isNotNull() & (F.size("keys") > 0))
    # equal texts are one class; rep numbers the stored classes
    classes = part.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys"))
    classes = scratch.stored(classes.select(F.monotonically_increasing_id().alias("rep"), "h1", "h2", "id", "n", "keys"), "classes")

    # candidate components
    members = classes.select("rep", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("_n")).where(F.col("low") != F.col("high")).select("key", "low", "_n")
    buckets = scratch.stored(buckets, "buckets")
    edges = graphs.hot_join(members, buckets.select("key", "low"), ["key"], buckets.select("key", "_n"), BANDS * classes.count()).where(F.col("low").isNotNull() & (F.col("low") != F.col("rep"))).select(F.col("rep").alias("a"), F.col("low").alias("b"))
    groups = scratch.stored(graphs.components(edges), "candidates")
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sent = graphs.hot_join(groups, sizes, ["root"]).withColumnRenamed("node", "rep").join(classes.select("rep", "h1", "h2", "n"), "rep")
    sent = scratch.stored(sent.select("h1", "h2", "rep", "root", "blocks", "n", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block")), "sent")

    # texts of candidate classes; a filter of fixed size keeps most others out of the shuffle
    table = bit_filter(sent)

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(table, [batch.column(3 + k).to_numpy() for k in range(FILTER_HASHES)])))
            for lo, hi in bpe.batch_slices(batch.column(2), SLICE_BYTES):
                rows = batch.slice(lo, hi - lo)
                value, offset = shingles(rows.column(2))
                sig = signatures(value, offset)
                sets = [np.unique(value[offset[k] : offset[k + 1]]).tobytes() for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array([s.tobytes() for s in sig], pa.binary()), pa.array(sets, pa.binary())], ["h1", "h2", "sig", "sets"])
        bpe.give_back()

    wanted = docs.where(F.col("id").isNotNull()).select("h1", "h2", "text", *[F.shiftrightunsigned(F.xxhash64(F.lit(k), "h1"), 40).alias(f"p{k}") for k in range(FILTER_HASHES)])
    texts = wanted.mapInArrow(shred, "h1 bigint, h2 bigint, sig binary, sets binary")
    texts = texts.groupBy("h1", "h2").agg(F.first(F.struct("sig", "sets")).alias("x")).join(sent, ["h1", "h2"])
    dealt = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "rep", "n", "block", "x.sig", "x.sets")

    def compare(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        part = part.sort_by("rep")
        sig = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(s, np.uint64) for s in part["sets"].to_pylist()]
        block, n, rep = (part[c].to_numpy() for c in ("block", "n", "rep"))
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        i, j = similar(sig[a], [sets[k] for k in a], sig[b], [sets[k] for k in b], threshold, first == second)
        i, j = a[i], b[j]
        links = np.bincount(i, weights=n[j], minlength=len(n)) + np.bincount(j, weights=n[i], minlength=len(n))
        low = star_edges(len(n), i, j)
        at = np.flatnonzero(links > 0)
        return pa.table({"rep": rep[at], "links": links[at].astype(np.int64), "low": rep[low[at]]})

    found = dealt.groupBy("root", "first", "second").applyInArrow(compare, "rep bigint, links bigint, low bigint")
    found = scratch.stored(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = graphs.components(found.select(F.col("rep").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "rep")
    named = scratch.stored(roots.join(classes.select("rep", "id"), "rep"), "named")
    lowest = named.groupBy("root").agg(F.min("id").alias("class_id"))
    named = graphs.hot_join(named, lowest, ["root"]).select("rep", "root", "class_id")
    result = classes.select("rep", "h1", "h2", "id", "n").join(links, "rep", "left").join(named, "rep", "left")
    result = result.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("root", "rep").alias("root"))
    result = scratch.stored(result, "class_result")
    own = graphs.hot_join(part.select("id", "h1", "h2"), result, ["h1", "h2"]).select("id", "h1", "h2", "n_links", "class_id", "root")
    rest = known.where(F.col("id").isNull() | (F.size("keys") == 0)).select("id", "h1", "h2", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("class_id"), F.lit(None).cast("long").alias("root"))
    return own.unionByName(rest)


def dedup(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows whose id is not the smallest of their own class; of rows that repeat id and text, and of texts of one class that repeat its smallest id, one stays. Rows with a null id stay."""
    key = ["_id", "_h1", "_h2"]
    found = classified(df, threshold, id_col, text_col).where(F.col("id").isNotNull()).select(F.col("id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "class_id", "root")
    each = found.groupBy(*key).agg(F.first("class_id").alias("class_id"), F.first("root").alias("root"), F.count(F.lit(1)).alias("_rows"))
    each = scratch.stored(each.withColumn("_kept", F.col("_id") == F.col("class_id")), "kept")
    # different texts of one class with its smallest id: the least hash stays
    least = each.where(F.col("_kept") & F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("_h1", "_h2")).alias("_least"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    least = scratch.stored(least.select("root", "_least"), "least")
    second = each.where("_kept").join(least, "root").where(F.struct("_h1", "_h2") != F.col("_least")).select(*key)
    # what goes and what repeats is stored by itself: while it is small, texts need no shuffle
    lost = scratch.stored(each.where(~F.col("_kept")).select(*key).unionByName(second), "lost")
    several = scratch.stored(each.where(F.col("_kept") & (F.col("_rows") > 1)).select(*key), "repeated")
    text = F.col(text_col).cast("string")
    known = df.where(F.col(id_col).isNotNull()).withColumns({"_id": F.col(id_col), "_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), text)})
    known = known.join(lost, key, "left_anti")
    once = known.join(several, key, "left_anti")
    again = known.join(several, key, "left_semi").dropDuplicates(key)
    out = once.unionByName(again).select(*df.columns)
    return out.unionByName(df.where(F.col(id_col).isNull()))
