"""Quality classifier: a weak-label model over heuristic labellers trains a hashed linear scorer.

Eight labellers vote good, bad or nothing on each document from simple statistics.
The vote patterns of all documents are counted in Spark (at most 3 ** 8 patterns),
and expectation-maximisation over these counts estimates each labeller's accuracy
for either class and the posterior of each pattern. Posteriors of a bounded
sample of documents are the soft labels of a logistic model over hashed features
(word shapes, short words, bucketed statistics). The model then scores every
document in one pass; documents with a score of at least ``threshold`` are kept.

Statistics come from arrays of bytes and word codes, never from a loop over words.

Defined results: a null or blank text has score 0 and is rejected; texts shorter
than 20 words get no votes that need a longer text; repeated rows get equal
scores; other columns stay untouched, but input columns named score or keep are
replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verisift.llm import bpe, scratch

#: Size of the hashed feature space; documents that the scorer is fitted on, at most about.
DIMS, TRAIN_DOCS = 1024, 8000
#: Text bytes that are measured together; the arrays take some thirty times as much.
SLICE_BYTES = 2 << 20
#: Statistics: words, and shares of the text or its words.
STATS = ["n", "caps", "symbol", "distinct", "repeat", "length", "short", "stops", "bare"]
#: Labellers: statistic, the range that votes good, the ranges beyond which it votes bad, words needed.
LABELLERS = [
    ("caps", (0.0, 0.10), (-1.0, 0.30), 5),
    ("symbol", (0.0, 0.01), (-1.0, 0.04), 1),
    ("distinct", (0.50, 1.0), (0.25, 2.0), 40),
    ("repeat", (0.0, 0.05), (-1.0, 0.20), 8),
    ("length", (3.5, 7.0), (2.5, 9.0), 20),
    ("short", (0.18, 0.60), (0.10, 0.80), 20),
    ("stops", (0.005, 0.12), (0.0005, 0.25), 40),
    ("bare", (0.0, 0.04), (-1.0, 0.12), 8),
]
#: Byte classes: 0 white space, 1 lower case or beyond ASCII, 2 upper case, 3 digit, 4 sentence mark, 5 other symbol.
CLASSES = np.full(256, 5, np.uint8)
CLASSES[[9, 10, 11, 12, 13, 32]] = 0
CLASSES[ord("a") : ord("z") + 1] = CLASSES[128:] = 1
CLASSES[ord("A") : ord("Z") + 1] = 2
CLASSES[ord("0") : ord("9") + 1] = 3
CLASSES[list(b".,;:'\"-()?")] = 4
RUN = re.compile(rb"(.)\1+", re.S)
SHAPES = CLASSES.tobytes()


def _word_features(word: str) -> tuple[int, int]:
    """Hashes of a word's shape and, if it is short, of the word itself (else -1)."""
    raw = word.encode()
    shape = RUN.sub(rb"\1", raw.translate(SHAPES))
    bare = word.strip(".,;:!?\"'()").lower()
    return zlib.crc32(b"shape" + shape) % DIMS, zlib.crc32(b"word" + bare.encode()) % DIMS if 0 < len(bare) <= 3 else -1


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def measure(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """STATS of each text, and its hashed features as a dense float32 matrix; zeros where a text is not wanted."""
    n_docs = len(texts)
    data, offset = bpe.flat_bytes(texts)
    stats, features = np.zeros((n_docs, len(STATS))), np.zeros((n_docs, DIMS), np.float32)
    kind = CLASSES[data]
    is_text = kind > 0
    if not is_text.any():
        return stats, features
    cut = np.zeros(len(data) + 1, bool)
    cut[offset] = True
    begins = np.flatnonzero(is_text & (cut[:-1] | np.r_[True, ~is_text[:-1]]))
    ends = np.flatnonzero(is_text & (cut[1:] | np.r_[~is_text[1:], True])) + 1
    edges = np.empty(2 * len(begins), np.int64)
    edges[0::2], edges[1::2] = begins, ends
    codes, words = bpe.distinct_pieces(data, edges, every=2)
    codes = codes.astype(np.int64)
    at = np.searchsorted(begins, offset)
    n = np.diff(at)
    doc = np.repeat(np.arange(n_docs), n)
    per_doc = lambda x: np.bincount(doc, weights=x, minlength=n_docs)

    def of_bytes(hit: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(hit, out=total[1:])
        return total

    upper, lower, symbol, mark = (of_bytes(kind == k) for k in (2, 1, 5, 4))
    length = ends - begins
    shouted = (upper[ends] - upper[begins] >= 2) & (lower[ends] == lower[begins])
    bare = (symbol[ends] - symbol[begins]) + (mark[ends] - mark[begins]) == length
    n_text = np.diff(of_bytes(is_text)[offset])
    again = np.r_[False, (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])]
    pairs = np.unique(doc * (len(words) + 1) + codes)
    distinct = np.bincount(pairs // (len(words) + 1), minlength=n_docs)
    stats[:] = np.stack(
        [n, _shares(per_doc(shouted), n), _shares(np.diff(symbol[offset]), n_text), _shares(distinct, np.minimum(n, 2 * np.sqrt(np.maximum(n, 1)) * 10)), _shares(per_doc(again), n), _shares(per_doc(length), n), _shares(per_doc(length <= 3), n), _shares(np.diff(mark[offset]), n_text), _shares(per_doc(bare), n)],
        axis=1,
    )
    if wanted is None:
        wanted = np.ones(n_docs, bool)
    elif not wanted.any():
        return stats, features
    else:
        own = wanted[doc]
        doc = doc[own]
        known, codes = np.unique(codes[own], return_inverse=True)
        words = [words[k] for k in known.tolist()]
    table = np.array([_word_features(w) for w in words], np.int64).reshape(-1, 2)
    for k in range(2):
        h = table[codes, k]
        ok = h >= 0
        cell, count = np.unique(doc[ok] * DIMS + h[ok], return_counts=True)
        row = cell // DIMS
        features[row, cell % DIMS] += (count / n[row]).astype(np.float32)
    for k, name in enumerate(STATS[1:], 1):
        scale = {"length": 1.0, "stops": 40.0, "symbol": 40.0}.get(name, 10.0)
        bucket = np.where(n >= 20, np.minimum(stats[:, k] * scale, 12).astype(int), -1)
        for b in np.unique(bucket):
            features[wanted & (bucket == b), zlib.crc32(f"{name}:{b}".encode()) % DIMS] += 0.5
    return stats, features


def votes(stats: np.ndarray) -> np.ndarray:
    """0 nothing, 1 bad, 2 good, for each text and labeller."""
    out = np.zeros((len(stats), len(LABELLERS)), np.int64)
    for k, (name, (lo, hi), (low, high), least) in enumerate(LABELLERS):
        x, long = stats[:, STATS.index(name)], stats[:, 0] >= least
        out[long & (x >= lo) & (x <= hi), k] = 2
        out[long & ((x < low) | (x > high)), k] = 1
    return out


def weak_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns; a labeller that does not vote says nothing.

    Returns P(good) of each pattern, P(vote | class) of each labeller, and P(good).
    The start is the share of good votes, so that the classes keep their names.
    """
    good, bad = (patterns == 2).sum(1), (patterns == 1).sum(1)
    post = (good + 1.0) / (good + 3.0 * bad + 2.0)
    n_lf = patterns.shape[1]
    rates, prior = np.ones((n_lf, 2, 3)), 0.5
    for _ in range(rounds):
        prior = float(np.clip((counts * post).sum() / counts.sum(), 0.02, 0.98))
        for k in range(n_lf):
            for c, p in ((0, 1 - post), (1, post)):
                r = np.bincount(patterns[:, k], weights=counts * p, minlength=3)[1:] + 1.0
                rates[k, c, 1:] = r / r.sum()
        odds = np.log(prior / (1 - prior)) + sum(np.log(rates[k, 1, patterns[:, k]] / rates[k, 0, patterns[:, k]]) for k in range(n_lf))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return post, rates, prior


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-4) -> np.ndarray:
    """Weights (bias last) of a logistic model for soft labels, by adaptive gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, m, v = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    balance = np.where(y >= 0.5, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)).astype(np.float32)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (balance * (p - y)).astype(np.float32) / len(x) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def train(df: DataFrame, text_col: str = "text", n_docs: int = TRAIN_DOCS) -> np.ndarray:
    """Weights of the scorer, from the votes on all documents of df."""
    share = min(1.0, n_docs / max(1, df.count()))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in bpe.batch_slices(batch.column(0), SLICE_BYTES):
                texts = batch.column(0).slice(lo, hi - lo)
                chosen = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                stats, features = measure(texts, chosen)
                codes = votes(stats) @ (3 ** np.arange(len(LABELLERS)))
                dense = [features[k].tobytes() if c and stats[k, 0] else None for k, c in enumerate(chosen)]
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(dense, pa.binary()), pa.array(stats[:, 0] > 0)], ["pattern", "features", "any"])
        bpe.give_back()

    chosen = F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)
    voted = scratch.stored(df.select(F.col(text_col).cast("string").alias("t"), chosen.alias("c")).mapInArrow(vote, "pattern bigint, features binary, any boolean"), "quality_votes")
    counted = voted.where("any").groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** 8 rows
    if not counted:
        return np.zeros(DIMS + 1, np.float32)
    code = np.array([r["pattern"] for r in counted])
    patterns = code[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    post, _, _ = weak_labels(patterns, np.array([r["count"] for r in counted], float))
    label = dict(zip(code.tolist(), post.tolist(), strict=True))
    # copies share their hash, so a frequent text is either in the sample as one row or not at all
    sample = voted.where("features is not null").dropDuplicates(["features"]).select("pattern", "features").limit(2 * n_docs).toPandas()
    if not len(sample):
        return np.zeros(DIMS + 1, np.float32)
    x = np.frombuffer(b"".join(sample["features"]), np.float32).reshape(len(sample), DIMS)
    return fit_linear(x, np.array([label[p] for p in sample["pattern"]]))


def classify(df: DataFrame, text_col: str = "text", threshold: float = 0.5, weights: np.ndarray | None = None) -> DataFrame:
    """df with score (P(good)) and keep."""
    weights = train(df, text_col) if weights is None else weights
    base = df.drop("score", "keep")
    names = base.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in bpe.batch_slices(batch.column(names.index(text_col)), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                stats, features = measure(part.column(names.index(text_col)))
                p = 1 / (1 + np.exp(-np.clip(features @ weights[:-1] + weights[-1], -30, 30).astype(float)))
                p[stats[:, 0] == 0] = 0.0
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= threshold) & (stats[:, 0] > 0))], [*names, "score", "keep"])
        bpe.give_back()

    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())])
    return base.mapInArrow(score, schema)
