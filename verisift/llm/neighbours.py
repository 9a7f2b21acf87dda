"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of TABLES hash tables has random projections with Gaussian coefficients, cut into
SLOTS slots of equal width (the outer ones are open); their number grows with the rows,
one for each doubling, up to MOST_FUNCTIONS. Every vector is indexed. A query visits a
table's buckets in order of the estimated probability that a neighbour lies there,
which the normal distribution of the projected difference gives slot by slot, until the
estimate reaches the target. Candidates of all visited buckets are ranked by exact
Euclidean distance, and the tables' lists are merged.

Neighbouring buckets form regions of about BLOCK vectors; a larger region is cut into
blocks, and queries are cut into blocks too, so that a task holds a block of each,
whatever the table's size. A query goes to the regions that hold a bucket it visits,
and meets there the vectors of those buckets only.

Slot widths and the spread of neighbours are fitted on a bounded sample: PILOTS
vectors whose neighbours are found exactly. A query that finds fewer than k candidates
visits all buckets of one table, which is an exact search.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different length are not neighbours; a null id
is never a query; ties go to the smaller id; repeated rows are candidates each; other
columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verisift.llm import scratch

TABLES, SLOTS = 2, 2
#: Functions of a table: so many that a bucket holds about BUCKET vectors, within these bounds.
BUCKET, LEAST_FUNCTIONS, MOST_FUNCTIONS = 64, 6, 12
#: Width of a slot in standard deviations of the projection; success to reach over all tables.
WIDTH, SUCCESS = 1.0, 0.93
#: Vectors of the sample, pilots, vectors in a block, and queries in a block.
SAMPLE, PILOTS, BLOCK, QUERIES = 2000, 64, 4096, 2048


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """By linear interpolation of a fine table; beyond 8 it is 0 or 1."""
    return np.interp(z, CDF_AT, CDF)


CDF_AT = np.linspace(-8, 8, 4001)
CDF = np.array([0.5 * (1 + erf(z / sqrt(2))) for z in CDF_AT])


class Hashing:
    """The tables for vectors of one length, fitted on a sample and on pilots with their neighbours."""

    def __init__(self, sample: np.ndarray, seed: int, rows: int):
        rng = np.random.default_rng(seed)
        self.functions = min(MOST_FUNCTIONS, max(LEAST_FUNCTIONS, math.ceil(math.log(max(rows / BUCKET, 1), SLOTS))))
        #: The slots of each bucket.
        self.combos = np.array(list(product(range(SLOTS), repeat=self.functions)))
        self.regions = min(len(self.combos), -(-rows // BLOCK))
        self.mean = sample.mean(0)
        self.directions = rng.normal(size=(TABLES, sample.shape[1], self.functions))
        spread = np.stack([((sample - self.mean) @ a).std(0) for a in self.directions])
        self.width = WIDTH * np.where(spread > 0, spread, 1.0)
        self.shift = rng.uniform(-0.25, 0.25, (TABLES, self.functions)) * self.width
        self.keep, self.sigma = 1.0, 0.0

    def region(self, bucket: np.ndarray) -> np.ndarray:
        return bucket * self.regions // len(self.combos)

    def fit(self, pilots: np.ndarray, neighbours: list[np.ndarray]) -> None:
        """How a neighbour's projection follows from the query's: share kept and spread, on the cautious side."""
        keep, sigma = [], []
        for q, found in zip(pilots - self.mean, neighbours, strict=True):
            if len(found):
                x = found - self.mean
                share = x @ q / max(float(q @ q), 1e-300)
                keep.append(share.mean())
                sigma.append(sqrt(max(0.0, float(((x - share[:, None] * q) ** 2).sum(1).mean()))))
        if keep:
            self.keep, self.sigma = float(np.quantile(keep, 0.25)), float(np.quantile(sigma, 0.75))

    def edges(self, table: int) -> np.ndarray:
        """Inner slot borders of each function."""
        return (np.arange(1, SLOTS) - SLOTS // 2)[None] * self.width[table][:, None] + self.shift[table][:, None]

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        at = (x - self.mean) @ self.directions[table]
        edges = self.edges(table)
        slots = np.stack([np.searchsorted(edges[k], at[:, k], side="right") for k in range(self.functions)], axis=1)
        return slots @ (SLOTS ** np.arange(self.functions)[::-1])

    def probes(self, q: np.ndarray, table: int) -> np.ndarray:
        """Which buckets each query visits: the most promising ones up to the target."""
        at = (q - self.mean) @ self.directions[table]
        edges = self.edges(table)
        score = np.ones((len(q), len(self.combos)))
        for k in range(self.functions):
            below = normal_cdf((edges[k][None] - self.keep * at[:, k, None]) / max(self.sigma, 1e-12))
            below = np.hstack([np.zeros((len(q), 1)), below, np.ones((len(q), 1))])
            score *= np.diff(below, axis=1)[:, self.combos[:, k]]
        order = np.argsort(-score, axis=1, kind="stable")
        reached = np.cumsum(np.take_along_axis(score, order, 1), axis=1)
        target = 1 - (1 - SUCCESS) ** (1 / TABLES)
        # a bucket is visited if those before it do not reach the target
        taken = np.hstack([np.ones((len(q), 1), bool), reached[:, :-1] < target])
        out = np.empty_like(taken)
        np.put_along_axis(out, order, taken, 1)
        return out


def nearest(q: np.ndarray, x: np.ndarray, k: int, skip: np.ndarray, meets=None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows of its k nearest vectors and their exact distances.

    skip[i] is the row that is query i itself, or -1. Rows must be in order of ids.
    meets(lo, hi), if given, tells which rows the queries from lo to hi meet.
    """
    out = []
    square = (x * x).sum(1)
    scale = 1e-9 * (square.max(initial=0.0) + 1)
    for lo in range(0, len(q), 256):
        part = q[lo : lo + 256]
        rough = square[None] - 2 * part @ x.T
        if meets is not None:
            rough[~meets(lo, lo + len(part))] = np.inf
        for r, row in enumerate(rough):
            if skip[lo + r] >= 0:
                row[skip[lo + r]] = np.inf
            n = min(k, int(np.isfinite(row).sum()))
            if n <= 0:
                out.append((np.zeros(0, np.int64), np.zeros(0)))
                continue
            edge = np.partition(row, n - 1)[n - 1]
            at = np.flatnonzero(row <= edge + scale)
            exact = np.sqrt(((x[at] - part[r]) ** 2).sum(1))
            best = np.argsort(exact, kind="stable")[:n]
            out.append((at[best], exact[best]))
    return out


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row for which is_query holds."""
    spark = df.sparkSession
    vector = F.col(vector_col)
    rows = df.where(usable(vector)).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.size(vector).alias("dim"), vector.alias("v"))
    rows = scratch.stored(rows, "vectors")
    id_type = df.schema[id_col].dataType.simpleString()
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}  # one row for each vector length
    models: dict[int, Hashing] = {}
    sample = rows.orderBy(F.xxhash64("row")).select("row", "dim", "v").limit(SAMPLE).collect()
    for dim in counts:
        own = [np.array(r["v"], float) for r in sample if r["dim"] == dim] or [np.array(r["v"], float) for r in rows.where(F.col("dim") == dim).select("v").limit(SAMPLE).collect()]
        models[dim] = Hashing(np.array(own), seed + dim, counts[dim])
    _fit_pilots(rows, sample, models, k)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                x = matrix(part.column("v"))
                for table in range(TABLES):
                    bucket = models[dim].buckets(x, table)
                    cols = [pa.array(c.astype(np.int32)) for c in (np.full(len(x), table), models[dim].region(bucket), bucket)]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "id", "dim")), *cols, part.column("v")], ["row", "id", "dim", "table", "region", "bucket", "v"])

    v_type = rows.schema["v"].dataType.simpleString()
    placed = rows.mapInArrow(index, f"row bigint, id {id_type}, dim int, table int, region int, bucket int, v {v_type}")
    # at most TABLES * SLOTS ** MOST_FUNCTIONS rows for each vector length
    blocks = {(r["dim"], r["table"], r["region"]): -(-r["count"] // BLOCK) for r in placed.groupBy("dim", "table", "region").count().collect()}
    n_blocks = spark.createDataFrame([(*key, n) for key, n in blocks.items()], "dim int, table int, region int, blocks int")
    cell = ["dim", "table", "region", "block", "batch"]
    placed = placed.join(F.broadcast(n_blocks), cell[:3]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def visits(everything: bool, batches_of_queries: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, part in _by_dim(batch):
                    model = models[dim]
                    for lo in range(0, part.num_rows, 256):
                        some = part.slice(lo, 256)
                        q = matrix(some.column("v"))
                        for table in range(1 if everything else TABLES):
                            visited = np.ones((len(q), len(model.combos)), bool) if everything else model.probes(q, table)
                            regions = np.zeros((len(q), model.regions), bool)
                            who, bucket = np.nonzero(visited)
                            regions[who, model.region(bucket)] = True
                            who, where = np.nonzero(regions)
                            n = np.array([blocks.get((dim, table, int(r)), 0) for r in range(model.regions)])[where]
                            block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                            who, where = np.repeat(who, n), np.repeat(where, n)
                            lot = some.column("lot").to_numpy()[who] % batches_of_queries
                            cols = [pa.array(c.astype(np.int32)) for c in (np.full(len(who), table), where, block, lot)]
                            yield pa.RecordBatch.from_arrays([*(some.column(c).take(pa.array(who)) for c in ("row", "id", "dim")), *cols, some.column("v").take(pa.array(who))], ["row", "id", *cell, "v"])

        return run

    def rank(everything: bool):
        def run(key: tuple[pa.Scalar, ...], q: pa.Table, x: pa.Table) -> pa.Table:
            model, table = models[key[0].as_py()], key[1].as_py()
            x = x.sort_by([("id", "ascending"), ("row", "ascending")])
            order = np.argsort(x["row"].to_numpy())
            own_row, q_row = x["row"].to_numpy()[order], q["row"].to_numpy()
            found = []
            if len(own_row) and len(q_row):
                at = np.minimum(np.searchsorted(own_row, q_row), len(own_row) - 1)
                skip = np.where(own_row[at] == q_row, order[at], -1)
                vectors, bucket = matrix(q["v"]), x["bucket"].to_numpy()
                meets = None if everything else lambda lo, hi: model.probes(vectors[lo:hi], table)[:, bucket]
                found = nearest(vectors, matrix(x["v"]), k, skip, meets)
            n = np.array([len(f[0]) for f in found], np.int64)
            who = pa.array(np.repeat(np.arange(len(found)), n))
            to = pa.array(np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64))
            score = pa.array(np.concatenate([f[1] for f in found]) if found else np.zeros(0))
            q_id, x_id = q["id"].combine_chunks(), x["id"].combine_chunks()
            return pa.table({"query_row": q["row"].combine_chunks().take(who), "query_id": q_id.take(who), "row": x["row"].combine_chunks().take(to), "vec_id": x_id.take(to), "score": score})

        return run

    def find(queries: DataFrame, everything: bool) -> DataFrame:
        lots = max(1, -(-queries.count() // QUERIES))
        lot = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(lots)).cast("int")
        sent = queries.select("row", "id", "dim", lot.alias("lot"), "v").mapInArrow(visits(everything, lots), f"row bigint, id {id_type}, {', '.join(f'{c} int' for c in cell)}, v {v_type}")
        met = placed.where("table = 0") if everything else placed
        met = met.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
        found = sent.groupBy(*cell).cogroup(met.groupBy(*cell)).applyInArrow(rank(everything), f"query_row bigint, query_id {id_type}, row bigint, vec_id {id_type}, score double")
        order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row")
        return found.dropDuplicates(["query_row", "row"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    queries = rows.where(F.col("query") & F.col("id").isNotNull())
    best = scratch.stored(find(queries, False), "nearest")
    need = F.lit(0)
    for dim, n in counts.items():
        need = F.when(F.col("dim") == dim, min(k, n - 1)).otherwise(need)
    got = best.groupBy(F.col("query_row").alias("row")).agg(F.count(F.lit(1)).alias("got"))
    short = scratch.stored(queries.join(got, "row", "left").where(F.coalesce("got", F.lit(0)) < need).select(*queries.columns), "short")
    if short.head(1):
        best = best.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(find(short, True))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _by_dim(batch: pa.RecordBatch):
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, (batch if (dims == dim).all() else batch.take(pa.array(np.flatnonzero(dims == dim))))


def _fit_pilots(rows: DataFrame, sample: list, models: dict[int, Hashing], k: int) -> None:
    """Exact neighbours of at most PILOTS sample vectors of each length: each task keeps k for each pilot."""
    pilots: dict[int, list] = {dim: [r for r in sample if r["dim"] == dim][:PILOTS] for dim in models}
    known = {dim: (np.array([r["v"] for r in p], float), np.array([r["row"] for r in p])) for dim, p in pilots.items() if p}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list] = {}
        for batch in batches:
            for dim, part in _by_dim(batch):
                if dim in known:
                    x, row = matrix(part.column("v")), part.column("row").to_numpy()
                    q, own = known[dim]
                    skip = np.array([np.flatnonzero(row == o)[0] if (row == o).any() else -1 for o in own])
                    for i, (at, score) in enumerate(nearest(q, x, k, skip)):
                        best[dim, i] = sorted([*best.get((dim, i), []), *zip(score.tolist(), map(tuple, x[at].tolist()), strict=True)])[:k]
        flat = [(dim, i, s, list(v)) for (dim, i), found in best.items() for s, v in found]
        cols = list(zip(*flat, strict=True)) if flat else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.list_(pa.float64()))], ["dim", "pilot", "score", "v"])

    found = rows.select("row", "dim", "v").mapInArrow(scan, "dim int, pilot int, score double, v array<double>")
    order = Window.partitionBy("dim", "pilot").orderBy("score")
    near: dict[tuple[int, int], list] = {}
    for r in found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).collect():  # at most PILOTS * k rows for each length
        near.setdefault((r["dim"], r["pilot"]), []).append(r["v"])
    for dim, (q, _) in known.items():
        models[dim].fit(q, [np.array(near.get((dim, i), [])).reshape(-1, q.shape[1]) for i in range(len(q))])
