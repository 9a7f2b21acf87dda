"""Exact metric range join of embeddings: pairs of equal label and cosine at least a threshold.

Unit vectors turn the cosine into a Euclidean distance. Pivots partition the vectors of
a label: every vector is at home in the cell of its nearest pivot. Two vectors within
radius r lie in cells i and j only if the distances of each to the two pivots differ by
at most 2 r (triangle inequality); the squared distances then differ by at most 2 r
times the distance of the pivots. A vector is therefore a guest in such cells, of each
two cells in one direction only, so every pair meets in exactly one cell. Cells join
independently: residents with each other and with the guests.

The number of pivots of a label grows with its rows, one for about CELL of them, taken
by hash; labels of at most CELL rows need none. Pivots are broadcast, PIVOT_BYTES at
most: beyond that cells grow, and the result stays the same. Residents and guests are
cut into blocks of BLOCK vectors, and a task holds two blocks.

Equal vectors are one class with a count. A task returns, for each class with links,
the number of linked vectors and one edge of a spanning star, never the pairs.

Defined results: a null label and vectors that are null, empty, zero or hold null
or non-finite components link with nothing; vectors of different length do not
link; very large and very small components are scaled by powers of two first; repeated
rows link with each other; an empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verisift.llm import graphs, scratch

#: Vectors in a block, vectors for each pivot, and bytes of pivots that are broadcast.
BLOCK, CELL, PIVOT_BYTES = 4096, 1024, 16 << 20
#: Rounding allowance of boundary tests, on the safe side; distances that are held at a time.
SLACK, HELD = 1e-9, 1 << 21


def unit(vectors: np.ndarray) -> np.ndarray:
    exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1]
    scaled = np.ldexp(vectors, -exponent)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def homes_and_guests(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home cell of each unit vector, and (vector, cell) pairs of the cells that vectors visit as guests."""
    homes, who, where = [], [], []
    square_pivots = (pivots * pivots).sum(1)
    cells = np.arange(len(pivots))
    rows = max(1, HELD // len(pivots))
    for lo in range(0, len(x), rows):
        part = x[lo : lo + rows]
        square = np.maximum(0.0, (part * part).sum(1)[:, None] + square_pivots[None] - 2 * part @ pivots.T)
        home = square.argmin(1)
        own = square[np.arange(len(part)), home][:, None]
        apart = np.sqrt(np.maximum(0.0, square_pivots[home][:, None] + square_pivots[None] - 2 * pivots[home] @ pivots.T))
        near = (np.sqrt(square) - np.sqrt(own) <= 2 * radius + SLACK) & (square - own <= 2 * radius * apart + SLACK)
        # of two cells the one visits the other by the parity of their numbers, so that guests spread
        visits = (cells[None] < home[:, None]) ^ ((cells[None] + home[:, None]) % 2 == 1)
        i, j = np.nonzero(near & visits & (cells[None] != home[:, None]))
        homes.append(home)
        who.append(i + lo)
        where.append(j)
    return tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in (homes, who, where))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def linked(u: np.ndarray, v: np.ndarray, threshold: float, triangle: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rows with cosine at least threshold; with triangle, i < j of one set."""
    hit_i, hit_j = [], []
    for k in range(0, len(u), 512):
        hit = u[k : k + 512] @ v.T >= threshold
        if triangle:
            hit &= np.arange(len(v))[None] > np.arange(k, min(k + 512, len(u)))[:, None]
        i, j = np.nonzero(hit)
        hit_i.append(i + k)
        hit_j.append(j)
    return (np.concatenate(hit_i), np.concatenate(hit_j)) if hit_i else (np.zeros(0, np.int64),) * 2


def star_edges(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over edges (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while True:
            over = new[new]
            if (over == new).all():
                break
            new = over
        root = new[root]
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def choose_pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Unit vectors by (label, length) for each label with more than one cell's rows."""
    sized = classes.select("row", "label", "v", F.size("v").alias("dim"))
    sizes = scratch.stored(sized.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size")), "label_sizes")
    total = sizes.agg(F.sum("size"), F.max("dim")).first()
    if not total[0]:
        return {}
    cell = max(CELL, -(-total[0] * total[1] * 8 // PIVOT_BYTES))
    # at most total / cell labels are so large
    large = F.broadcast(sizes.where(F.col("size") > cell).select("label", "dim"))
    found = sized.where(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(cell)) == 0).join(large, ["label", "dim"], "left_semi").orderBy("row")
    chosen: dict[tuple, list] = {}
    for r in found.select("label", "dim", "v").collect():
        chosen.setdefault((r["label"], r["dim"]), []).append(r["v"])
    return {k: unit(np.array(v)) for k, v in chosen.items()}


def range_join(df: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component_id, kept for every row of df."""
    spark = df.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(label_col).isNotNull() & F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(good, vector).alias("v"))
    rows = rows.withColumns({"h1": F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "label", "v"))})
    rows = scratch.stored(rows, "vectors")
    classes = rows.where("v is not null").groupBy("h1", "h2").agg(F.min("row").alias("row"), F.min("id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = scratch.stored(classes, "classes")
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    pivots = choose_pivots(classes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("v").offsets.to_numpy())
            labels = batch.column("label").dictionary_encode()
            code, names = labels.indices.to_numpy(), labels.dictionary.to_pylist()
            split = np.full(len(code), -1)
            for k, name in enumerate(names):
                for dim in np.unique(dims[code == k]).tolist() if any(d[0] == name for d in pivots) else []:
                    if (name, dim) in pivots:
                        split[(code == k) & (dims == dim)] = k
            for dim, k in sorted(set(zip(dims.tolist(), split.tolist(), strict=True))):
                part = batch.take(pa.array(np.flatnonzero((dims == dim) & (split == k))))
                x = unit(part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                home, r, c = homes_and_guests(x, pivots[names[k], dim], radius) if k >= 0 else (np.zeros(len(x), np.int64),) + (np.zeros(0, np.int64),) * 2
                raw = pa.array([y.tobytes() for y in x], pa.binary())
                every = np.arange(len(x))
                for who, cells, guest in ((every, home, False), (r, c, True)):
                    for lo in range(0, len(who), 4 * BLOCK):
                        at, cell = pa.array(who[lo : lo + 4 * BLOCK]), cells[lo : lo + 4 * BLOCK].astype(np.int32)
                        cols = [part.column(name).take(at) for name in ("row", "label", "n")]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(cell), dim, np.int32)), pa.array(cell), pa.array(np.full(len(cell), guest)), raw.take(at)], ["row", "label", "n", "dim", "cell", "guest", "v"])

    label_type = rows.schema["label"].dataType.simpleString()
    cell = ["label", "dim", "cell"]
    placed = classes.select("row", "label", "n", "v").mapInArrow(place, f"row bigint, label {label_type}, n bigint, dim int, cell int, guest boolean, v binary")
    placed = scratch.stored(placed, "cells")
    in_blocks = lambda rows_: F.ceil(F.count_if(rows_) / BLOCK).cast("int")
    sizes = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("size"), in_blocks(~F.col("guest")).alias("residents"), in_blocks(F.col("guest")).alias("guests"))
    sizes = sizes.where("residents > 0 AND size > 1")
    dealt = graphs.hot_join(placed, sizes.drop("size"), cell).where("residents is not null")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("residents"))).cast("int"))

    def meeting(kind: Column, first: Column, second: Column) -> Column:
        return F.struct(kind.cast("int").alias("kind"), first.alias("first"), second.alias("second"))

    # kinds of tasks: 0 residents with residents, 1 residents with guests, 2 both, where a cell has one block of residents
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    mixed = lambda g: F.when((F.col("residents") == 1) & (g == 0), 2).otherwise(1)
    among = F.when((F.col("residents") > 1) | (F.col("guests") == 0), F.transform(upto(F.col("residents")), lambda o: meeting(F.lit(0), F.least("block", o), F.greatest("block", o)))).otherwise(F.array().cast("array<struct<kind:int,first:int,second:int>>"))
    host = F.concat(among, F.transform(upto(F.col("guests")), lambda g: meeting(mixed(g), F.col("block"), g)))
    visit = F.transform(upto(F.col("residents")), lambda h: meeting(mixed(F.col("block")), h, F.col("block")))
    dealt = dealt.withColumn("m", F.explode(F.when(F.col("guest"), visit).otherwise(host))).select("row", "n", "v", "guest", "block", *cell, "m.*")

    def meet(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        dim, kind, first, second = (key[k].as_py() for k in (1, 3, 4, 5))
        part = part.sort_by("row")
        x, row, n = _matrix(part["v"], dim), part["row"].to_numpy(), part["n"].to_numpy()
        guest, block = part["guest"].to_numpy(zero_copy_only=False).astype(bool), part["block"].to_numpy()
        own, visitors = np.flatnonzero(~guest & (block == first)), np.flatnonzero(guest)
        others = own if first == second else np.flatnonzero(~guest & (block == second))
        meets = ([(own, others)] if kind == 0 else []) + ([(own, visitors)] if kind else []) + ([(own, own)] if kind == 2 else [])
        pairs = [(a[i], b[j]) for a, b in meets for i, j in [linked(x[a], x[b], threshold, a is b)]]
        i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        links = np.bincount(i, weights=n[j], minlength=len(row)) + np.bincount(j, weights=n[i], minlength=len(row))
        root = star_edges(len(row), i, j)
        at = np.flatnonzero(links > 0)
        return pa.table({"row": row[at], "links": links[at].astype(np.int64), "root": row[root[at]]})

    found = dealt.groupBy(*cell, "kind", "first", "second").applyInArrow(meet, "row bigint, links bigint, root bigint")
    found = scratch.stored(found, "links")
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    roots = graphs.components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    named = classes.select("row", "low").join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    named = scratch.stored(named, "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = graphs.hot_join(named, lowest, ["root"]).select("row", "component_id")
    result = classes.select("row", "h1", "h2", "n").join(links, "row", "left").join(named, "row")
    result = scratch.stored(result.select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "class_result")
    own = graphs.hot_join(rows.where("v is not null").select("id", "h1", "h2"), result, ["h1", "h2"]).select("id", "n_links", "component_id")
    rest = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = own.unionByName(rest)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
