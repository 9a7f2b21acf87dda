"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z in
lower case. Keys of at least ``min_chars`` code points that occur in more than
one document keep their lines only in the document with the smallest id.

``LineRuns`` keeps, for each key hash seen so far, the id that owns it. A batch
is first reduced to one row for each hash, then merge-anti-joined with the runs,
and what is new becomes a run of its own. When a level holds ``fanout`` runs they
are merged into one run of the next level. Runs are bucketed by the hash and
sorted, so an anti-join shuffles the batch only. Batches must come in ascending
order of ids; the whole-table operator cuts its input accordingly.

Hashes have 128 bits. Aggregation before the shuffle leaves at most one row for a
frequent line from each task, and lines meet their owner by (hash, id), so a line
that a third of all documents share spreads over all partitions.

Defined results: a null or empty text is one empty line; rows with a null id own
nothing and keep all lines; repeated rows with one id keep or lose the same lines;
ids may be of any type that has an order; other columns stay untouched, but input
columns named n_lines or n_dropped are replaced.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verisift.llm import scratch

#: ASCII white space that a key loses at both ends: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
#: Ids that batch borders are taken from.
SAMPLE = 1000
#: The setting by which Spark takes the order of sorted buckets into account.
SORTED_RUNS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_hashes(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """id, doc (hash of the text), pos, h1, h2 of each line whose key is long enough."""

    def hashed(line: Column, pos: Column) -> Column:
        key = line_key(line)
        return F.struct(pos.alias("pos"), F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))).alias("h"))

    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("doc"), F.transform(split_lines(F.col(text_col)), hashed).alias("lines"))
    rows = rows.select("id", "doc", F.explode(F.filter("lines", lambda x: x["h"].isNotNull())).alias("x"))
    return rows.select("id", "doc", F.col("x.pos").alias("pos"), F.col("x.h.h1").alias("h1"), F.col("x.h.h2").alias("h2"))


class LineRuns:
    """Owners of line hashes as levelled runs in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        out = rows.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
        out.option("path", scratch.new_path(self.spark, name)).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (id, h1, h2); its ids are above those of earlier batches."""
        with self._sorted_runs():
            new = batch.groupBy(*HASH).agg(F.min("id").alias("id"))
            for level in self.levels:
                for run in level:
                    # merged, as the run is sorted already
                    new = new.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
            self._write(new, 0)
            self._compact()

    @contextmanager
    def _sorted_runs(self):
        """Runs have one sorted file for each bucket; while they are merged, Spark may rely on it."""
        before = self.spark.conf.get(SORTED_RUNS)
        self.spark.conf.set(SORTED_RUNS, "true")
        try:
            yield
        finally:
            self.spark.conf.set(SORTED_RUNS, before)

    def _drop(self, run: str) -> None:
        path = self.spark.sql(f"DESCRIBE TABLE EXTENDED {run}").where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {run}")
        scratch.remove(self.spark, path)

    def drop(self) -> None:
        """Removes all runs."""
        for run in [run for level in self.levels for run in level]:
            self._drop(run)
        self.levels = []

    def _compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                self.levels[level] = []
                self._write(self._union(runs), level + 1)
                for run in runs:
                    self._drop(run)

    def _union(self, runs: list[str]) -> DataFrame:
        out = self.spark.table(runs[0])
        for run in runs[1:]:
            out = out.unionByName(self.spark.table(run))
        return out

    def owners(self) -> DataFrame:
        """h1, h2, id: the smallest id that holds each hash."""
        return self._union([run for level in self.levels for run in level])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4) -> DataFrame:
    """df with text_col cut to the lines that stay, and n_lines (before) and n_dropped."""
    spark = df.sparkSession
    hashes = scratch.stored(line_hashes(df, id_col, text_col, min_chars), "line_hashes")
    # batches of about equal size: quantiles of a bounded sample of ids, of any type that has an order
    ids = sorted(r["id"] for r in df.select(F.col(id_col).alias("id")).where("id is not null").orderBy(F.xxhash64("id")).limit(SAMPLE).collect())
    cuts = sorted({ids[k * len(ids) // batches] for k in range(1, batches)}) if ids else []
    runs = LineRuns(spark)
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = hashes
        if lo is not None:
            part = part.where(F.col("id") > lo)
        if hi is not None:
            part = part.where(F.col("id") <= hi)
        runs.add(part)
    lost = hashes.join(runs.owners(), [*HASH, "id"], "left_anti").groupBy("id", "doc").agg(F.collect_set("pos").alias("lost"))
    lost = scratch.stored(lost, "lost_lines")
    runs.drop()
    scratch.forget(hashes)
    lost = lost.select(F.col("id").alias("_lost_id"), F.col("doc").alias("_lost_doc"), "lost")
    on = (F.col("_id") == F.col("_lost_id")) & (F.xxhash64("_text") == F.col("_lost_doc"))
    other = [c for c in df.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    packed = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in other], F.lit(1).alias("_one")).alias("_rest"))
    lines = split_lines(F.col("_text"))
    joined = packed.join(lost, on, "left").select("_id", "_text", "_rest", lines.alias("_lines"), "lost")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "lost"), lambda p: F.get("_lines", p))
    out = joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("lost").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias(text_col),
        *[F.col(f"_rest.`{c}`").alias(c) for c in other],
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return out
