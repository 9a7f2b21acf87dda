"""Packing of documents into sequences of bounded length.

Documents become token ids in one pass; long ones are cut into full sequences
and one remainder. Remainders are dealt to random groups of documents, and each
group packs its own by first-fit decreasing: a tournament tree over the free room
of the open sequences finds the first one with enough room in log time. Full
sequences need no packing and no shuffle; they have negative numbers. Only lengths
and checksums of remainders cross the shuffle.

The groups come from a hash of the row's place in the input, not of its id, so
that repeated ids spread. Each group leaves at most its last sequences with room.

Defined results: a null text is an empty one and yields a single piece with the
end token; repeated or null ids each yield their own pieces; other columns are left out.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.llm import bpe, scratch

#: Text bytes that are encoded together; ids and arrays take some forty times as much.
SLICE_BYTES = 2 << 20
#: Remainders that one group packs, on average. A group is one task's work and stays small at any input size.
GROUP_ROWS = 8192
#: Sequences are numbered within a group below this, groups above.
GROUP_SPAN = 1 << 32


class RoomTree:
    """A tournament tree: each node holds the most room among its sequences."""

    def __init__(self, n: int, capacity: int):
        self.size = 1 << max(0, (max(n, 1) - 1).bit_length())
        self.most = [capacity] * (2 * self.size)

    def take(self, need: int) -> tuple[int, int]:
        """The first sequence with room for need, and its room before that."""
        most, k = self.most, 1
        while k < self.size:
            k *= 2
            if most[k] < need:
                k += 1
        room = most[k]
        most[k] = room - need
        at = k
        while at > 1:
            at //= 2
            best = max(most[2 * at], most[2 * at + 1])
            if most[at] == best:
                break
            most[at] = best
        return k - self.size, room


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset in it for each size; ties keep their order."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    tree = RoomTree(len(sizes), capacity)
    for k in order.tolist():
        b, room = tree.take(int(sizes[k]))
        bins[k], offsets[k] = b, capacity - room
    return bins, offsets


class PieceIds:
    """Ids of text pieces: by the rank form of the vocabulary where both libraries
    split alike, else by the tokenizer itself: characters past Latin, special tokens, and
    long pieces, whose runs of white space would overflow the other library's stack."""

    LATIN_END, LONG = "\u0250", 2048

    def __init__(self, path: str, ranks_path: str):
        self.library = bpe.library(path)
        if self.library.normalizer is not None:
            raise ValueError("packing needs a byte-level vocabulary without normalizer")
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets, one list for each piece."""
        quick, end, long = self.ranks.encode_ordinary, self.LATIN_END, self.LONG
        lists = [quick(p) if len(p) <= long and (p.isascii() or max(p) < end) and "<|" not in p else self.library.encode(p, add_special_tokens=False).ids for p in pieces]
        offset = np.r_[0, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))]
        return np.fromiter(chain.from_iterable(lists), np.int64, offset[-1]), offset


@lru_cache(maxsize=2)
def piece_ids(path: str, ranks_path: str) -> PieceIds:
    return PieceIds(path, ranks_path)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Where a space stands between two bytes that surely are not white space: the split pattern always begins a token there."""
    solid = (data > 0x20) & (data != 0x7F)
    # lead bytes of characters that may be white space, and bytes that may end one
    lead = (data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3)
    ends = np.zeros(len(data), bool)
    ends[1:] |= data[:-1] == 0xC2
    ends[2:] |= lead[:-2] & (data[:-2] != 0xC2)
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < len(data) - 1)]
    return at[solid[at - 1] & ~ends[at - 1] & solid[at + 1] & ~lead[at + 1]]


def encode_slice(texts: pa.Array, encoder: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice and offsets by text."""
    data, offset = bpe.flat_bytes(texts)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    begin = np.zeros(len(data), bool)
    begin[cut_points(data)] = begin[offset[:-1][np.diff(offset) > 0]] = True
    begins = np.flatnonzero(begin)
    codes, pieces = bpe.distinct_pieces(data, np.r_[begins, len(data)])
    flat, by_piece = encoder.encode(pieces)
    ids, by_code = bpe.gather(flat, by_piece, codes)
    return ids, by_code[np.searchsorted(begins, offset)]


def pack_documents(df: DataFrame, path: str, ranks_path: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    path and ranks_path are two forms of one byte-level vocabulary.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(path, ranks_path)
        for batch in batches:
            ids, places, texts = batch.column(0), batch.column(1), batch.column(2)
            for lo, hi in bpe.batch_slices(texts, SLICE_BYTES):
                tokens, offset = encode_slice(texts.slice(lo, hi - lo), encoder)
                size = np.diff(offset) + 1
                n_pieces = -(-size // capacity)
                row = np.repeat(np.arange(hi - lo), n_pieces)
                first = np.r_[0, np.cumsum(n_pieces)]
                start = (np.arange(first[-1]) - first[row]) * capacity
                length = np.minimum(capacity, size[row] - start)
                tokens = tokens.astype("<u4")
                end = np.array([end_id], "<u4").tobytes()
                crc = np.empty(len(row), np.int64)
                for k, (r, s, n) in enumerate(zip(row.tolist(), start.tolist(), length.tolist(), strict=True)):
                    last = s + n == size[r]
                    crc[k] = zlib.crc32(tokens[offset[r] + s : offset[r] + s + n - last].tobytes() + (end if last else b""))
                cols = [ids.slice(lo, hi - lo).take(pa.array(row)), places.slice(lo, hi - lo).take(pa.array(row)), *map(pa.array, (start, length, crc, size[row]))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "place", "start", "length", "ids_crc32", "doc_tokens"])
        bpe.give_back()

    placed = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("place"), F.col(text_col).cast("string").alias("text"))
    pieces = placed.mapInArrow(cut, f"id {kind}, place bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")
    # lengths only, so that texts are tokenized once
    pieces = scratch.stored(pieces, "pieces")
    whole = pieces.where(F.col("length") == capacity).select("id", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = pieces.where(F.col("length") < capacity)
    groups = max(1, math.ceil(rests.count() / group_rows))

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("place", "ascending")])
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        out = rows.drop_columns(["place", "grp"])
        return out.append_column("sequence_id", pa.array(bins + key[0].as_py() * GROUP_SPAN)).append_column("offset", pa.array(offsets))

    grouped = rests.withColumn("grp", F.pmod(F.xxhash64(F.col("place")), F.lit(groups)).cast("long"))
    packed = grouped.groupBy("grp").applyInArrow(pack, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
    return packed.unionByName(whole).withColumnRenamed("id", id_col)
