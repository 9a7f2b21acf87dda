"""BPE encoding and packing against the tokenizers library."""

import hashlib
import os
import random
import time
import zlib

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from verisift.llm import bpe, packing

WORD, BYTE, RANKS = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
EDGES = [
    None, "", " ", "\n\n", "a", "it's WE'LL don't", "<|endoftext|>", "x<|endoftext|>y <|startoftext|>", " lead", "trail ", "a  b   c\n\n d \n e\t f", "ǅ İ ΣΑΣ ﬁ é", "日本語 😀 a b", "\x00a\x01 b\x7f", "12345 6.7",
    "ß" * 50, "a" * 5000, "the " * 3000, "́ ́x", "x\x85y \x1cz", "a  b", "…  a — b", "½ ² ª",
]


def texts():
    rng = random.Random(3)
    pool = list("ab1 \n\t'’.é   ́日<|>sd  ΣßA")
    return EDGES + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(300)]


def test_encoding_equals_the_library(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, ids int").repartition(3)
    lib = Tokenizer.from_file(WORD)
    want = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    for r in bpe.encode_documents(df, WORD).collect():
        assert list(r["ids"]) == want[r["doc_id"]]
        assert r["decoded"] == lib.decode(want[r["doc_id"]], skip_special_tokens=False)
        assert bpe.decode_ids(want[r["doc_id"]], WORD) == r["decoded"]
    for r in bpe.encode_documents(df, WORD, keep_ids=False).collect():
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def long_texts():
    rng = random.Random(9)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    return ["a" * 1_000_000, letters, "\n" * 2_000_000, " \t" * 500_000, "日本" * 100_000, "é'" * 50_000, "the" * 100_000 + " x"]


def test_long_unbroken_texts_are_encoded_in_time():
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    pieces, t = packing.piece_ids(BYTE, RANKS), bpe.tables(WORD)
    for text in long_texts():
        start = time.time()
        tokens, offset = bpe.encode_slice(pa.array([text, "b"]), WORD)
        ids, at = packing.encode_slice(pa.array([text, "b"]), pieces)
        assert time.time() - start < 30
        assert t.out_id[tokens[: offset[1]]].tolist() == word.encode(text, add_special_tokens=False).ids
        assert ids[: at[1]].tolist() == byte.encode(text, add_special_tokens=False).ids


def test_words_read_together_and_one_by_one_agree(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("aehinrst") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    t = bpe.tables(WORD)
    sym = np.frombuffer("".join(words).encode(), np.uint8).astype(np.int64)
    start = np.r_[0, np.cumsum([len(w) for w in words])]
    sym[start[1:] - 1] += 256
    together = t.encode_words(sym, start)
    monkeypatch.setattr(bpe, "FEW", 10_000)
    alone = t.encode_words(sym, start)
    assert (together[0] == alone[0]).all() and (together[1] == alone[1]).all()


def test_automaton_lists_every_suffix_that_is_a_token():
    t = bpe.tables(WORD)
    known = {n: k for k, n in enumerate(t.names) if t.end not in n}
    text = "internationalization"
    state = np.zeros(1, np.int64)
    for k, c in enumerate(text):
        state = t.step(state, np.array([ord(c)]))
        node, found = int(state[0]), set()
        while node:
            if t.token_at[node] >= 0:
                found.add(t.names[t.token_at[node]])
            node = int(t.link[node])
        assert found == {text[j : k + 1] for j in range(k + 1)} & set(known)


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert bpe.encode_documents(df, WORD).count() == 3
    assert bpe.encode_documents(df.limit(0), WORD).count() == 0
    assert packing.pack_documents(df.limit(0), BYTE, RANKS).count() == 0
    assert packing.pack_documents(df, BYTE, RANKS).count() == 3


def test_hash_index():
    keys = np.random.default_rng(1).choice(1 << 40, 5000, replace=False).astype(np.int64)
    index = bpe.HashIndex(keys, np.arange(5000, dtype=np.int32))
    assert (index.get(keys) == np.arange(5000)).all()
    assert (index.get(keys + (1 << 41)) == -1).all()


def test_byte_ids_equal_the_library():
    lib = Tokenizer.from_file(BYTE)
    data = texts()
    ids, offset = packing.encode_slice(pa.array(data, pa.string()), packing.piece_ids(BYTE, RANKS))
    for k, t in enumerate(data):
        assert ids[offset[k] : offset[k + 1]].tolist() == lib.encode(t or "", add_special_tokens=False).ids, t


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    rooms: list[int] = []
    for k in np.argsort(-sizes, kind="stable"):
        at = next((i for i, r in enumerate(rooms) if r >= sizes[k]), len(rooms))
        if at == len(rooms):
            rooms.append(100)
        assert bins[k] == at and offsets[k] == 100 - rooms[at]
        rooms[at] -= sizes[k]


@pytest.mark.parametrize("group_rows", [8192, 7])
def test_packing_holds_each_id_once(spark, group_rows):
    data = [(i, t) for i, t in enumerate([*texts()[:60], "word " * 5000])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in data], "doc_id long, text string, id string, place int, grp int").repartition(3)
    rows = packing.pack_documents(df, BYTE, RANKS, capacity=64, group_rows=group_rows).toPandas()
    lib = Tokenizer.from_file(BYTE)
    for i, t in data:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own, at = rows[rows.doc_id == i].sort_values("start"), 0
        for r in own.itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert ((rows.sequence_id < 0) == (rows.length == 64)).all()
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 64
