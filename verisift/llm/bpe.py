"""BPE encoding and decoding by per-prefix dynamic programming.

``BpeTables`` holds a vocabulary as arrays: a suffix automaton over all tokens, whose
links list the tokens that end a given prefix (the suffix matches), and the merge
table with each token's two halves. For each prefix exactly one token can be the last
one of its encoding, namely the suffix match whose pairing with the last token of the
remaining prefix is compatible (merging would not cross their border). Back-pointers
then give the exact ids. ``encode_words`` reads many words a symbol at a time; words
that are longer than almost all others are read on one by one, in time linear in
their length.

Texts are cut at white space, equal pieces are encoded once per batch, and ids
go back to documents by dictionary codes, so Python loops touch distinct pieces
only.

Defined results: a null text counts as empty (no ids, empty decoded text); rows
with null or repeated ids are kept, one result each; other columns are ignored.
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text bytes that one pass of the encoder takes together.
SLICE_BYTES = 4 << 20
#: Fewer words than this are read one by one; pairs whose compatibility is remembered meanwhile.
FEW, KNOWN_PAIRS = 16, 1 << 19


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class HashIndex:
    """Open-addressing map from non-negative int64 keys to int32, looked up by arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 4 - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys))
        at = self._home(keys)
        while len(todo):
            free = self.keys[at] < 0
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = keys[todo[put]], values[todo[put]]
            todo, at = todo[~put], at[~put]
            at = np.where(self.keys[at] >= 0, (at + 1) & self.mask, at)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.int32(-1))
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class BpeTables:
    """A byte-level BPE vocabulary file of the ``tokenizers`` library as arrays.

    Tokens are numbered in merge order: single symbols first, then special
    tokens, then merges. Symbols are bytes, bytes that end a word (when the
    vocabulary marks word ends), and one symbol for each special token.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        self.path = path
        self.end = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        names = [alphabet[b] for b in range(256)]
        if self.end:
            names += [n + self.end for n in names]
        self.n_bytes = len(names)
        self.specials = [t["content"] for t in spec.get("added_tokens") or []]
        special_id = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        names += self.specials
        base = len(names)
        order = {n: k for k, n in enumerate(names)}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = list(range(base)), list(range(base))
        symbols: list[tuple[int, ...]] = [(k,) for k in range(base)]
        for a, b in merges:
            name = a + b
            if name in order:
                raise ValueError(f"two merges give {name!r}")
            order[name] = len(names)
            names.append(name)
            left.append(order[a])
            right.append(order[b])
            symbols.append(symbols[order[a]] + symbols[order[b]])
        self.names = names
        self.base = base
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.length = np.array([len(s) for s in symbols], np.int64)
        self.out_id = np.array([special_id[n] if n in special_id else vocab.get(n, -1) for n in names], np.int64)
        self.n_sym, self.n_tokens = base, len(names)
        pair = self.left[base:] * self.n_tokens + self.right[base:]
        self.pairs = HashIndex(pair, np.arange(base, self.n_tokens, dtype=np.int32))
        self.pair_token = dict(zip(pair.tolist(), range(base, self.n_tokens), strict=True))
        self._build_automaton(symbols)
        self.known: dict[int, bool] = {}

    def _build_automaton(self, symbols: list[tuple[int, ...]]) -> None:
        """States are prefixes of tokens. fail leads to the longest proper suffix that is a
        state, link to the longest one that is a token; 0 is the empty prefix."""
        # a token that merging its own symbols never gives can be no last token
        built = self.compatible(self.left[self.base :], self.right[self.base :], np.arange(self.base, self.n_tokens))
        usable = [True] * self.n_tokens
        for token in range(self.base, self.n_tokens):
            usable[token] = bool(built[token - self.base]) and usable[self.left[token]] and usable[self.right[token]]
        self.goto: dict[int, int] = {}
        parent, sym, level, token_at = [0], [0], [0], [-1]
        for token, seq in enumerate(symbols):
            state = 0
            for depth, s in enumerate(seq, 1):
                to = self.goto.setdefault(state * self.n_sym + s, len(level))
                if to == len(level):
                    parent.append(state)
                    sym.append(s)
                    level.append(depth)
                    token_at.append(-1)
                state = to
            if usable[token]:
                token_at[state] = token
        self.trie = HashIndex(np.fromiter(self.goto.keys(), np.int64), np.fromiter(self.goto.values(), np.int32))
        self.token_at = np.array(token_at, np.int64)
        parent, sym, level = (np.array(x, np.int64) for x in (parent, sym, level))
        self.fail, self.link = np.zeros(len(level), np.int64), np.zeros(len(level), np.int64)
        for depth in range(2, int(level.max()) + 1):
            at = np.flatnonzero(level == depth)
            to = self.fail[at] = self.step(self.fail[parent[at]], sym[at])
            self.link[at] = np.where(self.token_at[to] >= 0, to, self.link[to])

    def step(self, state: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """The state after one more symbol: the longest suffix read so far that begins a token."""
        out, at = np.zeros(len(state), np.int64), np.arange(len(state))
        while len(at):
            to = self.trie.get(state * self.n_sym + sym).astype(np.int64)
            hit = to >= 0
            out[at[hit]] = to[hit]
            more = ~hit & (state > 0)
            at, state, sym = at[more], self.fail[state[more]], sym[more]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether BPE keeps a border between tokens a and b, before merge number limit if that is given.

        The merges that built the two tokens are undone from the latest on; the
        border falls if, at some moment, merging across it would have come first.
        """
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), self.n_tokens, np.int64) if limit is None else limit
        while len(at):
            across = self.pairs.get(a * self.n_tokens + b)
            lost = (across >= 0) & (across < limit)
            out[at[lost]] = False
            # undo the later of the two tokens' merges, on the side that has one left
            ra, rb = np.where(a >= self.base, a, -1), np.where(b >= self.base, b, -1)
            go = ~lost & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            # at equal age the left one merged first, so the right one is undone first
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    def compatible_one(self, a: int, b: int) -> bool:
        """compatible for one pair, remembered."""
        key = a * self.n_tokens + b
        ok = self.known.get(key)
        if ok is None:
            if len(self.known) >= KNOWN_PAIRS:
                self.known.clear()
            left, right = self.halves
            limit, ok = self.n_tokens, True
            while True:
                if self.pair_token.get(a * self.n_tokens + b, limit) < limit:
                    ok = False
                    break
                if a < self.base and b < self.base:
                    break
                if b < self.base or (a >= self.base and a > b):
                    limit, a = a, right[a]
                else:
                    limit, b = b + 1, left[b]
            self.known[key] = ok
        return ok

    def last_tokens(self, sym: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The one last token of each prefix, by the position of its last symbol (-1 if there is none).

        All words read a symbol at a time; once few are left, they are read one by one.
        """
        size = np.diff(start)
        order = np.argsort(-size, kind="stable")
        begin, size = start[:-1][order], size[order]
        last, state, k = np.full(len(sym), -1, np.int64), np.zeros(len(order), np.int64), 0
        falling = -size
        while (live := int(np.searchsorted(falling, -k))) >= FEW:
            first = begin[:live]
            state = self.step(state[:live], sym[first + k])
            todo, node = np.arange(live), np.where(self.token_at[state] >= 0, state, self.link[state])
            # suffix matches of the prefix, the longest first
            while len(todo):
                t = self.token_at[node]
                before = k + 1 - self.length[t]
                ok = before == 0
                inner = np.flatnonzero(~ok)
                if len(inner):
                    ok[inner] = self.compatible(last[first[todo[inner]] + before[inner] - 1], t[inner])
                last[first[todo[ok]] + k] = t[ok]
                node = self.link[node]
                more = ~ok & (node > 0)
                todo, node = todo[more], node[more]
            k += 1
        for w in range(live):
            lo, hi = int(begin[w]), int(begin[w] + size[w])
            last[lo:hi] = self._read_on(sym[lo:hi].tolist(), last[lo : lo + k].tolist(), int(state[w]))
        return last

    def _read_on(self, sym: list[int], last: list[int], state: int) -> list[int]:
        goto, n_sym, ok = self.goto, self.n_sym, self.compatible_one
        fail, link, token_at, length = self.lists
        for k in range(len(last), len(sym)):
            s = sym[k]
            while (to := goto.get(state * n_sym + s, 0)) == 0 and state:
                state = fail[state]
            state = to
            node, found = state if token_at[state] >= 0 else link[state], -1
            while node:
                t = token_at[node]
                before = k + 1 - length[t]
                if before == 0 or ok(last[before - 1], t):
                    found = t
                    break
                node = link[node]
            last.append(found)
        return last

    @cached_property
    def lists(self) -> tuple[list[int], ...]:
        return tuple(x.tolist() for x in (self.fail, self.link, self.token_at, self.length))

    @cached_property
    def halves(self) -> tuple[list[int], list[int]]:
        return self.left.tolist(), self.right.tolist()

    def encode_words(self, sym: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens (in merge order numbers) of words given as symbols; start has
        one more entry than there are words. Returns flat tokens and offsets."""
        n_words = len(start) - 1
        if not len(sym):
            return np.zeros(0, np.int64), np.zeros(n_words + 1, np.int64)
        last = self.last_tokens(sym, start)
        if (last < 0).any():
            raise ValueError("a prefix has no encoding: the vocabulary lacks a byte")
        # follow the back-pointers: of all words together, then of the few long ones that are left
        live = np.flatnonzero(np.diff(start) > 0)
        at = start[1:][live] - 1
        steps, count, rest = [], np.zeros(n_words, np.int64), {}
        while len(live) >= FEW:
            t = last[at]
            steps.append((live, t))
            count[live] += 1
            at = at - self.length[t]
            more = at >= start[live]
            live, at = live[more], at[more]
        length = self.lists[3]
        for w, end in zip(live.tolist(), at.tolist(), strict=True):
            own, tokens, k = last[start[w] : end + 1].tolist(), [], int(end - start[w])
            while k >= 0:
                tokens.append(own[k])
                k -= length[own[k]]
            rest[w] = tokens[::-1]
            count[w] += len(tokens)
        offset = np.r_[0, np.cumsum(count)]
        flat = np.empty(offset[-1], np.int64)
        for k, (w, t) in enumerate(steps):
            flat[offset[w + 1] - 1 - k] = t
        for w, tokens in rest.items():
            flat[offset[w] : offset[w] + len(tokens)] = tokens
        return flat, offset


@lru_cache(maxsize=4)
def tables(path: str) -> BpeTables:
    return BpeTables(path)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def gather(flat: np.ndarray, offset: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists that codes name, joined: values, and offsets by code."""
    size = offset[codes + 1] - offset[codes]
    out = np.r_[0, np.cumsum(size)]
    at = np.repeat(offset[codes] - out[:-1], size) + np.arange(out[-1])
    return flat[at], out


class PieceEncoder:
    """Encodes distinct text pieces: pre-tokens by a pattern, ids by the tables.

    ascii_pattern splits pieces of plain ASCII and latin_pattern those up to
    U+024F, where normal form and lower case go character by character. Other
    pieces go through the library's own normalizer and pre-tokenizer, so that its
    Unicode tables hold.
    """

    LATIN_END = "\u0250"

    #: Stands between pieces while a whole batch is split; pieces that hold control characters are split one by one.
    MARK = "\x00"

    def __init__(self, path: str, ascii_pattern: str, latin_pattern: str, lower: bool):
        self.tables, self.library = tables(path), library(path)
        self.ascii = re.compile(ascii_pattern + "|" + self.MARK)
        self.lower = lower
        self.latin = regex.compile(latin_pattern + "|" + self.MARK)
        self.special = re.compile("(" + "|".join(map(re.escape, self.tables.specials)) + ")") if self.tables.specials else None
        self.to_byte = {c: b for b, c in byte_alphabet().items()}
        self.odd = re.compile(r"[\x00-\x1f\x7f]" if lower else r"[\x00-\x08\x0e-\x1f\x7f]")

    def _slow(self, piece: str) -> list:
        """Pre-tokens of any piece, as bytes, or an int for a special token."""
        out: list = []
        for k, part in enumerate(self.special.split(piece) if self.special else [piece]):
            if k % 2:
                out.append(self.tables.n_bytes + self.tables.specials.index(part))
            elif part:
                if self.library.normalizer is not None:
                    part = self.library.normalizer.normalize_str(part)
                out += [bytes(self.to_byte[c] for c in t) for t, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat merge-order tokens and offsets, one list for each piece."""
        plain, latin, other = [], [], []
        for k, p in enumerate(pieces):
            if self.odd.search(p) or (self.special and "<|" in p):
                other.append(k)
            elif p.isascii():
                plain.append(k)
            else:
                (latin if max(p) < self.LATIN_END else other).append(k)
        counts = np.zeros(len(pieces), np.int64)
        words: list[bytes] = []
        special_at: list[tuple[int, int]] = []
        for group, pattern in ((plain, self.ascii), (latin, self.latin)):
            if group:
                text = self.MARK.join(pieces[k] for k in group) + self.MARK
                found = pattern.findall(text.lower() if self.lower else text)
                marks = np.fromiter((k for k, w in enumerate(found) if w == self.MARK), np.int64, len(group))
                counts[group] = np.diff(np.r_[-1, marks]) - 1
                words += [w.encode() for w in found if w != self.MARK]
        for k in other:
            got = self._slow(pieces[k])
            counts[k] = len(got)
            for w in got:
                if isinstance(w, int):
                    special_at.append((len(words), w))
                    words.append(b"\x00special%d" % w)
                else:
                    words.append(w)
        if not words:
            return np.zeros(0, np.int64), np.zeros(len(pieces) + 1, np.int64)
        encoded = pa.array(words, pa.binary()).dictionary_encode()
        codes, distinct = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
        special_code = {int(codes[at]): w for at, w in special_at}
        for c in special_code:
            distinct[c] = b"\x00"
        size = np.fromiter(map(len, distinct), np.int64, len(distinct))
        start = np.r_[0, np.cumsum(size)]
        sym = np.frombuffer(b"".join(distinct), np.uint8).astype(np.int64)
        if self.tables.end:
            sym[start[1:][size > 0] - 1] += 256
        for c, w in special_code.items():
            sym[start[c]] = w
        flat, offset = self.tables.encode_words(sym, start)
        # word lists to piece lists: pieces in order plain, latin, other
        tokens, by_word = gather(flat, offset, codes)
        order = np.array(plain + latin + other, np.int64)
        bound = np.r_[0, np.cumsum(counts[order])]
        begin, stop = by_word[bound[:-1]], by_word[bound[1:]]
        first = np.empty(len(pieces), np.int64)
        n_tok = np.zeros(len(pieces), np.int64)
        first[order], n_tok[order] = begin, stop - begin
        out = np.r_[0, np.cumsum(n_tok)]
        at = np.repeat(first - out[:-1], n_tok) + np.arange(out[-1])
        return tokens[at], out


def batch_slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(lo, hi) row ranges of about limit bytes each."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + limit, side="right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def give_back() -> None:
    """Returns freed memory to the system, so that workers that wait for their next task stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together, and offsets by text; null as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offset[0] : offset[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return data, offset - offset[0]


def distinct_pieces(data: np.ndarray, edges: np.ndarray, every: int = 1) -> tuple[np.ndarray, list[str]]:
    """Codes and distinct values of the pieces between edges; with every=2 only the first of each two pieces counts."""
    kind = pa.string() if len(data) < 1 << 31 else pa.large_string()
    edges = edges.astype(np.int32 if kind == pa.string() else np.int64)
    spans = pa.Array.from_buffers(kind, len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    if every > 1:
        spans = spans.take(pa.array(np.arange(0, len(spans), every)))
    got = spans.dictionary_encode()
    return got.indices.to_numpy(), got.dictionary.to_pylist()


#: The split pattern of the word vocabulary, for ASCII and for Latin text in lower case.
WORD_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x00-\x20a-z0-9]+"
WORD_LATIN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\x00-\x20\x85\xa0\p{L}\p{N}]+"


@lru_cache(maxsize=2)
def word_encoder(path: str) -> PieceEncoder:
    encoder = PieceEncoder(path, WORD_ASCII, WORD_LATIN, lower=True)
    if not encoder.tables.end:
        raise ValueError("the word encoder needs a vocabulary that marks word ends")
    return encoder


def encode_slice(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Merge-order tokens of all texts of a slice, and offsets by text."""
    data, offset = flat_bytes(texts)
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    is_text = ~white[data]
    # a piece begins where a non-space follows a space or a text's start
    cut = np.zeros(len(data) + 1, bool)
    cut[offset] = True
    begins = np.flatnonzero(is_text & (cut[:-1] | np.r_[True, ~is_text[:-1]]))
    ends = np.flatnonzero(is_text & (cut[1:] | np.r_[~is_text[1:], True])) + 1
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    edges = np.empty(2 * len(begins), np.int64)
    edges[0::2], edges[1::2] = begins, ends
    codes, pieces = distinct_pieces(data, edges, every=2)
    flat, by_piece = word_encoder(path).encode(pieces)
    tokens, by_code = gather(flat, by_piece, codes)
    return tokens, by_code[np.searchsorted(begins, offset)]


def _hex_of_lists(words: pa.Array, tokens: np.ndarray, offset: np.ndarray) -> list[str]:
    return [hashlib.sha256(x.as_buffer()).hexdigest() for x in joined(words, tokens, offset)]


def joined(words: pa.Array, tokens: np.ndarray, offset: np.ndarray) -> pa.Array:
    """For each list of tokens, their words joined by a space."""
    lists = pa.ListArray.from_arrays(pa.array(offset, pa.int32()), words.take(pa.array(tokens)))
    return pc.binary_join(lists, " ")


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids (array<int>) and decoded text of every row of df.

    With keep_ids=False ids and decoded are left out and only their digests
    ids_sha256 and decoded_sha256 are returned, so that long lists stay in the worker.
    """

    def run(batches):
        t = tables(path)
        id_words = pa.array(t.out_id.astype(str).tolist(), pa.string())
        names = pa.array(t.names, pa.string())
        for batch in batches:
            texts, ids = batch.column(1), batch.column(0)
            for lo, hi in batch_slices(texts):
                tokens, offset = encode_slice(texts.slice(lo, hi - lo), path)
                cols = [ids.slice(lo, hi - lo), pa.array(np.diff(offset), pa.int64())]
                if keep_ids:
                    lists = pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(t.out_id[tokens], pa.int32()))
                    yield pa.RecordBatch.from_arrays([*cols, lists, joined(names, tokens, offset)], ["id", "n_tokens", "ids", "decoded"])
                else:
                    cols += [pa.array(_hex_of_lists(w, tokens, offset), pa.string()) for w in (id_words, names)]
                    yield pa.RecordBatch.from_arrays(cols, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        give_back()

    kind = df.schema[id_col].dataType.simpleString()
    rest = "ids array<int>, decoded string" if keep_ids else "ids_sha256 string, decoded_sha256 string"
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, {rest}")
    return out.withColumnRenamed("id", id_col)


def decode_ids(ids: list[int], path: str) -> str:
    """The text of ids as the library decodes without a decoder: token names joined by a space."""
    t = tables(path)
    name = dict(zip(t.out_id.tolist(), t.names, strict=True))
    return " ".join(name[i] for i in ids if i in name)
