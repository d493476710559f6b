"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

Leaf i holds the rank of the pair that starts at symbol i, tied by position, and a node the least of its leaves: the
root yields the leftmost pair of lowest rank. A merge changes three leaves, each a walk of logarithmic length to the
root, until the root holds no pair. Short pre-tokens go through many trees at once, as rows of numpy arrays; long ones
through one tree of Python lists.

A text is cut before every space that a non-space follows, which the pre-tokenizer's pattern always does as well, so a
piece encodes the same wherever it stands and is encoded once per worker. The cache is bounded; whole texts are encoded.

Defined results: a null text is empty and has no tokens; the special token's own string in a text becomes its id, as in
the tokenizer file; texts of any length and repeated rows are encoded alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import worker_state

#: The pre-tokenizer's pattern (public, that of byte-level BPE).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CUT = regex.compile(r" (?=\S)")
_ODD_SPACES = [c for c in map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) if c != "\n"]
CACHE_PIECES = 600_000
LONG = 256
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


class PairTable:
    """(left, right) -> (rank, merged id) as a bucketed hash table that numpy reads with one gather."""

    WAYS = 4

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        self.py = {(a << 20) | b: (r << 20) | m for r, ((a, b), m) in reversed(list(enumerate(zip(pairs, merged, strict=True))))}
        keys = np.fromiter(self.py.keys(), dtype=np.int64, count=len(self.py))
        values = np.fromiter(self.py.values(), dtype=np.int64, count=len(self.py))
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        for mult in ((0x9E3779B97F4A7C15 * k) & 0xFFFFFFFFFFFFFFFF | 1 for k in range(1, 2000)):
            slot = self._slot(keys, mult)
            order = np.argsort(slot, kind="stable")
            s = slot[order]
            way = np.arange(len(s)) - np.searchsorted(s, s)
            if not len(way) or way.max() < self.WAYS:
                break
        else:
            raise ValueError("no hash multiplier found")
        self.mult = mult
        self.keys = np.full((1 << self.bits, self.WAYS), -1, dtype=np.int64)
        self.values = np.full((1 << self.bits, self.WAYS), -1, dtype=np.int64)
        self.keys[s, way], self.values[s, way] = keys[order], values[order]

    def _slot(self, keys: np.ndarray, mult: int) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(mult)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(mult)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 20 | merged id, or NONE."""
        key = (left << 20) | right
        slot = self._slot(key, self.mult)
        hit = self.keys[slot] == key[:, None]
        return np.where(hit.any(axis=1), np.where(hit, self.values[slot], -1).max(axis=1), NONE)


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        names = byte_alphabet()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.pairs = PairTable([(vocab[a], vocab[b]) for a, b in merges], [vocab[a + b] for a, b in merges])
        self.base = np.array([vocab[c] for c in names], dtype=np.int64)
        code = {c: b for b, c in enumerate(names)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = bytes(code[c] for c in t)
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self._split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.first: dict[str, int] = {}
        self.spaced: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.n = 0

    # -- merging ---------------------------------------------------------------------------------------------------

    def _merge_one(self, ids: list[int]) -> list[int]:
        """One segment tree of Python lists; a leaf is rank << 32 | position."""
        n = len(ids)
        size = 1 << max(0, (n - 2).bit_length())
        none, get = 1 << 62, self.pairs.py.get
        tree = [none] * (2 * size)

        def leaf(i: int, j: int) -> int:
            v = get((ids[i] << 20) | ids[j])
            return none if v is None else ((v >> 20) << 32) | i

        for i in range(n - 1):
            tree[size + i] = leaf(i, i + 1)
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                low = a if a < b else b
                if tree[i] == low:
                    break
                tree[i] = low

        while (root := tree[1]) < none:
            p = root & 0xFFFFFFFF
            q = nxt[p]
            ids[p] = get((ids[p] << 20) | ids[q]) & 0xFFFFF
            ids[q] = -1
            r = nxt[p] = nxt[q]
            if r < n:
                prv[r] = p
            if q < n - 1:
                put(q, none)
            put(p, leaf(p, r) if r < n else none)
            if prv[p] >= 0:
                put(prv[p], leaf(prv[p], p))
        return [x for x in ids if x >= 0]

    def _merge_many(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows of symbol ids, padded; merged in place, -1 where a symbol has gone. One segment tree per row."""
        rows, width = ids.shape
        size = 1 << max(0, (width - 2).bit_length())
        pos = np.arange(width)
        live = pos[None, :-1] < (lengths - 1)[:, None]
        leaves = np.full((rows, size), NONE, dtype=np.int64)
        r, c = np.nonzero(live)
        found = self.pairs.find(ids[r, c], ids[r, c + 1])
        leaves[r, c] = np.where(found == NONE, NONE, ((found >> 20) << 20) | c)
        tree = np.full((rows, 2 * size), NONE, dtype=np.int64)
        tree[:, size:] = leaves
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        nxt = np.tile(pos + 1, (rows, 1))
        prv = np.tile(pos - 1, (rows, 1))
        t, w = 2 * size, width
        tree, ids, nxt, prv = tree.ravel(), ids.ravel(), nxt.ravel(), prv.ravel()
        row = np.arange(rows)

        def walk(base: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + size
            tree[base + node] = value
            for _ in range(size.bit_length() - 1):
                node >>= 1
                at = base + node
                tree[at] = np.minimum(tree[at + node], tree[at + node + 1])

        def value(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
            f = self.pairs.find(left, right)
            return np.where(f == NONE, NONE, ((f >> 20) << 20) | at)

        while True:
            root = tree[row * t + 1]
            go = root < NONE
            row, root = row[go], root[go]
            if not len(row):
                break
            tb, sb = row * t, row * w
            p = root & 0xFFFFF
            q = nxt[sb + p]
            ids[sb + p] = self.pairs.find(ids[sb + p], ids[sb + q]) & 0xFFFFF
            ids[sb + q] = -1
            after = nxt[sb + q]
            nxt[sb + p] = after
            n = lengths[row]
            has = after < n
            prv[(sb + after)[has]] = p[has]
            inner = q < size  # the last symbol starts no pair
            walk(tb[inner], q[inner], np.full(int(inner.sum()), NONE, dtype=np.int64))
            new = np.full(len(row), NONE, dtype=np.int64)
            new[has] = value(ids[(sb + p)[has]], ids[(sb + after)[has]], p[has])
            walk(tb, p, new)
            before = prv[sb + p]
            has = before >= 0
            if has.any():
                b = before[has]
                walk(tb[has], b, value(ids[sb[has] + b], ids[sb[has] + p[has]], b))
        return ids.reshape(rows, width)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of pre-tokens."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        by_width: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            n = len(b)
            if n == 1:
                out[i] = self.base[b[0] : b[0] + 1]
            elif n > LONG:
                out[i] = np.array(self._merge_one(self.base[np.frombuffer(b, np.uint8)].tolist()), dtype=np.int64)
            else:
                by_width.setdefault(1 << (n - 2).bit_length() if n > 2 else 1, []).append(i)
        for pairs, members in by_width.items():
            width = pairs + 1
            for k in range(0, len(members), 20_000):
                part = members[k : k + 20_000]
                lengths = np.array([len(raw[i]) for i in part], dtype=np.int64)
                grid = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in part), np.uint8).reshape(len(part), width)
                merged = self._merge_many(self.base[grid].copy(), lengths)
                keep = (merged >= 0) & (np.arange(width)[None, :] < lengths[:, None])
                flat, ends = merged[keep], np.cumsum(keep.sum(axis=1))
                for i, s, e in zip(part, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[i] = flat[s:e]
        return out

    # -- texts -----------------------------------------------------------------------------------------------------

    def _store(self, ids: np.ndarray) -> int:
        k = len(ids)
        while self.used + k > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        if self.n == len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.flat[self.used : self.used + k] = ids
        self.start[self.n], self.length[self.n] = self.used, k
        self.used += k
        self.n += 1
        return self.n - 1

    def _learn(self, pieces: dict[str, int], missing: set[str], lead: str) -> None:
        cut = {p: PATTERN.findall(lead + p) for p in missing}
        new = list({w for ws in cut.values() for w in ws}.difference(self.words))
        for w, ids in zip(new, self.encode_words(new), strict=True):
            self.words[w] = self._store(ids)
        for p, ws in cut.items():
            if len(ws) == 1:
                pieces[p] = self.words[ws[0]]
            else:
                slots = [self.words[w] for w in ws]
                pieces[p] = self._store(np.concatenate([self.flat[self.start[s] : self.start[s] + self.length[s]] for s in slots]) if slots else np.zeros(0, dtype=np.uint32))

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut before every space that a non-space follows, without those spaces."""
        if "  " in text or " \n" in text or text.endswith(" ") or any(c in text for c in _ODD_SPACES):
            return _CUT.split(text)
        return text.split(" ")

    def _parts(self, text: str) -> list[str]:
        return self._split.split(text) if self._split and any(t in text for t in self.special) else [text]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) + len(self.spaced) + len(self.first) > CACHE_PIECES:
            self._reset()
        cut = [[(part, None if part in self.special else self.pieces(part)) for part in self._parts(t)] for t in texts]
        self._learn(self.first, {p[0] for doc in cut for _, p in doc if p is not None}.difference(self.first), "")
        rest: set[str] = set()
        for doc in cut:
            for _, p in doc:
                if p is not None:
                    rest.update(p[1:])
        self._learn(self.spaced, rest.difference(self.spaced), " ")
        out, get = [], self.spaced.__getitem__
        for doc in cut:
            ids = []
            for part, p in doc:
                if p is None:
                    ids.append(np.array([self.special[part]], dtype=np.uint32))
                    continue
                slots = np.fromiter(map(get, p[1:]), dtype=np.int64, count=len(p) - 1)
                slots = np.concatenate([[self.first[p[0]]], slots])
                length = self.length[slots]
                ends = np.cumsum(length)
                at = np.repeat(self.start[slots] - (ends - length), length) + np.arange(ends[-1])
                ids.append(self.flat[at])
            out.append(ids[0] if len(ids) == 1 else np.concatenate(ids))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def load(path: str) -> ByteBpe:
    """One tokenizer per worker process."""
    return worker_state(path, lambda: ByteBpe(path))


def _groups(texts: list[str], chars: int = 2_000_000):
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(texts[end]) <= chars):
            n += len(texts[end])
            end += 1
        yield at, end
        at = end


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        bpe = load(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            counts, a, d = [], [], []
            for s, e in _groups(texts):
                for ids in bpe.encode_batch(texts[s:e]):
                    counts.append(len(ids))
                    a.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    d.append(hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(a), pa.array(d)], schema=kinds)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """docs plus an array column of ids; decode with :func:`decode`."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe, plain = load(path), [t or "" for t in texts.tolist()]
        return pd.Series([x.astype(np.int32) for s, e in _groups(plain) for x in bpe.encode_batch(plain[s:e])])

    return docs.withColumn(out_col, ids(F.col(text_col)))


def decode(docs: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "text") -> DataFrame:
    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        bpe = load(path)
        return pd.Series([bpe.decode(np.asarray(x if x is not None else [], dtype=np.int64)) for x in ids])

    return docs.withColumn(out_col, text(F.col(ids_col)))
