"""Alignment of two tokenizers: which tokens overlap in bytes, where both end, and how often two ids are linked.

A text, with the space that both tokenizers see before it, is cut before each space or line break that a non-space
precedes. Neither tokenizer has a token across such a place (a test holds pieces against whole texts), so both end there,
and a piece has the same tokens and links wherever it stands. Each worker aligns a piece once and keeps it in a bounded
cache; the new pieces of a group of texts are aligned together by DuckDB, on one line of byte offsets:

* two interval tables, the tokens of A and of B, whose overlaps a range join finds;
* ASOF joins tell which ends both tables share, and a window sum over these numbers the groups.

DuckDB also counts the links of each text and in how many texts of the partition each id pair is linked. These partial
counts are summed by Spark, and the totals, with the best partner of each A id, go back to the texts' links by a join: a
broadcast where the pairs have been counted and are at most ``BROADCAST_PAIRS``, otherwise a shuffled join over salts.

Defined results: a null or empty text, and one that a tokenizer does not give back byte for byte, has no tokens, zeros and
an empty string; every row is a document of its own, repeated rows and null identifiers included; of equal counts of an A
id all are its highest; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.bpe import PATTERN, byte_alphabet
from caseledger.llm.common import materialize, worker_state

GROUP_CHARS = 2_000_000
CACHE_PIECES = 400_000
#: Most rows of pair counts that are broadcast, some 200 MB in an executor; checked by a count before.
BROADCAST_PAIRS = 4_000_000
PARTIAL_PAIRS = 1_000_000
#: Pieces that DuckDB aligns at once: the bound of its tables in a worker.
ALIGN_PIECES = 25_000
SALTS = 8
_WORDS = re.compile(r"\s*\S+|\s+").findall
_ODD = re.compile(r"[^\S \n]|᠎").search
_CUT = re.compile(r"(?<=[^\s᠎])(?=[ \n])").split

_OVERLAPS = """
SELECT a.piece, a.id AS a, b.id AS b, count(*) AS times FROM a JOIN b ON a.lo < b.hi AND b.lo < a.hi GROUP BY ALL ORDER BY a.piece
"""
#: A group's number is how many shared ends lie before a token.
_GROUPS = """
WITH ga AS (SELECT a.id, 0 AS side, a.n, sum((e.hi = a.hi)::INT) OVER (ORDER BY a.n) - (e.hi = a.hi)::INT AS g FROM a ASOF JOIN (SELECT hi FROM b UNION ALL SELECT -1) e ON a.hi >= e.hi),
     gb AS (SELECT b.id, 1 AS side, b.n, sum((e.hi = b.hi)::INT) OVER (ORDER BY b.n) - (e.hi = b.hi)::INT AS g FROM b ASOF JOIN (SELECT hi FROM a UNION ALL SELECT -1) e ON b.hi >= e.hi)
SELECT n, (2 * g + side)::BIGINT AS k FROM ga UNION ALL SELECT n, (2 * g + side)::BIGINT FROM gb
"""
_COUNT = """
SELECT o.doc, p.pair, sum(o.times * p.times)::BIGINT AS times FROM held o JOIN links p USING (slot) GROUP BY ALL ORDER BY o.doc, p.pair
"""


@cache
def _b_bytes(piece: str) -> bytes:
    if m := re.fullmatch(r"<0x([0-9A-F]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode()


def pieces(text: str) -> list[str]:
    """The text, led by a space, cut before spaces and line breaks that follow a non-space."""
    led = " " + text
    return _CUT(led) if _ODD(led) else _WORDS(led)


class Tokenizers:
    """The two tokenizers with the byte length of every id, which the pieces' tokens are placed by."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        code = {c: i for i, c in enumerate(byte_alphabet())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.ranked = self._ranked(path_a, vocab, code)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(code[c] for c in token if c in code)
        self.b_bytes = [_b_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in y], dtype=np.int64) for y in (self.a_bytes, self.b_bytes))

    def _ranked(self, path: str, vocab: dict[str, int], code: dict[str, int]):
        """A faster encoder of the same ids, which joins the adjacent tokens whose union has the least id, or None.

        Both agree where ids rise with the merges and every token encodes to itself: what stands at a union's place when
        its turn comes is then what the union alone has become by that time, which is the pair that its merge lists."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        split = spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        tokens = {t: i for t, i in vocab.items() if all(c in code for c in t)}
        if not plain or any(a >= b for a, b in zip(merged, merged[1:])) or any(len(self.a.model.tokenize(t)) != 1 for t in tokens):
            return None
        ranks = {bytes(code[c] for c in t): i for t, i in tokens.items()}
        return tiktoken.Encoding("ranked", pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, led: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a piece, or of pieces in a row. B adds the space itself; what begins otherwise loses the one it adds."""
        a = np.array(self.ranked(led) if self.ranked else self.a.encode(led, add_special_tokens=False).ids, dtype=np.int64)
        if led == " ":  # what B adds to no text at all
            b = [self.b.piece_to_id("▁")]
        else:
            b = self.b.encode(led[1:], num_threads=1) if led[0] == " " else self.b.encode(led, num_threads=1)[1:]
        return a, np.array(b, dtype=np.int64)

    def sound(self, led: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both give the bytes back."""
        raw = led.encode("utf-8", "surrogatepass")
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == raw

    def encode_many(self, many: list[str], at_once: int = 20_000):
        """(ids of A, piece of each, ids of B, piece of each, soundness by piece), encoding pieces in a row where it is safe."""
        size = np.fromiter((len(p.encode("utf-8", "surrogatepass")) for p in many), dtype=np.int64, count=len(many))
        good = np.ones(len(many), dtype=bool)
        # A piece that ends in white space may only stand last.
        alone = np.fromiter((p[-1:].isspace() or "▁" in p for p in many), dtype=bool, count=len(many))
        a_ids, a_of, b_ids, b_of = [], [], [], []

        def add(index: np.ndarray, led: str) -> bool:
            a, b = self.encode(led)
            if not self.sound(led, a, b):
                return False
            ends = np.cumsum(size[index])
            for ids, lengths, out, of in ((a, self.a_size, a_ids, a_of), (b, self.b_size, b_ids, b_of)):
                out.append(ids)
                of.append(index[np.searchsorted(ends, np.cumsum(lengths[ids]), "left")])
            return True

        together = np.flatnonzero(~alone)
        for k in range(0, len(together), at_once):
            part = together[k : k + at_once]
            if not add(part, "".join(many[i] for i in part.tolist())):
                for i in part.tolist():
                    good[i] = add(np.array([i]), many[i])
        for i in np.flatnonzero(alone).tolist():
            good[i] = add(np.array([i]), many[i])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
        return join(a_ids), join(a_of), join(b_ids), join(b_of), good


class Aligner:
    """One per worker: DuckDB and the pieces aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        self.tok = Tokenizers(path_a, path_b)
        self.width = len(self.tok.b_size)
        self.marked = [f"{i}{mark}" for i in range(max(len(self.tok.a_size), self.width)) for mark in ",|;\n"]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "preserve_insertion_order": False})
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.groups: list[str] = []
        self.stats = np.zeros((0, 4), dtype=np.int64)  # tokens of A and of B, groups, links
        self.sound = np.zeros(0, dtype=bool)
        self.db.execute("CREATE OR REPLACE TABLE links (slot BIGINT, pair BIGINT, times BIGINT)")

    def align(self, many: list[str]) -> None:
        """Tokens, groups and links of new pieces."""
        base = len(self.groups)
        a, a_of, b, b_of, good = self.tok.encode_many(many)
        tables = {}
        for name, ids, of, lengths in (("a", a, a_of, self.tok.a_size), ("b", b, b_of, self.tok.b_size)):
            order = np.argsort(of, kind="stable")
            ids, of = ids[order], of[order]
            hi = np.cumsum(lengths[ids])
            tables[name] = pa.table({"n": np.arange(len(ids)), "piece": of, "id": ids, "lo": hi - lengths[ids], "hi": hi})
            self.db.register(name, tables[name])
        found, grouped = (self.db.sql(x).to_arrow_table() for x in (_OVERLAPS, _GROUPS))
        for name in tables:
            self.db.unregister(name)
        stats = np.zeros((len(many), 4), dtype=np.int64)
        stats[:, 0], stats[:, 1] = np.bincount(a_of, minlength=len(many)), np.bincount(b_of, minlength=len(many))
        of = found.column("piece").to_numpy()
        stats[:, 3] = np.bincount(of, weights=found.column("times").to_numpy(), minlength=len(many)).astype(np.int64)
        # Tokens in order of group, those of A before those of B, each with the mark that stands after it.
        k, n = grouped.column("k").to_numpy(), grouped.column("n").to_numpy()
        order = np.lexsort((n, k))
        k, n = k[order], n[order]
        of_a, of_b = (tables[x].column("piece").to_numpy() for x in "ab")
        id_a, id_b = (tables[x].column("id").to_numpy() for x in "ab")
        side = k % 2 == 0
        owner, ids = np.empty(len(k), dtype=np.int64), np.empty(len(k), dtype=np.int64)
        owner[side], owner[~side], ids[side], ids[~side] = of_a[n[side]], of_b[n[~side]], id_a[n[side]], id_b[n[~side]]
        ends = np.append(owner[1:] != owner[:-1], True) if len(k) else np.zeros(0, dtype=bool)
        mark = np.append(np.where(k[1:] // 2 != k[:-1] // 2, 2, k[1:] - k[:-1]), 3) if len(k) else ids
        mark[ends] = 3
        whole = "".join(map(self.marked.__getitem__, (4 * ids + mark).tolist()))
        texts = [""] * len(many)
        for i, x in zip(owner[ends].tolist(), whole.split("\n"), strict=False):
            texts[i] = x
        stats[:, 2] = np.bincount(owner[mark >= 2], minlength=len(many))
        self.groups += texts
        self.stats = np.concatenate([self.stats, stats])
        self.sound = np.concatenate([self.sound, good])
        new = pa.table({"slot": of + base, "pair": found.column("a").to_numpy() * self.width + found.column("b").to_numpy(), "times": found.column("times")})
        self.db.register("new", new)
        self.db.execute("INSERT INTO links SELECT slot, pair, times FROM new")
        self.db.unregister("new")
        self.slot.update(zip(many, range(base, base + len(many)), strict=True))

    def texts(self, group: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(stats, group digests, offsets, pairs, times): of each text the sums, and its linked id pairs with their numbers."""
        if len(self.groups) > CACHE_PIECES:
            self._reset()
        cut = [pieces(t) if t else [] for t in group]
        flat = list(chain.from_iterable(cut))
        if new := list(set(flat).difference(self.slot)):
            for k in range(0, len(new), ALIGN_PIECES):
                self.align(new[k : k + ALIGN_PIECES])
        every = np.fromiter(map(self.slot.__getitem__, flat), dtype=np.int64, count=len(flat))
        slots = np.split(every, np.cumsum([len(ps) for ps in cut])[:-1])
        if not self.sound[every].all():
            slots = [at if self.sound[at].all() else self._whole(group[i]) for i, at in enumerate(slots)]
        stats = np.array([self.stats[at].sum(axis=0) for at in slots], dtype=np.int64).reshape(-1, 4)
        digests = [hashlib.sha256(";".join(map(self.groups.__getitem__, at.tolist())).encode()).hexdigest() if len(at) else "" for at in slots]
        held = np.concatenate([at + (i << 32) for i, at in enumerate(slots)]) if slots else np.zeros(0, dtype=np.int64)
        held, times = np.unique(held, return_counts=True)
        self.db.register("held", pa.table({"doc": held >> 32, "slot": held & 0xFFFFFFFF, "times": times.astype(np.int64)}))
        found = self.db.sql(_COUNT).to_arrow_table()
        self.db.unregister("held")
        offsets = np.searchsorted(found.column("doc").to_numpy(), np.arange(len(group) + 1))
        return stats, digests, offsets, found.column("pair").to_numpy(), found.column("times").to_numpy()

    def _whole(self, text: str) -> np.ndarray:
        """A text with a piece that does not come back byte for byte is judged, and if sound aligned, as one piece."""
        led = " " + text
        if not self.tok.sound(led, *self.tok.encode(led)):
            return np.zeros(0, dtype=np.int64)
        if led not in self.slot or not self.sound[self.slot[led]]:
            self.align([led])
        return np.array([self.slot[led]], dtype=np.int64)


_LINKED = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
    + [(c, pa.list_(pa.int64())) for c in ("pairs", "times", "seen_pairs", "seen_docs")]
)
_LINKED_SPEC = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>, seen_pairs array<long>, seen_docs array<long>"


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def linked_texts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per text with its sums and links, and rows without ``row`` that hold the partition's partial pair counts."""

    def run(batches):
        aligner = worker_state(f"{path_a}|{path_b}", lambda: Aligner(path_a, path_b))
        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 33
        seen_pairs, seen_docs, waiting = [], [], 0

        def merged():
            keys, at = np.unique(np.concatenate(seen_pairs), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate(seen_docs)).astype(np.int64)

        def counts(keys, docs):
            for k in range(0, len(keys), 100_000):
                part = slice(k, k + 100_000)
                lists = [pa.nulls(1, pa.list_(pa.int64()))] * 2 + [_lists([0, len(keys[part])], x[part]) for x in (keys, docs)]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in _LINKED][:7] + lists, schema=_LINKED)

        def emit(ids, group):
            nonlocal row, seen_pairs, seen_docs, waiting
            stats, digests, offsets, pairs, times = aligner.texts(group)
            n = len(group)
            keys, docs = np.unique(pairs, return_counts=True)
            seen_pairs.append(keys)
            seen_docs.append(docs)
            waiting += len(keys)
            columns = [pa.array(np.arange(row, row + n)), pa.array(ids, pa.int64()), *(pa.array(stats[:, k]) for k in range(4)), pa.array(digests), _lists(offsets, pairs), _lists(offsets, times)]
            yield pa.RecordBatch.from_arrays(columns + [pa.nulls(n, pa.list_(pa.int64()))] * 2, schema=_LINKED)
            row += n
            if waiting > PARTIAL_PAIRS:
                keys, docs = merged()
                if len(keys) > PARTIAL_PAIRS // 2:
                    yield from counts(keys, docs)
                    keys, docs = keys[:0], docs[:0]
                seen_pairs, seen_docs, waiting = [keys], [docs], len(keys)

        ids, group, chars = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                group.append(t or "")
                chars += len(group[-1])
                if chars > GROUP_CHARS:
                    yield from emit(ids, group)
                    ids, group, chars = [], [], 0
        if group:
            yield from emit(ids, group)
        if seen_pairs:
            yield from counts(*merged())

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _LINKED_SPEC)


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """(pair, docs, best): in how many texts each id pair is linked, and whether no pair of its A id has more."""
    partial = linked.filter("row is null").select(F.explode(F.arrays_zip("seen_pairs", "seen_docs")).alias("x"))
    counts = partial.groupBy(F.col("x.seen_pairs").alias("pair")).agg(F.sum("x.seen_docs").alias("docs"))
    counts = counts.withColumn("a", F.expr(f"pair div {width}"))
    tops = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(tops, "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    linked = materialize(linked_texts(docs, path_a, path_b, id_col, text_col), "linked-texts")
    counts = materialize(pair_counts(linked, width), "pair-counts")
    texts = linked.filter("row is not null")
    links = texts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    if counts.count() <= broadcast_pairs:
        met = links.join(F.broadcast(counts), "pair")
    else:
        # A pair in most texts is dealt over salts, each with its own copy of the count.
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["pair", "salt"])
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return texts.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
