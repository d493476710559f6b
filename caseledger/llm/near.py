"""SimHash near duplicates by similarity: five-word shingles, Jaccard 0.8 or more, bit-sliced screen, exact check.

A text's fingerprint is the SimHash, of ``64 x WORDS`` bits, of the set of its five-word shingles. Sets of similarity 0.8
differ in 15 of 100 bits, which no banding of fingerprints finds for sure, so texts meet in blocks by shingle instead: a
set of n shares ceil(0.8 n) shingles with a similar one, hence under any common order of shingles the first
n - ceil(0.8 n) + 1 of both have at least one in common. In a block, fingerprints stand as vertical bit planes; probes count
their distances to the whole block with carry-save counters and are given up once all exceed ``RADIUS``. (Blocks of up to
64 members fill no word of a plane and are compared one by one.)

A block yields a spanning forest of the pairs that pass, never all pairs. The components of these forests are groups, which
hold every component of similar texts whole. A group's members are then compared exactly, tile by tile, by the sets of
their shingles' 64-bit hashes, and what is similar is linked, again by a spanning forest. A group of m texts costs m * m / 2
comparisons of fingerprints and, where these pass, of sets.

A pair of similarity 0.8 is expected to differ in 38.8 of 256 bits with a deviation of 5.7, so a ``RADIUS`` of 63 passes all
but some 1 in 100,000 of such pairs (fewer where more similar); sets under ``SMALL`` shingles, whose fingerprints are
coarse, are compared without the screen.

Shingles that recur in a bounded sample of texts come last in the order, so that what many texts quote is rarely in a
prefix. The sample decides the cost alone: any order gives the same links.

Defined results: words are lower-cased runs of letters and digits; a text of fewer than five words has one shingle, the
whole of it; null, empty and wordless texts are one another's copies; equal sets are one node whatever their number;
repeated rows are one document; a null identifier is kept only where a component has no other; empty tables give no
rows; other columns, of any name, stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import SHINGLE_WORDS, SIMILARITY, key_filter, materialize, release_worker, small_batches
from caseledger.llm.graph import connected_components
from caseledger.llm.simhash import TILE, majority, one_of_each

#: Fingerprint words of 64 bits; bits in which those of a candidate pair may differ; sets of fewer shingles than SMALL
#: are not screened.
WORDS, RADIUS, SMALL = 4, 63, 64
#: Blocks of so few members are compared in plain Python; members of a group that a task compares at a time.
FEW, GROUP_TILE = 8, 256
#: Cells (members x shingles) up to which a tile's sets are compared as one matrix product.
DENSE = 8_000_000
#: Texts whose shingles are counted for the order, and the most shingles that are put last.
SAMPLE, COMMON = 20_000, 100_000
_WORD = re.compile(r"[^\W_]+")
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42)
        return h


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingle_hashes(text: str | None, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    w = words_of(text)
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, w), dtype=np.uint64, count=len(w))
    n = max(1, len(w) - SHINGLE_WORDS + 1)
    s = np.full(n, min(len(w), SHINGLE_WORDS), dtype=np.uint64)
    for k in range(min(len(w), SHINGLE_WORDS)):
        s = (s ^ h[k : k + n]) * _ODD[k]
        s ^= s >> np.uint64(29)
    return np.unique(s)


def need(n: int, least: float = SIMILARITY) -> int:
    """Shingles that a set of n shares with any set similar to it."""
    x = Fraction(str(least)) * n
    return -(-x.numerator // x.denominator)


def prefix(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order: those of ``common`` last, each part by hash."""
    n = len(h)
    if n and len(common):
        late = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] == h
        h = np.concatenate([h[~late], h[late]])
    return h[: n - need(n) + min(1, n)]


def common_shingles(docs: DataFrame, text_col: str) -> np.ndarray:
    """Hashes that recur in a sample of the texts, sorted; at most ``COMMON``."""
    step = max(1, docs.count() // SAMPLE)
    sample = docs.select(F.col(text_col).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)

    def run(batches):
        release_worker()
        known = _Hashes()
        for b in batches:
            for t in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(t.as_py(), known).view(np.int64))], names=["h"])

    often = sample.distinct().mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).filter("n > 2").orderBy(F.desc("n"), "h").limit(COMMON)
    return np.sort(np.array([r["h"] for r in often.select("h").collect()], dtype=np.int64).view(np.uint64))


def set_fingerprint(h: np.ndarray) -> list[int]:
    """WORDS signed 64-bit words: in each, a bit is 1 if set in over half of the shingles' hashes, mixed anew for the word."""
    if not len(h):
        return [0] * WORDS
    out = []
    for k in range(WORDS):
        x = h * _ODD[k]
        x ^= x >> np.uint64(32)
        out.append(majority(x * _ODD[k + 1]))
    return np.array(out, dtype=np.uint64).view(np.int64).tolist()


FP = [f"f{k}" for k in range(WORDS)]


def with_prefixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, node, n, fingerprint words, prefix) of every row; equal sets have the same node."""
    common = common_shingles(docs, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches):
        release_worker()
        known = _Hashes()
        for b in batches:
            sets = [shingle_hashes(t.as_py(), known) for t in b.column(2)]
            nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            fps = np.array([set_fingerprint(s) for s in sets], dtype=np.int64).reshape(-1, WORDS)
            first = [prefix(s, common).view(np.int64) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in first])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(first)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), *(pa.array(fps[:, k]) for k in range(WORDS)), lists], names=["doc_id", "text_hash", "node", "n", *FP, "prefix"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, node long, n int, " + "".join(f"{f} long, " for f in FP) + "prefix array<long>")


def shingle_blocks(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """(h, node, n, fingerprint) of every prefix shingle that two nodes or more have, once each."""
    entries = rows.select("node", F.explode("prefix").alias("h"))
    # Written, so that the join deals both sides anew and a shingle of a third of the nodes can be split.
    often = materialize(entries.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("h"), "near-often")
    return entries.join(often, "h").distinct().join(facts.drop("text_hash"), "node").select("h", "node", "n", *FP)


def close(probes: np.ndarray, members: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """probes x members: whether fingerprints (rows of 64-bit words) differ in at most ``radius`` bits.

    Members stand as bit planes, 64 to a machine word. Carry-save counters of every probe are updated plane by plane; they
    start so high that the carry out of the last says that a distance has passed the radius. Probes all of whose distances
    have are given up. A block that does not fill a word is compared without planes.
    """
    m, words = members.shape
    if m <= 64:
        return np.bitwise_count(probes[:, None, :] ^ members[None, :, :]).sum(axis=2, dtype=np.int32) <= radius
    bits = np.unpackbits(np.ascontiguousarray(members).view(np.uint8).reshape(m, 8 * words), axis=1, bitorder="little")
    planes = np.packbits(np.pad(bits, ((0, -m % 64), (0, 0))).T.copy(), axis=1, bitorder="little").view(np.uint64)
    end = np.packbits(np.arange(planes.shape[1] * 64) < m, bitorder="little").view(np.uint64)
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    at = np.arange(len(probes))
    ones = ~np.uint64(0)
    out = np.zeros((len(probes), planes.shape[1]), dtype=np.uint64)
    counters = [np.full(out.shape, ones if start >> k & 1 else np.uint64(0)) for k in range(width)]
    over = np.broadcast_to(~end, out.shape).copy()
    for b, plane in enumerate(planes):
        carry = plane[None, :] ^ np.where((probes[at, b // 64] >> np.uint64(b % 64)) & np.uint64(1) == 1, ones, np.uint64(0))[:, None]
        for k, c in enumerate(counters):
            counters[k] = c ^ carry
            carry = carry & c
            if b % 4 and not carry.any():
                break
        else:
            over |= carry
        if b > radius and b % 16 == 0 and (gone := (over == ones).all(axis=1)).any():
            at, over, counters = at[~gone], over[~gone], [c[~gone] for c in counters]
            if not len(at):
                break
    out[at] = ~over
    return np.unpackbits(out.view(np.uint8), axis=1, bitorder="little")[:, :m].astype(bool)


def forest(left: np.ndarray, right: np.ndarray, hit: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the graph whose edges are left[i] - right[j] where hit[i, j]."""
    new_left, new_right = hit.any(axis=1), hit.any(axis=0)
    same = left is right
    for seed in np.flatnonzero(new_left).tolist():
        if not new_left[seed]:
            continue
        new_left[seed] = False
        if same:
            new_right[seed] = False
        stack = [(seed, True)]
        while stack:
            i, is_left = stack.pop()
            # Not yet reached members that i has an edge to.
            reach = np.flatnonzero(hit[i] & new_right) if is_left else np.flatnonzero(hit[:, i] & new_left)
            if same:
                reach = np.flatnonzero((hit[i] | hit[:, i]) & new_right)
            for j in reach.tolist():
                yield (int(left[i]), int(right[j])) if is_left else (int(left[j]), int(right[i]))
                stack.append((j, same or not is_left))
            if is_left:
                new_right[reach] = False
            else:
                new_left[reach] = False
            if same:
                new_left[reach] = False


def fitting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sizes allow the similarity."""
    a, b = a.astype(np.int64)[:, None], b.astype(np.int64)[None, :]
    return (a * 4 <= b * 5) & (b * 4 <= a * 5)


def screened(n: np.ndarray, fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left x right: pairs of fitting sizes whose fingerprints are close or whose sets are small."""
    hit = fitting(n[left], n[right])
    if left is right:
        hit &= ~np.eye(len(left), dtype=bool)
    rows = np.flatnonzero(hit.any(axis=1))
    if len(rows):
        hit[rows] &= close(fp[left[rows]], fp[right]) | (n[left[rows]] < SMALL)[:, None] | (n[right] < SMALL)[None, :]
    return hit


def block_candidates(n: np.ndarray, fp: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of a block that the screen leaves; of two tiles, members meet the other tile's only."""
    if side is None and len(n) <= FEW:
        root, size, words = list(range(len(n))), n.tolist(), [int.from_bytes(x.tobytes(), "little") for x in fp]
        for j in range(1, len(size)):
            for i in range(j):
                if root[i] != root[j] and size[j] * 4 <= size[i] * 5 and size[i] * 4 <= size[j] * 5 and (min(size[i], size[j]) < SMALL or (words[i] ^ words[j]).bit_count() <= RADIUS):
                    x, y = root[i], root[j]
                    root = [x if r == y else r for r in root]
                    yield i, j
        return
    left, right = _sides(n, side)
    if len(left) and len(right):
        yield from forest(left, right, screened(n, fp, left, right))


def _sides(n: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if side is None:
        both = np.arange(len(n))
        return both, both
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def similar_pairs(n: np.ndarray, fp: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of a tile, or across two, of similarity ``SIMILARITY`` or more."""
    left, right = _sides(n, side)
    if not len(left) or not len(right):
        return
    hit = screened(n, fp, left, right)
    if not hit.any():
        return
    known, at = np.unique(np.concatenate(sets), return_inverse=True)
    if len(sets) * len(known) <= DENSE:
        grid = np.zeros((len(sets), len(known)), dtype=np.float32)
        grid[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), at] = 1
        both = (grid[left] @ grid[right].T).astype(np.int64)
    else:
        both = np.zeros(hit.shape, dtype=np.int64)
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(hit) if left is right else hit)), strict=True):
            both[i, j] = len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True))
            if left is right:
                both[j, i] = both[i, j]
    least = Fraction(str(SIMILARITY))
    total = n[left].astype(np.int64)[:, None] + n[right].astype(np.int64)[None, :]
    yield from forest(left, right, hit & (both * least.denominator >= (total - both) * least.numerator))


def dealt_pairs(members: DataFrame, key: str, tile: int, compare, columns: list[str]) -> DataFrame:
    """(a, b): the edges that ``compare(columns..., side)`` finds among the members of each key, dealt by pairs of tiles."""
    sizes = members.groupBy(key).agg(F.count("*").alias("m")).filter("m > 1")
    # Written, so that the join deals both sides anew and the members of a hot key can be split.
    sizes = materialize(sizes.select(key, F.ceil(F.col("m") / tile).cast("int").alias("tiles")), "near-sizes")
    placed = members.join(sizes, key).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles").cast("long")).cast("int"))
    dealt = placed.select(key, "tile", "node", *columns, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select(key, F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"), F.when(F.col("tile") <= F.col("other"), 0).otherwise(1).alias("side"), "node", *columns)
    keys = [key, "ta", "tb"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "node")

    def run(batches):
        release_worker()
        held: list[pa.RecordBatch] = []
        out: list[tuple[int, int]] = []

        def batch():
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])
            out.clear()

        def done():
            if sum(map(len, held)) > 1:
                t = pa.Table.from_batches(held)
                two = t.column("ta")[0].as_py() != t.column("tb")[0].as_py()
                node = t.column("node").to_numpy()
                out.extend((int(node[i]), int(node[j])) for i, j in compare(t, t.column("side").to_numpy() if two else None))
            held.clear()

        last = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(b):
                continue
            cut = (np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1).tolist()
            for s, e in zip([0, *cut], [*cut, len(b)], strict=True):
                now = tuple(int(c[s]) for c in cols)
                if now != last:
                    done()
                    last = now
                    if len(out) >= 20_000:
                        yield from batch()
                held.append(b.slice(s, e - s))
        done()
        if out:
            yield from batch()

    return dealt.mapInArrow(run, "a long, b long")


def _numbers(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return t.column("n").to_numpy(), np.stack([t.column(f).to_numpy() for f in FP], axis=1).view(np.uint64)


def node_sets(docs: DataFrame, facts: DataFrame, groups: DataFrame, text_col: str) -> DataFrame:
    """(node, n, fingerprint, root, hashes) of the nodes of groups. Only texts that a key filter lets pass are read again."""
    one = materialize(facts.join(groups, "node"), "near-members")
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(one, "text_hash"))  # at most 8 MB

    def some(batches):
        release_worker()
        known = _Hashes()
        seen: set[int] = set()
        for b in batches:
            keys = b.column(0).to_numpy()
            for i in np.flatnonzero(wanted.value.may_hold(keys)).tolist():
                if (k := int(keys[i])) not in seen:
                    seen.add(k)
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([shingle_hashes(b.column(1)[i].as_py(), known).tobytes()], pa.binary())], names=["text_hash", "hashes"])

    def joined(batches):
        held, size = [], 0
        for b in some(batches):
            held.append(b)
            size += b.nbytes
            if size > 4_000_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    read = docs.select(F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(joined, "text_hash long, hashes binary")
    return materialize(read.join(one, "text_hash").drop("text_hash").dropDuplicates(["node"]), "near-sets")


def similar_components(docs: DataFrame, rows: DataFrame, text_col: str) -> DataFrame:
    """(node, root) of all nodes that are linked to another."""
    facts = materialize(rows.groupBy("node").agg(F.min("n").alias("n"), *[F.min(f).alias(f) for f in FP], F.min("text_hash").alias("text_hash")), "near-facts")
    blocks = materialize(shingle_blocks(rows, facts), "near-blocks")
    groups = connected_components(dealt_pairs(blocks, "h", TILE, lambda t, side: block_candidates(*_numbers(t), side), ["n", *FP]))
    sets = node_sets(docs, facts, groups, text_col)

    def exact(t, side):
        return similar_pairs(*_numbers(t), [np.frombuffer(x.as_py(), dtype=np.uint64) for x in t.column("hashes")], side)

    return connected_components(dealt_pairs(sets, "root", GROUP_TILE, exact, ["n", *FP, "hashes"]))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of similar texts: that of the smallest (identifier, text hash)."""
    small_batches(docs.sparkSession)
    rows = materialize(with_prefixes(docs, id_col, text_col), "near-prefixes")
    parts = similar_components(docs, rows, text_col)
    placed = rows.select("doc_id", "text_hash", "node").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")
    kept = placed.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_hash")
    return one_of_each(docs, kept, id_col, text_col)
