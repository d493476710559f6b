"""SimHash near duplicates by bit-sliced comparison.

A fingerprint has 64 bits; those that differ from another in at most three agree with it in one of four 16-bit bands,
so fingerprints meet in buckets of equal bands and no link can be missed. A bucket's fingerprints are stored vertically,
one bit plane per bit position; a probe updates its distance to the whole block with carry-save counters of bitwise
operations and abandons the block once every distance exceeds the radius. Buckets above ``TILE`` distinct fingerprints
are dealt out as pairs of tiles. A block yields only a spanning forest of its links, and components are contracted on the
cluster.

Defined results: null and empty texts have fingerprint zero and link like any other; equal fingerprints are one node
whatever their number; a null identifier never names a component unless nothing else does; empty tables give no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import fresh, materialize, release_worker
from caseledger.llm.graph import connected_components

BITS, RADIUS, BANDS, SEED = 64, 3, 4, 42
#: Distinct fingerprints of one tile; a task compares two tiles at a time.
TILE = 512
_COLUMN = (np.arange(8, dtype=np.int64) * 256)[None, :]
_BIT_OF = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.int64)


def majority(h: np.ndarray) -> int:
    """The fingerprint of 64-bit hashes: a bit is 1 if set in over half of them."""
    by_byte = np.bincount((h.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048).reshape(8, 256)
    bits = (by_byte @ _BIT_OF).ravel() * 2 > len(h)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, shingle: int = 3, _hash=xxhash.xxh64_intdigest) -> int:
    """The unsigned fingerprint of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return _hash(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return majority(np.fromiter((_hash(g, SEED) for g in grams), dtype="<u8", count=len(words) - shingle + 1))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp signed long) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches):
        release_worker()
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def bit_planes(fps: np.ndarray) -> list[int]:
    """Plane b holds bit b of every fingerprint, member i at bit i."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [int.from_bytes(p.tobytes(), "little") for p in packed]


def within(planes: list[int], probe: int, full: int, radius: int = RADIUS) -> int:
    """Members of ``full`` within the radius of the probe, as a bit set; 0 as soon as all of them exceed it.

    Bit i of counter plane k is bit k of member i's count. Counts start so high that the carry out of the last plane
    says that a distance has passed the radius.
    """
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [full if start >> k & 1 else 0 for k in range(width)]
    over = 0
    for b, plane in enumerate(planes):
        carry = (plane ^ full if probe >> b & 1 else plane) & full
        for k in range(width):
            c = counters[k]
            counters[k] = c ^ carry
            carry &= c
            if not carry:
                break
        else:
            over |= carry
            if over == full:
                return 0
    return full & ~over


def block_links(fps: np.ndarray, left: int) -> Iterator[tuple[int, int]]:
    """Spanning forest, as (member, root), of the links of a block; members from ``left`` on are a second tile."""
    planes, full = bit_planes(fps), (1 << len(fps)) - 1
    root = list(range(len(fps)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    later = full
    for i, fp in enumerate(fps[:left].tolist()):
        later &= ~(1 << i)
        found = within(planes, fp, later) if later else 0
        while found:
            low = found & -found
            a, b = top(i), top(low.bit_length() - 1)
            if a != b:
                root[max(a, b)] = min(a, b)
            found ^= low
    for i in range(len(fps)):
        if (r := top(i)) != i:
            yield i, r


def near_links(fps: DataFrame) -> DataFrame:
    """(a, b): links that span every component of fingerprints within the radius. fps: distinct ``fp``."""
    width = BITS // BANDS
    banded = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1)).alias("value")) for i in range(BANDS)])).alias("x")).select("fp", "x.band", "x.value")
    sizes = banded.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    placed = banded.join(sizes, ["band", "value"]).withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")).cast("int"))
    dealt = placed.select("fp", "band", "value", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("fp", "band", "value", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"), F.when(F.col("tile") <= F.col("other"), 0).otherwise(1).alias("side"))
    keys = ["band", "value", "ta", "tb"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "fp")

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        now = None

        def flush():
            fp = np.concatenate([x for x, _ in held])
            side = np.concatenate([x for _, x in held])
            if len(fp) < 2:
                return
            two = now[2] != now[3]
            for i, r in block_links(fp.view(np.uint64), int((side == 0).sum()) if two and len(fp) > TILE else len(fp)):
                yield int(fp[i]), int(fp[r])

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (*keys, "fp", "side")]
            if not len(cols[0]):
                continue
            cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            links: list[tuple[int, int]] = []
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(cols[0])], strict=True):
                key = tuple(int(c[s]) for c in cols[:4])
                if key != now:
                    if held:
                        links += flush()
                    held, now = [], key
                held.append((cols[4][s:e], cols[5][s:e]))
            if links:
                yield pa.RecordBatch.from_pydict({"a": [x for x, _ in links], "b": [x for _, x in links]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        if held and (links := list(flush())):
            yield pa.RecordBatch.from_pydict({"a": [x for x, _ in links], "b": [x for _, x in links]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every row; the component is named by its smallest identifier."""
    rows = materialize(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    parts = connected_components(near_links(nodes.select("fp")))
    placed = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    component = placed.join(named, "root").select("fp", "component_id")
    return rows.join(component, "fp")


def one_of_each(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that ``kept`` (doc_id, text_hash) names, one of those equal in both; all columns stay.

    Identifier and hash are columns on both sides, so that the join and the removal of repeated rows share one exchange.
    """
    ident, digest, null = fresh(docs, "_id", "_th", "_null")
    keyed = docs.withColumns({ident: F.coalesce(F.col(id_col).cast("long"), F.lit(0)), null: F.col(id_col).isNull(), digest: F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))})
    named = kept.select(F.coalesce("doc_id", F.lit(0)).alias(ident), F.col("doc_id").isNull().alias(null), F.coalesce("text_hash", F.lit(0)).alias(digest))
    return keyed.join(named, [ident, null, digest], "left_semi").dropDuplicates([ident, null, digest]).select(*docs.columns)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """docs with one row of each component: that of the smallest (identifier, text hash); other columns stay."""
    classes = near_duplicate_classes(docs, id_col, text_col, shingle)
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "text_hash")
    # A component without any identifier is told apart by its fingerprint.
    key = [F.coalesce(F.col("component_id"), F.col("fp")).alias("c"), F.col("component_id").isNull().alias("u")]
    kept = classes.groupBy(*key).agg(F.min(order).alias("k")).select("k.doc_id", "k.text_hash")
    return one_of_each(docs, kept, id_col, text_col)
