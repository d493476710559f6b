"""Media columns: content-defined chunking of payloads into a deduplicated store, and verified reconstruction.

A payload is a text's UTF-8 bytes, padded with zero bytes to a positive multiple of 64, taken as 8-bit samples. A
rolling gear hash over the last 32 bytes cuts it where the hash's high bits are zero, between ``LEAST`` and ``MOST``
bytes. Chunks are known by their SHA-256. Spark joins find digests that occur at several places, name the first place
(by text digest and index) their owner, and tell every container which of its chunks to leave out. A container is one
binary value of the store: the ordered chunk list (sizes and digests), the numbers of the chunks that others own, and the
packed samples of its own. Reading back, owned chunks are at hand; the others are joined in by digest, each is verified,
and the ordered list gives the payload. ``media_bytes`` and ``media_sha256`` are those of the container as read back.

Texts without shared chunks or copies elsewhere go into the store from the task that reads them. Only the others, which a
key filter of bounded size picks out (it misses none and lets a few more pass), are shuffled.

Defined results: null and empty texts are 64 zero bytes; rows with equal texts share one container and get equal
values, repeated rows and null identifiers included; a digest that does not verify raises; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import key_filter, materialize, release_worker, shared_path, small_batches

UNIT = 64
LEAST, MOST = 256, 16_384
#: One cut in 2,048 bytes on average: the hash's eleven high bits.
MASK = np.uint32(0xFFE00000)
LEVEL = 12
MAGIC = b"CLM2"


def _gear() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def padded(raw: bytes) -> bytes:
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def payload(text: str | None) -> bytes:
    return padded((text or "").encode("utf-8", "surrogatepass"))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks, the last at the payload's end. hash(i) = sum of gear[data[i - k]] << k over 32 bytes."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < 32:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    ends, start = [], 0
    for at in (np.flatnonzero(h & MASK == 0) + 1).tolist():
        while at - start > MOST:
            start += MOST
            ends.append(start)
        if at - start >= LEAST:
            ends.append(at)
            start = at
    while len(data) - start > MOST:
        start += MOST
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


_HEAD = struct.Struct("<4sQII")


def write_media(n_bytes: int, parts: list[bytes], foreign: list[int], pack) -> bytes:
    """A container: head, sizes and digests of all chunks, the numbers of foreign ones, the packed samples of the others."""
    out = set(foreign)
    sizes, digests = np.array([len(p) for p in parts], "<u4").tobytes(), b"".join(hashlib.sha256(p).digest() for p in parts)
    own = pack(b"".join(p for i, p in enumerate(parts) if i not in out))
    return b"".join([_HEAD.pack(MAGIC, n_bytes, len(parts), len(out)), sizes, digests, np.array(sorted(out), "<u4").tobytes(), own])


def read_media(media: bytes, unpack) -> tuple[int, list[bytes], list[bytes | None], list[int]]:
    """(n_bytes, digests, chunks with None where foreign, foreign numbers) of a container; its own chunks are verified."""
    magic, n_bytes, n, m = _HEAD.unpack_from(media)
    if magic != MAGIC:
        raise ValueError("not a media container")
    at = _HEAD.size
    sizes = np.frombuffer(media, "<u4", n, at).tolist()
    digests = [media[at + 4 * n + 32 * i : at + 4 * n + 32 * i + 32] for i in range(n)]
    foreign = np.frombuffer(media, "<u4", m, at + 36 * n).tolist()
    own, done, parts, out = unpack(media[at + 36 * n + 4 * m :]), 0, [], set(foreign)
    for i, size in enumerate(sizes):
        if i in out:
            parts.append(None)
            continue
        part = own[done : done + size]
        done += size
        if hashlib.sha256(part).digest() != digests[i]:
            raise ValueError("a stored chunk does not match its digest")
        parts.append(part)
    return n_bytes, digests, parts, foreign


def feature(data: bytes, n_chunks: int) -> str:
    """Facts of the samples: chunks, sum, sum of squares, crossings of the mid level, 16-bin histogram."""
    x = np.frombuffer(data, np.uint8)
    y = x.astype(np.int64)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"chunks={n_chunks};sum={int(y.sum())};squares={int((y * y).sum())};crossings={crossings};hist=" + ",".join(map(str, np.bincount(x >> 4, minlength=16).tolist()))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and the text's identity: 128 bits of its SHA-256, which no crafted text can share."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)).alias("tid"))


def _first_of_task(batches, column: int):
    """Batches without the rows whose key an earlier row of the task had: copies cost one row a task."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for i, t in enumerate(b.column(column).to_pylist()):
            if t not in seen:
                seen.add(t)
                keep.append(i)
        if keep:
            yield b.take(pa.array(keep, pa.int64()))


CONTAINER = "tid binary, n_foreign int, lent binary, media binary"
_CONTAINER = pa.schema([("tid", pa.binary()), ("n_foreign", pa.int32()), ("lent", pa.binary()), ("media", pa.binary())])
FEATURES = "tid binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_chunks int, n_foreign int"
_FEATURES = pa.schema([("tid", pa.binary()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("n_chunks", pa.int32()), ("n_foreign", pa.int32())])


def _rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def store_payloads(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the container table to ``path``; returns what it reads back as."""
    texts = _keyed(docs, id_col, text_col).select("tid", "text", F.xxhash64("tid").alias("key"))

    def digests(batches):
        release_worker()
        for b in _first_of_task(batches, 0):
            tid, idx, dig = [], [], []
            for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for i, c in enumerate(chunks(payload(text))):
                    tid.append(t)
                    idx.append(i)
                    dig.append(hashlib.sha256(c).digest()[:16])
            yield pa.RecordBatch.from_arrays([pa.array(tid, pa.binary()), pa.array(idx, pa.int32()), pa.array(dig, pa.binary())], names=["tid", "idx", "digest"])

    # 128 bits of a digest name a chunk in shuffles; the store keeps all 256 and verifies them.
    places = materialize(texts.mapInArrow(digests, "tid binary, idx int, digest binary"), "chunk-places")
    # The same payload seen in two tasks gives equal places, whose least and greatest hash are one.
    where = F.struct("tid", "idx")
    known = F.xxhash64("tid", "idx")
    shared = places.groupBy("digest").agg(F.min(where).alias("owner"), F.min(known).alias("lo"), F.max(known).alias("hi")).filter("lo <> hi").select("digest", "owner")
    refs = places.join(shared, "digest").select("tid", "idx", (F.col("owner") == where).alias("lends"))
    marks = materialize(refs.groupBy("tid").agg(F.collect_set(F.when(F.col("lends"), F.col("idx"))).alias("lent"), F.collect_set(F.when(~F.col("lends"), F.col("idx"))).alias("foreign")), "chunk-marks")
    again = places.filter("idx = 0").groupBy("tid").agg(F.count("*").alias("n")).filter("n > 1").select("tid")
    routed = docs.sparkSession.sparkContext.broadcast(key_filter(marks.select("tid").unionAll(again).select(F.xxhash64("tid").alias("key")), "key"))  # at most 8 MB

    def dealt(batches, take: bool):
        for b in _first_of_task(batches, 0):
            hit = routed.value.may_hold(b.column(2).to_numpy())
            part = b.filter(pa.array(hit if take else ~hit))
            if len(part):
                yield part

    def contain(rows):
        z = zstandard.ZstdCompressor(level=LEVEL)
        held, size = [], 0
        for t, raw, lent, foreign in rows:
            media = write_media(len(raw), chunks(padded(raw)), foreign or [], z.compress)
            held.append((t, len(foreign or ()), np.array(sorted(lent or ()), "<u4").tobytes(), media))
            size += len(media)
            if size > 4_000_000:
                yield _rows_to_batch(held, _CONTAINER)
                held, size = [], 0
        if held:
            yield _rows_to_batch(held, _CONTAINER)

    def straight(batches):
        release_worker()
        yield from contain((t, text.encode("utf-8", "surrogatepass"), None, None) for b in dealt(batches, False) for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))

    def packed(batches):
        release_worker()
        z = zstandard.ZstdCompressor(level=LEVEL)
        for b in dealt(batches, True):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([z.compress(t.encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()], pa.binary())], names=["tid", "z"])

    def marked(batches):
        release_worker()
        d = zstandard.ZstdDecompressor()
        yield from contain((t, d.decompress(z), lent, foreign) for b in batches for t, z, lent, foreign in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))

    # An aggregate, not a look at the task's rows: copies of a text from many tasks leave one, however the join is split.
    one = texts.mapInArrow(packed, "tid binary, z binary").groupBy("tid").agg(F.any_value("z").alias("z"))
    moved = one.join(marks.hint("shuffle_hash"), "tid", "left").select("tid", "z", "lent", "foreign").mapInArrow(marked, CONTAINER)
    texts.mapInArrow(straight, CONTAINER).unionAll(moved).write.option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(CONTAINER).parquet(path)


def read_payloads(store: DataFrame, emit, ddl: str, schema: pa.Schema) -> DataFrame:
    """``emit(tid, n_bytes, parts, media, n_foreign)`` -> row, over every reconstructed payload of the store."""

    def lend(batches):
        release_worker()
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            dig, part = [], []
            for lent, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, digests, parts, _ = read_media(media, unpack)
                for i in np.frombuffer(lent, "<u4").tolist():
                    dig.append(digests[i])
                    part.append(parts[i])
            if dig:
                yield pa.RecordBatch.from_arrays([pa.array(dig, pa.binary()), pa.array(part, pa.binary())], names=["digest", "part"])

    def want(batches):
        release_worker()
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            tid, idx, dig = [], [], []
            for t, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, digests, _, foreign = read_media(media, unpack)
                tid += [t] * len(foreign)
                idx += foreign
                dig += [digests[i] for i in foreign]
            yield pa.RecordBatch.from_arrays([pa.array(tid, pa.binary()), pa.array(idx, pa.int32()), pa.array(dig, pa.binary())], names=["tid", "idx", "digest"])

    lent = store.filter(F.octet_length("lent") > 0).select("lent", "media").mapInArrow(lend, "digest binary, part binary")
    wanted = store.filter("n_foreign > 0").select("tid", "media").mapInArrow(want, "tid binary, idx int, digest binary")
    came = wanted.join(lent, "digest").groupBy("tid").agg(F.collect_list(F.struct("idx", "part")).alias("came"))  # one payload's chunks

    def finish(batches):
        release_worker()
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            rows = []
            for tid, media, more in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist() if b.num_columns > 2 else [None] * len(b), strict=True):
                n_bytes, digests, parts, foreign = read_media(media, unpack)
                for c in more or ():
                    if hashlib.sha256(c["part"]).digest() != digests[c["idx"]]:
                        raise ValueError("a joined chunk does not match its digest")
                    parts[c["idx"]] = c["part"]
                if any(p is None for p in parts):
                    raise ValueError("a chunk is missing from the store")
                rows.append(emit(tid, n_bytes, parts, media, len(foreign)))
            if rows:
                yield _rows_to_batch(rows, schema)

    alone = store.filter("n_foreign = 0").select("tid", "media").mapInArrow(finish, ddl)
    joined = store.filter("n_foreign > 0").select("tid", "media").join(came, "tid", "left").mapInArrow(finish, ddl)
    return alone.unionAll(joined)


def _facts(tid: bytes, n_bytes: int, parts: list[bytes], media: bytes, n_foreign: int) -> tuple:
    data = b"".join(parts)
    return tid, n_bytes, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(data, len(parts)), len(parts), n_foreign


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Store every payload, read the stored bytes back and return their facts for every row."""
    store = store_payloads(docs, path or shared_path(docs.sparkSession, "media"), id_col, text_col)
    facts = read_payloads(store, _facts, FEATURES, _FEATURES)
    return _keyed(docs, id_col, text_col).select("doc_id", "tid").join(facts, "tid").drop("tid")
