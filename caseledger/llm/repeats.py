"""Exact removal of repeated passages by a distributed merge sort of suffixes that never compares a known prefix again.

Every byte covered by a string of ``LENGTH`` bytes that starts at two places or more goes. Suffixes are taken at
anchors only: the positions whose 16-byte hash is the least of some window of ``WINDOW`` positions. The choice depends
on the window alone, so both places of a repeated string have the same anchor within its first ``WINDOW`` positions, and
the ``CORE`` bytes that follow that anchor lie inside the string. Hence:

1. Anchors' core hashes are counted; anchors whose core occurs once are done.
2. The others become suffixes: the core, front-coded once and for all as its 128-bit digest, the bytes after it and,
   beside it, the bytes before the anchor. Each task sorts its suffixes into runs, front-codes them (shared length and
   the rest) and sends every run to its digest range. There, a loser tree merges the runs: each contestant carries the
   length it shares with the last winner, a longer shared length wins without looking at a byte, and bytes are compared
   only beyond it. The merge so yields the order and the shared lengths at once.
3. In a class of equal cores a string at offset o before the anchor is repeated if two members agree in o bytes to the
   left and LENGTH - o to the right. Small classes compare pairs; those of more than ``PAIRS`` members number, for every
   o, the classes of equal left and right parts and look for two members with both numbers equal: work in proportion to
   members, not pairs.
4. Cores with more than ``hot`` members never meet in a task: their strings are hashed at each o and counted by
   partial aggregation instead, which gives the same strings.

Exact copies are collapsed first, in each map task and then by text, so thousands of copies cost one.

Defined results: null is the empty text; texts under LENGTH bytes lose nothing; a text with an exact copy (another row,
or the same row repeated) of at least LENGTH bytes goes as a whole; null or repeated identifiers do not matter, since
rows are told apart by text; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import fresh, key_filter, materialize, release_worker, small_batches

LENGTH, WINDOW, GRAM = 400, 240, 16
CORE = LENGTH - WINDOW + 1
SIDE = WINDOW - 1
#: Bytes of a word's code where passages are matched by words.
CODE = 6
DIGEST = 16
#: A class of equal cores with more members than this is counted by hashes of strings.
HOT = 20_000
#: Up to so many members a class is compared by pairs, as arrays.
PAIRS = 256
RUN_ITEMS = 50_000
_MIX = np.array([(i * 0x9E3779B1 + 0x7F4A7C15) & 0xFFFFFFFF for i in range(256)], dtype=np.uint32)
_MIX ^= _MIX >> np.uint32(15)
_MIX *= np.uint32(0x85EBCA6B)
_MIX ^= _MIX >> np.uint32(13)


def _slide(a: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        a = best(a[:-done], a[done:])
        done *= 2
    return best(a[: len(a) - (width - done)], a[width - done :]) if done < width else a


def window_of(length: int) -> int:
    """WINDOW in proportion to the length."""
    return length * WINDOW // LENGTH


def sides(length: int, unit: int = 1, window: int | None = None) -> tuple[int, int]:
    """(bytes that may stand before an anchor, bytes of a core): an anchor is one of the first window positions of a string."""
    side = ((window or window_of(length) // unit) - 1) * unit
    return side, length - side


def anchors(b: np.ndarray, length: int = LENGTH, unit: int = 1, window: int | None = None) -> np.ndarray:
    """Anchor positions of a text's bytes that a whole core follows; of every ``unit`` bytes the first may be one.

    window: how many neighbouring positions an anchor is the least of, by default in proportion to the length."""
    if len(b) < length:
        return np.zeros(0, dtype=np.int64)
    h, gram = (_MIX[b], GRAM) if unit == 1 else (np.ascontiguousarray(b.reshape(-1, unit)[:, :4]).view("<u4").ravel(), 4)
    window = window or window_of(length) // unit
    core = sides(length, unit, window)[1] // unit
    n, k, mult = len(h), 1, 0x01000193
    while k < gram:
        h = h[:-k] * np.uint32(mult) + h[k:]
        k, mult = k * 2, mult * mult & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(13)
    low = _slide(h, window, np.minimum)
    pad = np.zeros(window - 1, dtype=np.uint32)
    at = np.flatnonzero(h == _slide(np.concatenate([pad, low, pad]), window, np.maximum))
    return at[at + core <= n] * unit


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    m = min(len(a), len(b))
    x = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
    return m - (x.bit_length() + 7) // 8


class Run:
    """A front-coded sorted run: a cursor that rebuilds one key at a time."""

    def __init__(self, lcp, rest_len, rest, left_len, left, tids, tid_at, pos):
        z = zstandard.ZstdDecompressor()
        self.lcp, self.rest_len = np.frombuffer(lcp, "<u2").tolist(), np.frombuffer(rest_len, "<u2").tolist()
        self.left_len, self.pos = np.frombuffer(left_len, "u1").tolist(), np.frombuffer(pos, "<u4").tolist()
        self.tid_at, self.tids = np.frombuffer(tid_at, "<u4").tolist(), tids
        self.rest, self.left = z.decompress(rest), z.decompress(left)
        self.i = self.r = self.s = 0
        self.key: bytes | None = b""
        self.advance()

    def advance(self) -> int:
        """Move to the next key; the length it shares with the one before, or -1 at the end."""
        i = self.i
        if i == len(self.lcp):
            self.key = None
            return -1
        self.i = i + 1
        n = self.lcp[i]
        self.key = self.key[:n] + self.rest[self.r : self.r + self.rest_len[i]]
        self.r += self.rest_len[i]
        self.before = self.left[self.s : self.s + self.left_len[i]]
        self.s += self.left_len[i]
        self.where = (self.tids[16 * self.tid_at[i] : 16 * self.tid_at[i] + 16], self.pos[i])
        return n


def encode_run(items: list[tuple[bytes, bytes, bytes, int]]) -> dict:
    """Sort (key, left, tid, position) and front-code."""
    items.sort()
    lcp, rest, last, index = [], [], b"", {}
    for key, *_ in items:
        n = shared(last, key)
        lcp.append(n)
        rest.append(key[n:])
        last = key
    z = zstandard.ZstdCompressor(level=3)
    return {
        "lcp": np.array(lcp, "<u2").tobytes(),
        "rest_len": np.array([len(r) for r in rest], "<u2").tobytes(),
        "rest": z.compress(b"".join(rest)),
        "left_len": np.array([len(x[1]) for x in items], "u1").tobytes(),
        "left": z.compress(b"".join(x[1] for x in items)),
        "tid_at": np.array([index.setdefault(x[2], len(index)) for x in items], "<u4").tobytes(),
        "tids": b"".join(index),
        "pos": np.array([x[3] for x in items], "<u4").tobytes(),
    }


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, bytes, tuple[bytes, int]]]:
    """(length shared with the key before, left bytes, place) in key order, by a loser tree that knows shared lengths."""
    k = 1
    while k < len(runs):
        k *= 2
    lcp = [0 if i < len(runs) and runs[i].key is not None else -1 for i in range(k)]

    def beats(a: int, b: int) -> bool:
        """Whether a comes first; both shared lengths count from the last winner. The loser's is then from the winner."""
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return la > lb
        if la < 0:
            return True
        x, y = runs[a].key, runs[b].key
        n = la + shared(x[la:], y[la:])
        first = x[n:] <= y[n:]
        lcp[b if first else a] = n
        return first

    losers = [0] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        first = beats(a, b)
        losers[node] = b if first else a
        return a if first else b

    best = play(1) if k > 1 else 0
    while lcp[best] >= 0:
        run = runs[best]
        yield lcp[best], run.before, run.where
        lcp[best] = run.advance()
        node = (best + k) >> 1
        while node:
            other = losers[node]
            if not beats(best, other):
                losers[node], best = best, other
            node >>= 1


def _lcp(step: np.ndarray) -> np.ndarray:
    """Shared lengths of all pairs of a sorted list, above the diagonal, from those of neighbours."""
    m = len(step)
    return np.minimum.accumulate(np.where(np.arange(m)[None, :] > np.arange(m)[:, None], step[None, :], np.iinfo(np.int32).max), axis=1)


def _by_pairs(rr: np.ndarray, ll: np.ndarray, place: np.ndarray, side: int) -> np.ndarray:
    """valid[o + 1, i]: whether some other member agrees with i in o bytes to the left and side - o to the right."""
    m = len(rr)
    i, j = np.triu_indices(m, 1)
    low = side - _lcp(rr)[i, j]
    a, b = place[i], place[j]
    high = _lcp(ll)[np.minimum(a, b), np.maximum(a, b)]
    hit = high >= low
    low, high, at = np.tile(low[hit], 2), np.tile(high[hit], 2), np.concatenate([i[hit], j[hit]])
    change = np.bincount((low + 1) * m + at, minlength=(side + 3) * m) - np.bincount((high + 2) * m + at, minlength=(side + 3) * m)
    return np.cumsum(change.reshape(side + 3, m), axis=0)[: side + 2] > 0


def class_strings(right: list[int], lefts: list[bytes], side: int = SIDE) -> list[tuple[int, int, int]]:
    """(member, least o, greatest o) of the repeated strings of a class of equal cores.

    right[i]: bytes after the core that member i shares with member i - 1, members in order of those bytes; lefts: the
    bytes before the anchors, backwards.
    """
    m = len(lefts)
    if m == 2:
        low, high = side - right[1], shared(lefts[0], lefts[1])
        return [(0, low, high), (1, low, high)] if high >= low else []
    order = sorted(range(m), key=lefts.__getitem__)
    ll = np.array([0] + [shared(lefts[order[i - 1]], lefts[order[i]]) for i in range(1, m)])
    rr, place = np.array(right), np.empty(m, dtype=np.int64)
    place[order] = np.arange(m)
    if m <= PAIRS:
        valid = _by_pairs(rr, ll, place, side)
    else:
        valid = np.zeros((side + 2, m), dtype=bool)
        for o in range(side + 1):
            new_r, new_l = rr < side - o, ll < o
            new_r[0] = new_l[0] = True
            both = np.cumsum(new_r) * (m + 1) + np.cumsum(new_l)[place]
            _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
            valid[o + 1] = counts[inverse] > 1
    edge = np.diff(np.concatenate([valid, np.zeros((1, m), dtype=bool)]).astype(np.int8), axis=0)
    starts, ends = np.nonzero(edge.T == 1), np.nonzero(edge.T == -1)
    return [(int(i), int(a), int(b) - 1) for i, a, b in zip(starts[0], starts[1], ends[1], strict=True)]


def _first_texts(batches, view=None, wanted=None, own: int | None = None) -> Iterator[tuple[int, bytes, bytes, bytes, int, pa.RecordBatch]]:
    """(key, tid, text bytes, what view makes of them, row, batch) of the first row of each text in a task.

    Columns: key, tid, text. wanted: a broadcast filter of keys; view may give None for texts to leave out; own: a column
    that has to hold the tid as well (rows that were joined by key alone).
    """
    seen: set[bytes] = set()
    for b in batches:
        keys = b.column(0).to_numpy()
        rows = np.flatnonzero(wanted.value.may_hold(keys)) if wanted is not None else np.arange(len(b))
        texts, tids = b.column(2).cast(pa.binary()), b.column(1)
        for i in rows.tolist():
            t = tids[i].as_py()
            if t not in seen and (own is None or b.column(own)[i].as_py() == t):
                seen.add(t)
                raw = texts[i].as_py()
                made = view(raw) if view else raw
                if made is not None:
                    yield int(keys[i]), t, raw, made, i, b


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


RUN_SCHEMA = pa.schema([("bucket", pa.int32()), *[(n, pa.binary()) for n in ("lcp", "rest_len", "rest", "left_len", "left", "tids", "tid_at", "pos")]])
RUN_DDL = "bucket int, lcp binary, rest_len binary, rest binary, left_len binary, left binary, tids binary, tid_at binary, pos binary"
SPAN_SCHEMA = pa.schema([("tid", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])


TEXT_DDL = "key long, tid binary, text binary"
_TEXT = pa.schema([("key", pa.int64()), ("tid", pa.binary()), ("text", pa.binary())])


def _sized(rows: Iterator[tuple], schema: pa.Schema, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose last value is a text, of about ``most`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size >= most:
            yield from _batched(iter(held), schema)
            held, size = [], 0
    yield from _batched(iter(held), schema)


def wanted_texts(texts: DataFrame, keys: DataFrame, view=None) -> DataFrame:
    """(key, tid, text) of the texts whose key is in ``keys`` (a filter lets few others pass), dealt by key.

    view makes the text that goes on. Each task sends a text once. They are dealt by an exchange that adaptive execution
    never splits, so all copies of a text meet in one task, which drops all but the first.
    """
    wanted = texts.sparkSession.sparkContext.broadcast(key_filter(keys, "key"))  # at most 8 MB

    def some(batches):
        release_worker()
        make = view() if view else None
        yield from _sized(((key, tid, made) for key, tid, _, made, *_ in _first_texts(batches, make, wanted)), _TEXT)

    return texts.mapInArrow(some, TEXT_DDL).repartition("key")


def repeated_spans(texts: DataFrame, hot: int = HOT, length: int = LENGTH, view=None, unit: int = 1) -> DataFrame:
    """(tid, start, end) of repeated strings. texts: key, tid, text; copies may repeat; key is a hash of tid.

    view: makes, once a task, the function that gives the bytes to search from a text's (None: leave the text out); unit:
    bytes of its symbols, at whose starts alone strings matter.
    """
    spark = texts.sparkSession
    side, core = sides(length, unit)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cores(batches):
        release_worker()
        held, n = [], 0
        for key, _, _, raw, *_ in _first_texts(batches, view() if view else None):
            at = anchors(np.frombuffer(raw, np.uint8), length, unit)
            if len(at):
                h = np.fromiter((xxhash.xxh64_intdigest(raw[p : p + core]) for p in at.tolist()), dtype=np.uint64, count=len(at)).view(np.int64)
                held.append((h, np.full(len(at), key, dtype=np.int64), at.astype(np.int32)))
                n += len(at)
            if n > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["h", "key", "pos"])
                held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["h", "key", "pos"])

    found = materialize(texts.mapInArrow(cores, "h long, key long, pos int"), "anchors")
    # A core that only recurs as a copy of its own text costs a look, not a wrong answer.
    # Written, so that the join deals both sides anew and a core that a third of the texts share can be split.
    counts = materialize(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "cores")
    cand = found.join(counts, "h").groupBy("key").agg(F.collect_set(F.when(F.col("n") <= hot, F.col("pos"))).alias("at"), F.collect_set(F.when(F.col("n") > hot, F.col("pos"))).alias("hot_at"))
    cand = materialize(cand, "suffix-places")

    def placed(column: str) -> DataFrame:
        own = cand.filter(F.size(column) > 0)
        return wanted_texts(texts, own, view).join(own.hint("shuffle_hash"), "key").select("key", "tid", "text", F.col(column).alias("at"))


    def runs(batches):
        release_worker()
        held: list[list] = [[] for _ in range(buckets)]
        n = 0

        def flush():
            for k, items in enumerate(held):
                if items:
                    r = encode_run(items)
                    yield (k, *(r[f.name] for f in list(RUN_SCHEMA)[1:]))

        def rows():
            nonlocal held, n
            for _, tid, raw, _, i, b in _first_texts(batches):
                for p in b.column(3)[i].as_py():
                    if p + core > len(raw):
                        continue
                    digest = hashlib.sha256(raw[p : p + core]).digest()[:DIGEST]
                    held[int.from_bytes(digest[:4], "big") * buckets >> 32].append((digest + raw[p + core : p + length], raw[max(0, p - side) : p][::-1], tid, p))
                    n += 1
                if n >= RUN_ITEMS:
                    yield from flush()
                    held, n = [[] for _ in range(buckets)], 0
            yield from flush()

        yield from _batched(rows(), RUN_SCHEMA, 64)

    dealt = placed("at").mapInArrow(runs, RUN_DDL).repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def merged(batches):
        release_worker()

        def classes():
            now, held = None, []
            for b in batches:
                for row in b.to_pylist():
                    k = row.pop("bucket")
                    if k != now and held:
                        yield from strings(held)
                        held = []
                    now = k
                    held.append(Run(**row))
            if held:
                yield from strings(held)

        def strings(held):
            right: list[int] = []
            lefts: list[bytes] = []
            places: list[tuple[bytes, int]] = []

            def close():
                if len(places) > 1:
                    for i, low, high in class_strings(right, lefts, side):
                        tid, p = places[i]
                        yield tid, p - high, p - low + length

            for n, before, where in merge_runs(held):
                if n < DIGEST:
                    yield from close()
                    right, lefts, places = [], [], []
                right.append(max(0, n - DIGEST))
                lefts.append(before)
                places.append(where)
            yield from close()

        yield from _batched(classes(), SPAN_SCHEMA)

    spans = dealt.mapInArrow(merged, "tid binary, start long, end long")

    def hot_strings(batches):
        release_worker()

        def rows():
            for _, tid, raw, _, i, b in _first_texts(batches):
                at = sorted({p - o for p in b.column(3)[i].as_py() for o in range(0, min(p, side) + 1, unit) if p - o + length <= len(raw)})
                for s in at:
                    d = hashlib.sha256(raw[s : s + length]).digest()
                    yield int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:16], "big", signed=True), tid, s

        yield from _batched(rows(), pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("tid", pa.binary()), ("start", pa.int64())]))

    if counts.filter(F.col("n") > hot).isEmpty():
        return spans
    # Written, as two readers need them; and so that a hot string's join can be split.
    shown = materialize(placed("hot_at").mapInArrow(hot_strings, "d1 long, d2 long, tid binary, start long"), "hot-strings")
    often = materialize(shown.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").select("d1", "d2"), "hot-repeats")
    return spans.unionAll(shown.join(often, ["d1", "d2"]).select("tid", "start", (F.col("start") + length).alias("end")))


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words that ``bytes.split`` gives."""
    b = np.frombuffer(raw, np.uint8)
    ink = np.concatenate([[False], (b != 32) & ((b < 9) | (b > 13)), [False]])
    return np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(~ink[1:] & ink[:-1])


def sparse(raw: bytes, words: int) -> bool:
    """Whether some LENGTH bytes may hold fewer than ``words`` whole words, so that matching by words is not enough."""
    starts, ends = word_bounds(raw)
    before = np.concatenate([[-1], starts])
    after = np.concatenate([ends[words - 1 :], np.full(min(words, len(before)), len(raw) + 1)])[: len(before)]
    return len(raw) >= LENGTH and bool((after - before > LENGTH).any())


#: Odd multipliers of the bytes of a word by place; words are hashed a text at a time.
_LETTER = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(17))
_PLACE = np.cumprod(np.full(1 << 12, 0xD6E8FEB86659FD93, dtype=np.uint64))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word that ``bytes.split`` gives, of its whole bytes."""
    b = np.frombuffer(raw, np.uint8)
    ink = (b != 32) & ((b < 9) | (b > 13))
    letters = b[ink]
    if not len(letters):
        return np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(ink)
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    sizes = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    power = _PLACE if sizes.max() <= len(_PLACE) else np.cumprod(np.full(int(sizes.max()), 0xD6E8FEB86659FD93, dtype=np.uint64))
    h = np.add.reduceat(_LETTER[letters] * power[place], first) + sizes.astype(np.uint64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(28)
    return h


def word_codes():
    """A function from a text's bytes to ``CODE`` bytes for each of its words."""
    return lambda raw: np.ascontiguousarray(word_hashes(raw).view(np.uint8).reshape(-1, 8)[:, :CODE]).tobytes()


def passage_spans(texts: DataFrame, words: int, hot: int = HOT) -> DataFrame:
    """(tid, start, end, unit) of passages of ``words`` words, or of LENGTH bytes with fewer words, that start at two places.

    Each word becomes a code of CODE bytes, so that the search for strings of words * CODE bytes finds passages of words
    whatever their size; unit says in how many bytes start and end count one. Strings of LENGTH bytes are sought only in
    texts where they can hold fewer words (long words, scripts without spaces).
    """

    def few():
        return lambda raw: raw if sparse(raw, words) else None

    by_bytes = repeated_spans(texts, hot, LENGTH, few)
    by_words = repeated_spans(texts, hot, words * CODE, word_codes, CODE)
    return by_bytes.withColumn("unit", F.lit(1)).unionAll(by_words.withColumn("unit", F.lit(CODE)))


def removed_texts(texts: DataFrame, hot: int = HOT, with_text: bool = False, words: int | None = None) -> DataFrame:
    """(tid, n_removed, n_spans, kept_sha256[, kept]) of the texts that lose bytes. texts: key, tid, text of every document.

    With ``words``, passages of so many words go as well, whatever their bytes.
    """
    if words:
        spans, least = passage_spans(texts, words, hot), min(LENGTH, 2 * words - 1)
    else:
        spans, least = repeated_spans(texts, hot).withColumn("unit", F.lit(1)), LENGTH
    copies = texts.groupBy("tid").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("size")).filter((F.col("n") > 1) & (F.col("size") >= least))
    whole = copies.select("tid", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"), F.lit(0).alias("unit"))
    by_text = spans.unionAll(whole).groupBy("tid").agg(F.collect_set(F.struct("start", "end", "unit")).alias("spans")).withColumn("key", F.xxhash64("tid"))
    by_text = materialize(by_text, "spans")
    placed = wanted_texts(texts, by_text).join(by_text.withColumnRenamed("tid", "own").hint("shuffle_hash"), "key").select("key", "tid", "text", "spans", "own")
    kinds = pa.schema([("tid", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.string())] if with_text else [])])

    def in_bytes(raw, found):
        starts = None
        for s in found:
            if s["unit"] == CODE:
                if starts is None:
                    starts, ends = (x.tolist() for x in word_bounds(raw))
                yield starts[-(-s["start"] // CODE)], ends[s["end"] // CODE - 1]
            elif s["unit"] == 1 or len(raw) >= LENGTH or len(raw.split()) >= words:
                yield s["start"], s["end"]

    def cut(batches):
        release_worker()

        def rows():
            for _, tid, raw, _, i, b in _first_texts(batches, own=4):
                spans = union_spans(list(in_bytes(raw, b.column(3)[i].as_py())))
                if not spans:
                    continue
                kept, last = [], 0
                for s, e in spans:
                    kept.append(raw[last:s])
                    last = e
                kept.append(raw[last:])
                rest = b"".join(kept)
                out = (tid, sum(e - s for s, e in spans), len(spans), hashlib.sha256(rest).hexdigest())
                yield (*out, rest.decode("utf-8", "ignore")) if with_text else out

        yield from _sized(rows(), kinds)

    return placed.mapInArrow(cut, "tid binary, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else ""))


def _with_tid(docs: DataFrame, text_col: str, text: str, tid: str) -> DataFrame:
    """docs with the text, never null, and its identity: 128 bits of its SHA-256, which no crafted text can share."""
    small_batches(docs.sparkSession)
    return docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(tid, F.unhex(F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, 2 * DIGEST)))


def _texts(keyed: DataFrame, text: str, tid: str) -> DataFrame:
    return keyed.select(F.xxhash64(F.col(tid)).alias("key"), F.col(tid).alias("tid"), F.col(text).alias("text"))


def shared_passages(texts: DataFrame, words: int, window: int = 16) -> DataFrame:
    """(tid, n_shared): anchors of a text whose words - window + 1 words also stand in a text of another document.

    Every passage of ``words`` words that two documents share has such an anchor among its first ``window`` words, so a text
    without any shares none. Only counted here; what goes is settled by the search for strings.
    """
    core = sides(words * CODE, CODE, window)[1]

    def places(batches):
        release_worker()
        code = word_codes()
        held, n = [], 0
        for key, _, _, raw, *_ in _first_texts(batches, code):
            at = anchors(np.frombuffer(raw, np.uint8), words * CODE, CODE, window)
            if len(at):
                h = np.fromiter((xxhash.xxh64_intdigest(raw[p : p + core]) for p in at.tolist()), dtype=np.uint64, count=len(at)).view(np.int64)
                held.append((np.unique(h), key))
                n += len(at)
            if n > 20_000:
                yield batch(held)
                held, n = [], 0
        if held:
            yield batch(held)

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h for h, _ in held])), pa.array(np.repeat(np.array([k for _, k in held], dtype=np.int64), [len(h) for h, _ in held]))], names=["h", "key"])

    found = materialize(texts.mapInArrow(places, "h long, key long"), "word-anchors")
    copied = texts.groupBy("tid").agg(F.count("*").alias("n")).select("tid", F.xxhash64("tid").alias("key"), (F.col("n") > 1).alias("copied"))
    # Written, so that the join deals both sides anew and a core that a third of the texts share can be split.
    often = materialize(found.groupBy("h").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi").select("h"), "word-cores")
    shared = found.join(often, "h").groupBy("key").agg(F.count_distinct("h").alias("shared"))
    own = found.join(copied.filter("copied").select("key"), "key", "left_semi").groupBy("key").agg(F.count_distinct("h").alias("own"))
    counts = copied.join(shared, "key", "left").join(own, "key", "left")
    return counts.select("tid", F.coalesce("own", "shared").alias("n_shared")).filter("n_shared > 0")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, words: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, n_shared]) of every row.

    ``words`` adds the count of :func:`shared_passages`, which is over 0 for every text that shares a passage of so many
    words with another document, whatever its bytes; such passages are not removed here.
    """
    keyed = _with_tid(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", "_text", "_tid")
    texts = _texts(keyed, "_text", "_tid")
    removed = removed_texts(texts, hot)
    rows = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_tid").alias("tid"), F.octet_length("_text").cast("long").alias("n_bytes"), F.sha2(F.col("_text").cast("binary"), 256).alias("sha"))
    zero = F.lit(0).cast("long")
    out = rows.join(removed, "tid", "left")
    more = []
    if words:
        out = out.join(shared_passages(texts, words), "tid", "left")
        more = [F.coalesce("n_shared", zero).alias("n_shared")]
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *more)


def remove_repeats(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars", hot: int = HOT, words: int | None = None) -> DataFrame:
    """docs with the repeated strings cut out of their texts; a cut inside a character drops the character's rest.

    With ``words``, repeated passages of so many words go as well, though they have fewer than LENGTH bytes.

    Other columns stay; ``size_col``, if there, follows the new text. Rows without repeats are untouched.
    """
    text, tid, kept = fresh(docs, "_text", "_tid", "_kept")
    keyed = _with_tid(docs, text_col, text, tid)
    removed = removed_texts(_texts(keyed, text, tid), hot, with_text=True, words=words).select(F.col("tid").alias(tid), F.col("kept").alias(kept))
    out = keyed.join(removed, tid, "left").withColumn(text_col, F.coalesce(kept, F.col(text_col)))
    if size_col and size_col in docs.columns:
        out = out.withColumn(size_col, F.when(F.col(kept).isNull(), F.col(size_col)).otherwise(F.length(text_col)).cast(docs.schema[size_col].dataType))
    return out.select(*docs.columns)
