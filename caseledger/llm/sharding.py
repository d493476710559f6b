"""Histogram sort into shards of near-equal weight, with DataFrame functions only.

Every row has a 120-bit key: 36 bits from the MD5 of its text and 54 from that of its identifier, then 30 that a hash of the
row's number gives. Equal texts so lie side by side, and a group of copies of any size can still be cut between its
members; rows equal in text and identifier, which nothing tells apart, are cut by row number. Candidate boundaries are
refined by rounds: a round sums the exact weight and rows below each probe inside the brackets that are still open,
until a bracket holds a single key, which is the tolerance. Then the rows are exchanged once, by bins of the same
histogram, and get their gapless slots from exact prefix counts plus a row number inside the bin.

Defined results: a null text has size 1 and the checksum of the empty text; a null identifier hashes as the empty
string; an empty table gives no rows; columns of the input with other names are ignored, so clashing names cannot arise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from caseledger.llm.common import materialize

HALF = 60
KEY_BITS = 2 * HALF
#: Bits that each round of probes resolves: 4,096 probes at first, then 256 inside each open bracket.
ROUND_BITS = (12, 8, 8, 8, 8, 8, 8) + (8, 8, 8, 8, 8, 8, 8, 4)
#: A bin with more rows than this share of the table is refined further, so that no task sorts a large part of it.
BIN_SHARE = 1 / 2048
BIN_ROWS = 20_000


def _bits(digest: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(digest, first, n), 16, 10).cast("long")


def shard_keys(text: Column, ident: Column) -> tuple[Column, Column]:
    """High and low half of the key. The low half numbers rows, so write it before it is read twice."""
    a, b = F.md5(F.coalesce(text, F.lit("")).cast("binary")), F.md5(F.coalesce(ident.cast("string"), F.lit("")).cast("binary"))
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 30) - 1))
    return F.shiftleft(_bits(a, 1, 9), 24).bitwiseOR(_bits(b, 1, 6)), F.shiftleft(F.shiftright(_bits(b, 7, 8), 2), 30).bitwiseOR(number)


def _prefix(done: int) -> Column:
    """The first ``done`` bits of the key: a number, or where they reach into the low half both halves as text."""
    if done <= HALF:
        return F.shiftright("high", HALF - done)
    return F.concat_ws(":", F.col("high").cast("string"), F.shiftright("low", KEY_BITS - done).cast("string"))


def _as_sql(p: int, done: int) -> int | str:
    return p if done <= HALF else f"{p >> (done - HALF)}:{p & (1 << (done - HALF)) - 1}"


def _as_number(p: int | str, done: int) -> int:
    if done <= HALF:
        return p
    high, low = p.split(":")
    return int(high) << (done - HALF) | int(low)


def _probe(rows: DataFrame, open_bins: list[int] | None, done: int, bits: int) -> list[tuple[int, int, int]]:
    """Exact (prefix, weight, rows) of the bins that the next ``bits`` bits make inside the open bins."""
    if open_bins is not None:
        rows = rows.filter(_prefix(done).isin([_as_sql(p, done) for p in open_bins]))
    got = rows.groupBy(_prefix(done + bits).alias("p")).agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    return sorted((_as_number(r["p"], done + bits), r["w"], r["n"]) for r in got.collect())  # at most open bins x 2^bits rows


def histogram_bins(keyed: DataFrame, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Leaf bins as (prefix, bits, shard, slot of the first row, rows), in key order. keyed: high, low, weight.

    Shard of a key: ``floor(shards x weight of all smaller keys / total weight)``, so a shard exceeds its share by less
    than one key's weight.
    """
    done = ROUND_BITS[0]
    level = _probe(keyed, None, 0, done)
    total, count = sum(w for _, w, _ in level), sum(n for *_, n in level)
    most = max(BIN_ROWS, int(count * BIN_SHARE))
    leaves: list[tuple[int, int, int, int, int]] = []  # prefix, bits, weight below, weight, rows
    pending, below = [], 0
    for p, w, n in level:
        pending.append((p, below, w, n))
        below += w
    shard_of = lambda before: min(shards - 1, shards * before // total)
    for bits in (*ROUND_BITS[1:], 0):
        # A bin that a boundary may cut, or one too large for a task; a single row needs no look.
        split = [x for x in pending if bits and x[3] > 1 and (x[3] > most or shard_of(x[1]) != shard_of(x[1] + x[2] - 1))]
        chosen = {x[0] for x in split}
        leaves += [(p, done, b, w, n) for p, b, w, n in pending if p not in chosen]
        if not split:
            break
        base = {p: b for p, b, *_ in split}
        pending = []
        for p, w, n in _probe(keyed, sorted(chosen), done, bits):
            parent = p >> bits
            pending.append((p, base[parent], w, n))
            base[parent] += w
        done += bits
    out, slots = [], [0] * shards
    for p, bits, before, _, n in sorted(leaves, key=lambda x: x[0] << (KEY_BITS - x[1])):
        s = shard_of(before)
        out.append((p, bits, s, slots[s], n))
        slots[s] += n
    return out


def histogram_sort(rows: DataFrame, weight: str, shards: int) -> DataFrame:
    """rows plus ``shard`` and ``slot`` (gapless from 0 in each shard, in key order). Keys: longs high and low of 60 bits.

    Reads the rows once per round of probes, so hand over a materialised table; exchanges them once.
    """
    spark = rows.sparkSession
    bins = histogram_bins(rows.select("high", "low", F.col(weight).alias("weight")), shards)
    # Which bins were split, by level: a row's leaf is the first level at which its prefix was not.
    leaf = F.lit(None).cast("string")
    for bits in sorted({b for _, b, *_ in bins}, reverse=True):
        deeper = sorted({p >> (b - bits) for p, b, *_ in bins if b > bits})
        here = F.concat_ws("/", F.lit(str(bits)), _prefix(bits).cast("string"))
        leaf = F.when(_prefix(bits).isin([_as_sql(p, bits) for p in deeper]), leaf).otherwise(here) if deeper else here
    schema = T.StructType([T.StructField("_leaf", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("_first", T.LongType())])
    # Bounded by the probes: 4,096 bins plus 256 for each splitter, round and oversized bin.
    known = F.broadcast(spark.createDataFrame([(f"{b}/{_as_sql(p, b)}", s, f) for p, b, s, f, _ in bins], schema))
    order = Window.partitionBy("_leaf").orderBy("high", "low", *[F.col(c) for c in rows.columns if c not in ("high", "low")])
    dealt = rows.withColumn("_leaf", leaf).withColumn("_n", F.row_number().over(order))
    return dealt.join(known, "_leaf").withColumn("slot", F.col("_first") + F.col("_n") - 1).drop("_leaf", "_n", "_first")


def shard_documents(docs: DataFrame, shards: int = 16, law: str = "bytes", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``bytes`` or ``rows``."""
    if law not in ("bytes", "rows"):
        raise ValueError("law must be bytes or rows")
    text = F.coalesce(F.col(text_col), F.lit(""))
    high, low = shard_keys(F.col(text_col), F.col(id_col))
    facts = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        high.alias("high"),
        low.alias("low"),
    ).withColumn("_weight", F.col("size") if law == "bytes" else F.lit(1).cast("long"))
    done = histogram_sort(materialize(facts, "shard-keys"), "_weight", shards)
    return done.select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
