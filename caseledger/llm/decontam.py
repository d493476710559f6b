"""Size-partitioned MinHash containment search for short test items inside long documents, DataFrame functions only.

A text's words are its lower-cased runs of letters and digits; its shingles are five consecutive words, or all its
words if there are fewer. An item of n distinct shingles is contained if a document has at least ceil(0.8 n) of them.

Items are partitioned by size, in classes of doubling n. A class sets the length m of its sketches: an item is sketched by
its m minimum hashes, m = floor(0.2 x the greatest n of the class) + ``SPARE`` (all n where there are fewer). The share of
a sketch that a document has estimates its containment, and the estimate has a sharp bound: a document that contains the
item lacks at most n - ceil(0.8 n) of its shingles, so it has at least m - (n - ceil(0.8 n)) of the sketch, which is
``SPARE`` or more. Documents under this bound are no candidates, and no match is lost: the search's recall is 1.

All documents' shingle hashes stream past the sketches once, which leaves candidate pairs; a second pass over the
candidates' documents alone counts exact shingle strings. Sketches and candidates are broadcast only after a count has
shown them to be under ``BROADCAST_ROWS``; beyond it, the same joins shuffle.

Defined results: null and empty texts, and texts without a letter or digit, hold and match nothing; an item shorter than
five words is searched with shingles of its own length; a pair is reported once however often rows repeat; empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.llm.common import SHINGLE_WORDS, SIMILARITY, fresh, materialize, norm_words

#: Of some 16 to 100 bytes each: at most some 30 MB in a broadcast hash table.
BROADCAST_ROWS = 300_000
#: Hashes of a sketch that a containing document has at least.
SPARE = 3


def _grams(words: Column, k: Column | int, most: int, make) -> Column:
    """make(the words of each shingle); past k words they are null, which the hash and the string leave out."""
    starts = F.sequence(F.lit(0), F.size(words) - k)
    return F.transform(starts, lambda i: make(*[F.get(words, i + j) if isinstance(k, int) else F.when(F.lit(j) < k, F.get(words, i + j)) for j in range(most)]))


def item_sketches(items: DataFrame, text_col: str, words: int = SHINGLE_WORDS, least: float = SIMILARITY) -> DataFrame:
    """(item, k, n, need, hits, grams, sketch) of each distinct item text; grams are (h, s), the sketch its least by h.

    An item's shingles stand in one row: test items are short.
    """
    base = items.select(F.substring(F.sha2(F.col(text_col).cast("binary"), 256), 1, 32).alias("item"), norm_words(F.col(text_col)).alias("w")).filter(F.size("w") > 0).dropDuplicates(["item"])
    base = base.withColumn("k", F.least(F.size("w"), F.lit(words)))
    grams = F.array_sort(F.array_distinct(_grams(F.col("w"), F.col("k"), words, lambda *g: F.struct(F.xxhash64(*g).alias("h"), F.concat_ws(" ", *g).alias("s")))))
    sized = base.select("item", "k", grams.alias("grams")).withColumn("n", F.size("grams")).withColumn("need", F.ceil(F.col("n") * F.lit(least) - 1e-9).cast("int"))
    # The size class: n from 2^c to 2^(c + 1) - 1.
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1
    sized = sized.withColumn("m", F.least(F.col("n"), (F.floor(largest - F.ceil(largest * F.lit(least) - 1e-9)) + SPARE).cast("int")))
    return sized.select("item", "k", "n", "need", (F.col("m") - F.col("n") + F.col("need")).alias("hits"), "grams", F.slice("grams", 1, F.col("m"))["h"].alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", words: int = SHINGLE_WORDS, least: float = SIMILARITY) -> DataFrame:
    """(id_col, text_hash, item_col, n_shingles, n_found, containment) of every contained item, once per pair."""
    sketches = materialize(item_sketches(items, item_text, words, least), "sketches")
    lengths = sorted(r["k"] for r in sketches.select("k").distinct().collect())  # at most `words` values

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df

    base = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"), F.col(text_col).alias("_text"))
    out = None
    for k in lengths or [words]:
        own = sketches.filter(F.col("k") == k)
        worded = base.select("_id", "_th", norm_words(F.col("_text")).alias("w")).filter(F.size("w") >= k)
        seen = worded.select("_id", "_th", F.explode(_grams(F.col("w"), k, k, F.xxhash64)).alias("h"))
        probes = small(own.select("item", "hits", F.explode("sketch").alias("h")))
        hit = seen.join(probes, "h").select("_id", "_th", "item", "hits", "h").distinct()
        cand = materialize(hit.groupBy("_id", "_th", "item", "hits").agg(F.count("*").alias("c")).filter("c >= hits").select("_id", "_th", "item"), "candidates")
        # Exact: shingle strings of the candidates' documents against those of the items.
        again = cand.select(F.col("_id").alias("_ci"), F.col("_th").alias("_ct")).distinct()
        full = base.join(small(again), F.col("_id").eqNullSafe(F.col("_ci")) & (F.col("_th") == F.col("_ct")), "left_semi").dropDuplicates(["_id", "_th"])
        strings = full.select("_id", "_th", norm_words(F.col("_text")).alias("w")).filter(F.size("w") >= k)
        strings = strings.select("_id", "_th", F.explode(F.array_distinct(_grams(F.col("w"), k, k, lambda *g: F.concat_ws(" ", *g)))).alias("s"))
        exact = strings.join(small(own.select("item", "n", "need", F.explode("grams.s").alias("s"))), "s").groupBy("_id", "_th", "item", "n", "need").agg(F.count("*").alias("n_found")).filter(F.col("n_found") >= F.col("need"))
        out = exact if out is None else out.unionByName(exact)
    ids = items.select(F.col(item_col), F.substring(F.sha2(F.col(item_text).cast("binary"), 256), 1, 32).alias("item")).distinct()
    return out.join(ids, "item").select(
        F.col("_id").alias(id_col), F.col("_th").alias("text_hash"), F.col(item_col), F.col("n").cast("long").alias("n_shingles"), "n_found", (F.col("n_found") / F.col("n")).alias("containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs without the rows whose text contains an item; all columns stay as they are."""
    ident, digest = fresh(docs, "_id", "_th")
    found = contained_items(docs.select(id_col, text_col), items, id_col, text_col, **kw).select(F.col(id_col).alias(ident), F.col("text_hash").alias(digest)).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(ident)) & (F.xxhash64(F.col(text_col)) == F.col(digest)), "left_anti")
