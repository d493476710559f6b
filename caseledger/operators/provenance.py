"""Cell provenance: tokens beside values, gap filling that never overwrites, audits of coverage and validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseledger.functions.text import filled, is_blank

#: Where a cell's value comes from: names of tokens, and which count as real and as fabricated (fixed values).
REAL, FABRICATED, TOKENS = ("src", "xw"), ("syn", "llm", "key"), ("", "src", "xw", "llm", "gold", "syn", "key", "pseud")


def prov(col: str) -> str:
    return f"{col}__prov"


def base_tokens(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), pseudonyms: Sequence[str] = ()) -> DataFrame:
    """A token column per column, by its role; a blank cell has a blank token."""
    for c in cols:
        token = "key" if c in keys else "pseud" if c in pseudonyms else "src"
        df = df.withColumn(prov(c), F.when(is_blank(F.col(c).cast("string")), "").otherwise(token))
    return df


def fill_gaps(df: DataFrame, col: str, value: Column, token: str) -> DataFrame:
    """Value and token change together, where the cell is blank and the new value is not."""
    take = is_blank(F.col(col)) & filled(value)
    return df.withColumns({col: F.when(take, value).otherwise(F.col(col)), prov(col): F.when(take, token).otherwise(F.col(prov(col)))})


def real_only(df: DataFrame, cols: Sequence[str], drop: Sequence[str] = ("syn",)) -> DataFrame:
    hit = {c: F.col(prov(c)).isin(*drop) for c in cols}
    return df.withColumns({c: F.when(h, "").otherwise(F.col(c)) for c, h in hit.items()} | {prov(c): F.when(h, "").otherwise(F.col(prov(c))) for c, h in hit.items()})


def _long(aggregated: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row of ``col__field`` aggregates to a row per column."""
    parts = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields]) for c in cols])
    return aggregated.select(F.explode(parts).alias("x")).select("x.*")


def coverage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, filled, total) in one pass and one partial aggregate."""
    cols = list(cols or df.columns)
    aggs = [a for c in cols for a in (F.count_if(filled(F.col(f"`{c}`").cast("string"))).alias(f"{c}__filled"), F.count(F.lit(1)).alias(f"{c}__total"))]
    return _long(df.agg(*aggs), cols, ("filled", "total"))


def token_tally(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, real, pseud, fabricated, unfilled); keys count as fabricated, pseudonyms as neither."""
    aggs = []
    for c in cols:
        t = F.col(prov(c))
        aggs += [F.count_if(t.isin(*REAL)).alias(f"{c}__real"), F.count_if(t == "pseud").alias(f"{c}__pseud"), F.count_if(t.isin(*FABRICATED)).alias(f"{c}__fabricated"), F.count_if(t == "").alias(f"{c}__unfilled")]
    return _long(df.agg(*aggs), cols, ("real", "pseud", "fabricated", "unfilled"))


def disposition(tally: DataFrame, declared: DataFrame, goal: float) -> DataFrame:
    """(column, basis, real, pseud, fabricated, unfilled, total, real_share, target): the measured tally where a column has a
    token grid, else what is declared (column, real, pseud, fabricated, total); what is left of the total is unfilled. Columns
    below the goal are targets, numbered from the least share on, of equal ones by name."""
    counts = ("real", "pseud", "fabricated")
    m = tally.select("column", *[F.col(c).alias(f"_{c}") for c in counts], (F.col("unfilled") + F.col("real") + F.col("pseud") + F.col("fabricated")).alias("_total"))
    d = m.join(declared.select("column", *counts, "total"), "column", "full_outer")
    d = d.select("column", F.when(F.col("_total").isNotNull(), "measured").otherwise("declared").alias("basis"), *[F.coalesce(f"_{c}", c).alias(c) for c in (*counts, "total")])
    d = d.withColumns({"unfilled": F.col("total") - F.col("real") - F.col("pseud") - F.col("fabricated"), "real_share": F.round(F.coalesce(F.try_divide("real", "total"), F.lit(0.0)), 6)})
    # As many rows as the schema has columns.
    rank = F.row_number().over(Window.orderBy(F.col("real_share") >= goal, "real_share", "column"))
    return d.withColumn("target", F.when(F.col("real_share") < goal, rank))


def orphans(df: DataFrame, cols: Sequence[str], ident: str) -> DataFrame:
    """(ident, column): a blank cell with a token, a filled one without, or an unknown token. None in a sound table."""
    bad = [F.when((is_blank(F.col(c)) != (F.col(prov(c)) == "")) | ~F.col(prov(c)).isin(*TOKENS), F.lit(c)) for c in cols]
    return df.select(ident, F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("column"))


def first_failure(value: Column, label_tokens: Sequence[str] = (), min_words: int = 0, pattern: str | None = None, terminal: str | None = None) -> Column:
    """form_label, too_short, bad_pattern or truncated, in this order; null passes, and so does a blank."""
    out = F.when(is_blank(value), F.lit(None).cast("string"))
    for t in label_tokens:
        out = out.when(F.contains(F.upper(value), F.lit(t)), "form_label")
    if min_words:
        out = out.when(F.size(F.split(F.trim(value), r"\s+")) < min_words, "too_short")
    if pattern:
        out = out.when(~value.rlike(f"^(?:{pattern})$"), "bad_pattern")
    if terminal:
        out = out.when(~F.substr(F.trim(value), F.lit(-1)).isin(*terminal), "truncated")
    return out


def validity(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(column, reason, n) over checked cells; reason ``passed`` for those without a failure."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), filled(F.col(c)).alias("there"), F.coalesce(rule, F.lit("passed")).alias("reason")) for c, rule in rules.items()])
    return df.select(F.explode(cells).alias("x")).filter("x.there").groupBy("x.column", "x.reason").agg(F.count("*").alias("n"))


def domain_guard(df: DataFrame, col: str, vocabulary: Sequence[str]) -> DataFrame:
    """A value outside the vocabulary becomes blank; ``<col>__guarded`` tells."""
    bad = filled(F.col(col)) & ~F.col(col).isin(*vocabulary)
    return df.withColumns({col: F.when(bad, "").otherwise(F.col(col)), f"{col}__guarded": bad})
