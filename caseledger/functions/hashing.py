"""Deterministic draws: SHA-256 in place of random numbers, all inside whole-stage codegen.

A 256-bit digest is reduced modulo N by folding its words, unrolled, in 64-bit arithmetic; N < 2**31.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_hex(*parts: Column | str, sep: str = "|") -> Column:
    """Hex digest of the parts joined by ``sep`` ("" for plain concatenation); null parts count as empty."""
    cols = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.sha2(F.concat_ws(sep, *cols) if sep else F.concat(*cols), 256)


def hex_mod(digest: Column, n: int | Column) -> Column:
    """The digest as a 256-bit integer modulo n, which a column of values from 1 to 2**31 - 1 may give. Words are as wide as
    64-bit arithmetic allows for n; of a power of two only the last digits count."""
    if not isinstance(n, Column) and not 0 < n < 1 << 31:
        raise ValueError("modulus must be positive and below 2**31")
    m = (n if isinstance(n, Column) else F.lit(n)).cast("bigint")
    bits = 31 if isinstance(n, Column) else n.bit_length()
    digits = (62 - bits) // 4 if bits < 31 else 8
    last = 64
    if not isinstance(n, Column) and n & (n - 1) == 0:
        last = digits = max(1, (bits + 2) // 4)
    starts = range(64 - last + 1, 65, digits)
    words = [(F.conv(F.substring(digest, i, min(digits, 65 - i)), 16, 10).cast("bigint"), 4 * min(digits, 65 - i)) for i in starts]
    acc = F.pmod(words[0][0], m)
    for w, width in words[1:]:
        acc = F.pmod(acc * F.lit(1 << width) + w, m)
    return acc


def draw(n: int | Column, *parts: Column | str, sep: str = "|") -> Column:
    return hex_mod(sha_hex(*parts, sep=sep), n)


def rate_hit(rate: float, *parts: Column | str, sep: str = "|") -> Column:
    """True for the share ``rate`` of keys."""
    return draw(1_000_000, *parts, sep=sep) < F.lit(round(rate * 1_000_000))


def weighted_pick(weights: Mapping[str, int], *parts: Column | str, by_key: bool = False, sep: str = "|") -> Column:
    """A key drawn by weight, walking keys as listed, or sorted with ``by_key``."""
    items, total = sorted(weights.items()) if by_key else list(weights.items()), sum(weights.values())
    roll = draw(total, *parts, sep=sep)
    if total <= 1024:  # one literal table, so the draw stands in the expression once
        place = F.lit(np.array([i for i, (_, w) in enumerate(items, 1) for _ in range(w)], dtype=np.int32))
        return F.element_at(F.array(*[F.lit(k) for k, _ in items]), F.element_at(place, roll.cast("int") + 1))
    upto, out = 0, None
    for key, w in items:
        upto += w
        out = F.when(roll < upto, key) if out is None else out.when(roll < upto, key)
    return out


def table_draw(values: Sequence[int], *parts: Column | str, sep: str = "|") -> Column:
    """An entry of a fixed table, by digest modulo its length."""
    return F.element_at(F.lit(np.array(values, dtype=np.int32)), draw(len(values), *parts, sep=sep).cast("int") + 1)


def quantile_table(median: float, sigma: float, buckets: int = 1024) -> list[int]:
    """Whole-day quantiles of a lognormal, at the middle of each bucket; the driver builds them once."""
    from math import exp
    from statistics import NormalDist

    inv = NormalDist().inv_cdf
    return [max(0, round(median * exp(sigma * inv((i + 0.5) / buckets)))) for i in range(buckets)]


def pseudonym(value: Column, prefix: str, salt: str) -> Column:
    """prefix plus six hex digits of the squeezed, upper-cased value; blank stays blank."""
    from caseledger.functions.text import is_blank, squeeze

    return F.when(is_blank(value), F.lit("")).otherwise(F.concat(F.lit(prefix), F.substring(sha_hex(salt, F.upper(squeeze(value))), 1, 6)))


def mint_key(prefix: str, *parts: Column | str) -> Column:
    return F.concat(F.lit(prefix), F.upper(F.substring(sha_hex(*parts), 1, 10)))
