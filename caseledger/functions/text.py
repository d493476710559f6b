"""Text expressions: blanks, squeezing, splitting, heads of statements, money, area codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null or white space alone. Values are kept verbatim; only predicates treat both alike."""
    return c.isNull() | (F.trim(c) == "")


def filled(c: Column) -> Column:
    return ~is_blank(c)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def first_match(pattern: str, *texts: Column, group: int = 0) -> Column:
    """The first text's match, in the order given; null without any."""
    return F.coalesce(*[F.nullif(F.regexp_extract(t, pattern, group), F.lit("")) for t in texts])


def sentences(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"(?<=[.!?])\s+"), lambda s: s != "")


def last_sentence_with(c: Column, cue: str, low: int = 25, high: int = 400) -> Column:
    """The last sentence that matches the cue, if it has a sensible length; null otherwise. An earlier one does not stand in."""
    last = F.try_element_at(F.filter(sentences(c), lambda s: s.rlike(cue)), F.lit(-1))
    return F.when(F.length(last).between(low, high), last)


def split_enumerated(c: Column) -> Column:
    """Items of a list whose lines start with a number, a letter or a bullet; [] where it says there is none."""
    items = F.filter(F.transform(F.split(c, r"(?m)^\s*(?:\d{1,2}[.)]|[a-z][.)]|[-•*])\s+"), lambda s: squeeze(s)), lambda s: s != "")
    nil = F.lower(F.trim(F.coalesce(c, F.lit("")))).rlike(r"^(?:|n/?a|none|nil|no recommendations?)\.?$")
    return F.when(nil, F.array().cast("array<string>")).otherwise(items)


def strip_glyphs(c: Column) -> Column:
    """(cid:N) glyph codes as bullets."""
    return F.regexp_replace(c, r"\(cid:\d+\)", "•")


def glyph_share(c: Column) -> Column:
    """Share of a text's characters that are glyph codes."""
    return F.coalesce(F.try_divide(F.length(c) - F.length(F.regexp_replace(c, r"\(cid:\d+\)", "")), F.length(c)), F.lit(0.0))


def normalise_head(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), r"[\s_]+", " ")), "[^a-z0-9 /]", "")


SEPARATOR = r"^([A-Z][^:–—]{0,59}?)\s*(:|–|—|-\s)\s*"


def parse_head(c: Column) -> Column:
    """struct(head, form, rest): what stands before the first separator, if it is at most six words and 60 characters."""
    head = F.trim(F.regexp_extract(c, SEPARATOR, 1))
    form = F.trim(F.regexp_extract(c, SEPARATOR, 2))
    good = (head != "") & (F.size(F.split(head, r"\s+")) <= 6)
    return F.struct(F.when(good, head).alias("head"), F.when(good, form).alias("form"), F.when(good, F.trim(F.regexp_replace(c, SEPARATOR, ""))).otherwise(F.trim(c)).alias("rest"))


def parse_statement(c: Column) -> Column:
    """struct(category, subcategory, description): head, then up to the next separator or sentence end (14 words at most)."""
    p = parse_head(c)
    sub = F.trim(F.regexp_extract(p["rest"], r"^([^:–—.!?]{1,160}?)\s*(?::|–|—|-\s|[.!?](?:\s|$))", 1))
    good = p["head"].isNotNull() & (sub != "") & (F.size(F.split(sub, r"\s+")) <= 14)
    return F.struct(p["head"].alias("category"), F.when(good, sub).alias("subcategory"), p["rest"].alias("description"))


def is_label_fragment(c: Column, furniture: list[str]) -> Column:
    t = F.trim(c)
    return (F.upper(t) == t) & t.isin(furniture)


def money(c: Column) -> Column:
    """The first $ amount, cents included; null without one."""
    return F.regexp_replace(F.regexp_extract(c, r"\$\s*([\d,]+(?:\.\d{1,2})?)", 1), ",", "").try_cast("double")


def area_block(c: Column) -> Column:
    """``AA 123``: two or three capitals and a number without leading zeros; null without one."""
    area, block = F.regexp_extract(c, r"\b([A-Z]{2,3})[ -]*0*(\d+)", 1), F.regexp_extract(c, r"\b([A-Z]{2,3})[ -]*0*(\d+)", 2)
    return F.when(area != "", F.concat_ws(" ", area, block))


def joined_key(*parts: Column, least: int = 3) -> Column:
    """Non-blank parts joined by hyphens; null with fewer than ``least``."""
    there = F.filter(F.array(*[p.cast("string") for p in parts]), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return F.when(F.size(there) >= least, F.array_join(there, "-"))


def clause_list(items: Column) -> Column:
    """``a``, ``a and b``, ``a, b and c``."""
    n = F.size(items)
    return F.when(n == 0, "").when(n == 1, F.try_element_at(items, F.lit(1))).otherwise(F.concat(F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.try_element_at(items, F.lit(-1))))


def without_head(c: Column, head: Column) -> Column:
    """The statement after a literal head and its mark; the statement itself without it."""
    marked = c.startswith(head) & F.substr(c, F.length(head) + 1).rlike(r"^\s*[:\-]")
    return F.when(marked, F.regexp_replace(F.substr(c, F.length(head) + 1), r"^\s*[:\-]+\s*", "")).otherwise(c)


def control_safe(c: Column) -> Column:
    """Runs of control characters as one space."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]+", " ")


#: A colon or long dash, or a hyphen after a letter or a space with a space behind it; heads that are no category (fixed patterns).
HEAD_END, NO_HEAD, BULLETS = r"[:–—]|(?<=[a-zA-Z])-(?=\s)|(?<=\s)-(?=\s)", r"(?i)^(?:NOTE|LIST\s+THE\b.*)$", r"^[\s•●▪·*-]+"


def candidate_category(c: Column, furniture: str = NO_HEAD, fragments: Sequence[str] = ()) -> Column:
    """struct(head, form): what stands before the first separator, without any vocabulary. Form is empty, untyped_prose (no
    separator within 60 characters, more than six words, no capital first), furniture (label text), colon or dash; only the
    last two have a head."""
    body = F.trim(F.regexp_replace(strip_glyphs(F.coalesce(c, F.lit(""))), BULLETS, ""))
    raw = F.get(F.split(body, HEAD_END, 2), F.lit(0))
    head = F.btrim(raw, F.lit(" .–—-"))
    typed = body.rlike(HEAD_END) & (F.length(raw) <= 60) & head.rlike(r"^\p{Lu}") & (F.size(F.split(head, r"\s+")) <= 6)
    label = head.rlike(furniture) | (is_label_fragment(head, list(fragments)) if fragments else F.lit(False))
    form = F.when(body == "", "empty").when(~typed, "untyped_prose").when(label, "furniture").when(F.regexp_extract(body, HEAD_END, 0) == ":", "colon").otherwise("dash")
    return F.struct(F.when(form.isin("colon", "dash"), head).alias("head"), form.alias("form"))


def outcome_text(atoms: Column, damage: Column, injury: Mapping[str, str], event: Mapping[str, str], response: Mapping[str, str], clause: str) -> Column:
    """Published atoms as a sentence for each group, phrases in the rules' order whatever the atoms'; then the damage, if
    there is any sentence. Without a known atom it is blank."""
    found = lambda rules: F.array_compact(F.array(*[F.when(F.array_contains(atoms, a), p) for a, p in rules.items()]))
    said = []
    for rules, opening in ((injury, "The incident resulted in "), (event, "Reported as "), (response, "")):
        phrases = found(rules)
        text = clause_list(phrases)
        text = F.concat(F.lit(opening), text) if opening else F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))
        said.append(F.when(F.size(phrases) > 0, text))
    parts = F.array_compact(F.array(*said))
    before, after = clause.split("{amount}")
    money = F.when(filled(damage), F.concat(F.lit(f" {before}"), damage, F.lit(after))).otherwise("")
    return F.when(F.size(parts) == 0, "").otherwise(F.concat(F.array_join(parts, ". "), F.lit("."), money))


def percent(part: Column, whole: Column) -> Column:
    """A share as text with one decimal, halves to even, a dash where there is no whole."""
    return F.when(whole == 0, "-").otherwise(F.format_string("%.1f%%", F.bround(F.try_divide(part * F.lit(100.0), whole), 1)))


def is_positive_score(c: Column) -> Column:
    """Filled and not a plain 0."""
    return filled(c) & (F.trim(c) != "0")
