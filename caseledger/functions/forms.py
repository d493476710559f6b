"""Form text: sections, field classes, prompts and strict responses; anchors are in ``operators.segments``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseledger.functions.text import is_blank


def section(text: Column, heading: str, ends: Sequence[str]) -> Column:
    """From after a heading to the first later subhead; the whole text without the heading."""
    at = F.locate(heading, text)
    rest = F.substr(text, at + len(heading))
    stops = [F.when(F.locate(e, rest) > 0, F.locate(e, rest)) for e in ends]
    stop = F.least(*stops) if len(stops) > 1 else stops[0]
    return F.when(at == 0, text).otherwise(F.trim(F.when(stop.isNull(), rest).otherwise(F.substr(rest, F.lit(1), stop - 1))))


def tail_from(text: Column, heading: str) -> Column:
    """From the heading to the end; "" without it."""
    return F.when(F.locate(heading, text) > 0, F.substr(text, F.locate(heading, text))).otherwise("")


def field_class(c: Column, legitimate: Sequence[str]) -> Column:
    """parse_failed (null), absent_legitimate, typed (a statement opens with a head) or freetext."""
    return F.when(c.isNull(), "parse_failed").when(is_blank(c) | F.lower(F.trim(c)).isin(*legitimate), "absent_legitimate").when(c.rlike(r"^[A-Z][A-Za-z ]{0,58}:"), "typed").otherwise("freetext")


def keep_lines(lines: Column, furniture: Sequence[str], watermark: str) -> Column:
    """Lines without furniture, watermarks stripped, squeezed; lines that end up blank go."""
    out = F.filter(lines, lambda x: ~x.rlike("|".join(f"(?:{p})" for p in furniture)))
    return F.filter(F.transform(out, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, watermark, ""), r"\s+", " "))), lambda x: x != "")


def prompt(template: str, text: Column, limit: int = 1200) -> Column:
    """The template with ``{text}`` filled by at most ``limit`` characters, as the labelling protocol has it."""
    before, after = template.split("{text}")
    return F.concat(F.lit(before), F.substring(text, 1, limit), F.lit(after))


def response(raw: Column, vocabulary: Sequence[str], abstain: str) -> Column:
    """struct(category, element) of the outermost {...}: a listed category and an integer from 1 to 20, else null."""
    body = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    category = F.get_json_object(body, "$.category")
    element = F.when(F.get_json_object(body, "$.element").rlike(r"^-?\d+$"), F.from_json(body, "element int")["element"])
    good = (category.isin(*vocabulary) & element.between(1, 20)) | (category == abstain)
    return F.when(good, F.struct(category.alias("category"), F.when(category != abstain, element).alias("element")))
