"""Rules as data, compiled to one ``select``: an extractor kind per label, sources in order of preference."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseledger.functions.dates import iso_text, military_time
from caseledger.functions.forms import section, tail_from
from caseledger.functions.hashing import pseudonym
from caseledger.functions.text import area_block, filled, last_sentence_with, squeeze

#: The extension point: kind -> builder of (value, rule).
KINDS: dict[str, Callable[[Column, Mapping], Column]] = {
    "text": lambda c, r: squeeze(c),
    "verbatim": lambda c, r: c,
    "date": lambda c, r: iso_text(c),
    "time": lambda c, r: military_time(c),
    "area_block": lambda c, r: F.coalesce(area_block(c), F.lit("")),
    "pseudonym": lambda c, r: pseudonym(c, r["prefix"], r["salt"]),
    "literal_if": lambda c, r: F.when(c.rlike(r["pattern"]), r["literal"]).otherwise(""),
    "match": lambda c, r: F.regexp_extract(c, r["pattern"], r.get("group", 0)),
    "area": lambda c, r: F.regexp_extract(c, r"AREA:\s*([A-Z]{2,3})\b", 1),
    "block": lambda c, r: F.regexp_extract(c, r"BLOCK:\s*(\d{1,4})\b", 1),
    "platform": lambda c, r: F.btrim(F.regexp_replace(F.substring_index(c, "\n", 1), r"(?i)\bRIG NAME:.*$", ""), F.lit(" :")),
    "rig_name": lambda c, r: F.trim(F.regexp_extract(c, r"(?i)RIG NAME:\s*(.+)", 1)),
    "other_text": lambda c, r: F.trim(F.regexp_extract(c, r"\bOTHER\s+([A-Za-z][A-Za-z /&'-]{2,60})", 1)),
    "section": lambda c, r: section(c, r["heading"], r["ends"]),
    "tail": lambda c, r: tail_from(c, r["heading"]),
    "last_sentence": lambda c, r: last_sentence_with(squeeze(c), r["cue"], r.get("low", 25), r.get("high", 400)),
}


def register(kind: str, build: Callable[[Column, Mapping], Column]) -> None:
    KINDS[kind] = build


def compile_projection(rules: Sequence[Mapping], columns: Sequence[str]) -> list[Column]:
    """One column per rule: the first source that is there and gives a non-blank value; blank without one.

    A rule may fall back: ``whole_record`` reads all columns that its pattern names as one text, ``manifest`` names columns
    that are taken as they are, trimmed."""
    out = []
    for rule in rules:
        missing = {"label", "kind", "source"} - rule.keys()
        if missing:
            raise KeyError(f"rule lacks {sorted(missing)}")
        build = KINDS[rule["kind"]]
        values = [build(F.col(f"`{s}`").cast("string"), rule) for s in rule["source"] if s in columns]
        if "whole_record" in rule and (every := [c for c in columns if re.match(rule["whole_record"], c)]):
            values.append(build(F.concat_ws(" ", *[F.col(f"`{c}`") for c in every]), rule))
        values += [F.trim(F.col(f"`{c}`").cast("string")) for c in rule.get("manifest", ()) if c in columns]
        picked = F.coalesce(*[F.when(filled(v), v) for v in values], F.lit("")) if values else F.lit("")
        out.append(picked.alias(rule["label"]))
    return out
