"""Names of report files: lease area and block, operator, date, redaction, upload variant, and what could not be read.

Nothing is guessed and nothing raises: what a name does not hold stays blank, with a note.
"""

from __future__ import annotations

import re
from datetime import date

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

#: Codes of offshore areas (fixed values).
AREAS = "AC AS AT BA BM BS DC EB EC EI EL EW GA GB GC GI HI HIA KC LA LB MC MI MO MP MU PL PN SE SM SP SS ST VK VR WC WD WR".split()
#: Words of a name that belong to no operator (fixed values).
NOISE = "pdf report reports final draft copy redacted sanitized sanitised santized ev2010 ev2010r ev2010rr 2010 form rev revised v2 accident acc inc incident a".split()
_MON = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_NAME, _GAP, _YEAR = "(?P<mon>" + "|".join(_MON) + ")[a-z]*", "[-_. ]*", r"(?P<y>20\d{2}|\d{2})(?!\d)"
_TWO, _DAY = r"(?P<m>0[1-9]|1[0-2])", r"(?P<d>0[1-9]|[12]\d|3[01])"
#: Written dates in order of trust: a named month, then digits; a bare year is none (fixed patterns).
_DATES = [
    re.compile(p, re.IGNORECASE)
    for p in (
        rf"(?<!\d)(?P<d>\d{{1,2}}){_GAP}{_NAME}{_GAP}{_YEAR}", rf"(?<![a-z0-9]){_NAME}{_GAP}(?P<d>\d{{1,2}}){_GAP}{_YEAR}", rf"(?<!\d)(?P<y>20\d{{2}}){_TWO}{_DAY}(?!\d)",
        rf"(?<!\d){_TWO}{_DAY}(?P<y>20\d{{2}})(?!\d)", r"(?<!\d)(?P<m>\d{1,2})[-_.](?P<d>\d{1,2})[-_.](?P<y>20\d{2})(?!\d)", rf"(?<!\d){_TWO}[-_.]{_DAY}[-_.](?P<y>\d{{2}})(?!\d)",
    )
]
_ARCHIVE = re.compile(r"(?P<y>\d{2})(?P<m>\d{2})(?P<d>\d{2})[a-z]?(?:-pdf)?", re.IGNORECASE)
_REDACTED, _VARIANT = re.compile(r"redact|san\w*i[sz]ed", re.IGNORECASE), re.compile(r"(?:\s*\(\d{1,2}\)|[_-]v\d{1,2}|_\d{1,2})\s*$", re.IGNORECASE)
_LEASE = re.compile(r"(?<![0-9A-Za-z&])(?P<area>[A-Za-z]{2,3})(?:(?P<joined>\d{1,4})|[^0-9A-Za-z&]+(?:(?P<lead>[A-Za-z])[^0-9A-Za-z&]+(?=\d+(?![0-9A-Za-z&])))?(?P<block>\d{1,4}[A-Za-z]?))(?![0-9A-Za-z&])(?:[^0-9A-Za-z&]+(?P<tail>[A-Za-z])(?![0-9A-Za-z&]))?")
FIELDS = "area string, block string, operator string, date_text string, day string, year string, redacted boolean, variant string, notes array<string>"


def _day(m: re.Match) -> date | None:
    g = m.groupdict()
    year = int(g["y"]) if len(g["y"]) == 4 else 2000 + int(g["y"])
    try:
        return date(year, _MON.index(g["mon"].lower()) + 1 if g.get("mon") else int(g["m"]), int(g["d"]))
    except ValueError:
        return None


def _dates(stem: str) -> list[tuple[int, int, date]]:
    """Dates by place; where two forms overlap the more trusted one stays."""
    found: list[tuple[int, int, date]] = []
    for form in _DATES:
        for m in form.finditer(stem):
            if (d := _day(m)) and all(m.end() <= a or z <= m.start() for a, z, _ in found):
                found.append((m.start(), m.end(), d))
    return sorted(found)


def read_name(name: str | None) -> tuple:
    stem, notes, variants = re.sub(r"\.pdf\s*$", "", (name or "").strip(), flags=re.IGNORECASE).strip(), [], []
    if not stem:
        return ("", "", "", "", "", "", False, "", ["empty_filename"])
    redacted = bool(_REDACTED.search(stem))
    while m := _VARIANT.search(stem):
        variants.insert(0, m[0].strip())
        stem = stem[: m.start()].rstrip(" -_")
    variant = "".join(variants)
    text, day, rest = "", None, stem
    if m := _ARCHIVE.fullmatch(stem):
        if day := _day(m):
            return ("", "", "", stem, str(day), str(day.year), redacted, variant, ["archive_yymmdd_filename", "no_area_block_in_filename"])
        notes.append("archive_yymmdd_invalid")
    elif found := _dates(stem):
        if len(found) > 1:
            notes.append(f"multiple_date_tokens:{len(found)}")
        a, z, day = found[0]
        text, rest = stem[a:z], f"{stem[:a]} | {stem[z:]}"
    else:
        notes.append("no_date_token")
    lease = next((m for m in _LEASE.finditer(rest) if m["area"].upper() in AREAS), None)
    if lease:
        block = " ".join(x.upper() for x in (lease["lead"], lease["joined"] or lease["block"], lease["tail"]) if x)
        rest = f"{rest[: lease.start()]} {rest[lease.end() :]}"
    else:
        notes.append("no_area_block_in_filename")
    operator = " ".join(w for w in re.split(r"[^0-9A-Za-z&]+", rest) if w and w.lower() not in NOISE and not w.isdigit())
    if not operator:
        notes.append("no_operator_in_filename")
    return (lease["area"].upper() if lease else "", block if lease else "", operator, text, str(day or ""), str(day.year) if day else "", redacted, variant, notes)


def _read(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_name(n) for n in names], columns=[f.split(" ")[0] for f in FIELDS.split(", ")])


def report_name(name: Column) -> Column:
    """struct(area, block, operator, date_text, day, year, redacted, variant, notes)."""
    return pandas_udf(_read, FIELDS)(name)
