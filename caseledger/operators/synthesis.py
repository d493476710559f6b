"""Synthetic columns of an incident, in one select: identities, dates, status, severity and title.

Every draw is sha256(identifier + salt); nothing reads the clock. A row without a usable date gets no value at all and the
reason why.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseledger.functions.dates import status_by_age
from caseledger.functions.hashing import draw
from caseledger.functions.text import is_blank
from caseledger.operators.records import identity, incident_title


@dataclass(frozen=True)
class Rules:
    """Fixed rule values: role -> (salt, label, position); date -> (the one it rests on, least and most days); tiers and bands."""

    frozen: str = "2026-08-09"
    roles: Mapping[str, tuple[str, str, str]] = field(default_factory=lambda: {
        "investigation_lead": ("lead", "Investigator", "Synthetic Role — Investigation Lead"),
        "incident_classified_by": ("classified_by", "Classifier", "Synthetic Role — Incident Classifier"),
        "investigation_acceptor": ("acceptor", "Acceptor", "Synthetic Role — Investigation Acceptor"),
        "close_out_approval": ("close_out", "Approver", "Synthetic Role — Close-Out Approver"),
        "responsible_owner": ("owner", "Owner", "Synthetic Role — Responsible Owner"),
    })
    dates: Mapping[str, tuple[str, int, int]] = field(default_factory=lambda: {
        "date_of_report": ("incident_date", 5, 15), "approval_date": ("date_of_report", 14, 45), "close_out_date": ("approval_date", 30, 90),
        "action_due_date": ("approval_date", 30, 180), "agreed_completion_date": ("approval_date", 30, 180),
    })
    schedule_salt: str = "schedule_status"
    tiers: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"Very Serious": ("Fatality", "Blowout", "Explosion"), "Serious": ("Injury", "LWC", "Fire", "Collision")})
    scores: Mapping[str, int] = field(default_factory=lambda: {"Very Serious": 9, "Serious": 5, "Incident": 2})
    harm: tuple[str, ...] = ("Fatality", "Injury")
    pollution: str = "Pollution"
    money: tuple[tuple[str, int | None, int], ...] = (("Minor", 25_000, 2), ("Moderate", 500_000, 5), ("Major", None, 9))
    relief: int = 2
    floor: int = 1


def _has(types: Column, names: tuple[str, ...]) -> Column:
    return F.arrays_overlap(types, F.array(*[F.lit(n) for n in names]))


def severity(types: Column, damage: Column, r: Rules | None = None) -> dict[str, Column]:
    """Tier, scores and bands of an incident's types and damage, by name; what cannot be told is Unknown or null."""
    r = r or Rules()
    tier = F.when(F.size(types) > 0, F.lit("Incident"))
    for name in ("Serious", "Very Serious"):
        tier = F.when(_has(types, r.tiers[name]), name).otherwise(tier)
    score = F.when(tier.isNull(), F.lit(None).cast("int"))
    for name, value in r.scores.items():
        score = score.when(tier == name, value)
    polluted = F.array_contains(types, r.pollution)
    band, worth = F.when(damage.isNull(), "Unknown"), F.when(damage.isNull(), F.lit(None).cast("int"))
    for name, most, value in r.money:
        within = F.lit(True) if most is None else damage <= most
        band, worth = band.when(within, name), worth.when(within, value)
    return {
        "incident_classification": F.coalesce(tier, F.lit("Unknown")),
        "worst_reasonable_outcome": F.coalesce(tier, F.lit("Unknown")),
        "involves_fatality_or_injury": _has(types, r.harm),
        "hs_risk_score": score,
        "environment_reputation_classification": F.when(tier.isNull(), "Unknown").when(polluted, tier).otherwise("None"),
        "environment_reputation_score": F.when(tier.isNull() | polluted, score).otherwise(0),
        "financial_classification": band,
        "financial_score": worth,
        "unmitigated_risk_score": score,
        "mitigated_risk_score": F.when(score.isNotNull(), F.greatest(score - r.relief, F.lit(r.floor))),
    }


def synthesize(df: DataFrame, ident: str, day: str, types: str, damage: str, site: str, rules: Rules | None = None) -> DataFrame:
    """df plus 28 ``syn_`` columns, ``anomalies`` (types of what could not be resolved) and ``skipped``.

    ``day`` is ISO text: blank or null skips the row as ``no_incident_date``, another text or no real day as
    ``unparseable_date``; all other new columns of a skipped row are null. Null and blank types count as absent, repeated ones
    once; no type at all and null damage are anomalies, not errors."""
    r = rules or Rules()
    key, raw = F.col(ident).cast("string"), F.trim(F.col(day))
    parsed = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(raw, "yyyy-MM-dd"))
    known = F.array_distinct(F.filter(F.coalesce(F.col(types), F.array().cast("array<string>")), lambda x: x.isNotNull() & ~is_blank(x)))
    fields: dict[str, Column] = {}
    for role, (salt, label, position) in r.roles.items():
        fields[f"{role}_name"], fields[f"{role}_position"] = identity(key, label, salt), F.lit(position)
    # One column a date, so that a date that others rest on is drawn once.
    held = df.withColumn("_on_incident_date", parsed)
    for name, (base, low, high) in r.dates.items():
        held = held.withColumn(f"_on_{name}", F.date_add(F.col(f"_on_{base}"), F.lit(low) + draw(high - low + 1, key, name, sep="").cast("int")))
    fields |= {name: F.col(f"_on_{name}") for name in r.dates}
    status = status_by_age(parsed, F.lit(r.frozen).cast("date"))
    fields["action_status"] = status
    fields["schedule_status"] = F.when(status == "Completed", "N/A").when(draw(2, key, r.schedule_salt, sep="") == 0, "On Schedule").otherwise("Behind")
    fields |= severity(known, F.col(damage), r)
    fields["incident_title"] = F.concat(incident_title(known), F.lit(" incident at "), F.trim(F.coalesce(F.col(site), F.lit(""))))
    odd = F.array_compact(F.array(F.when(F.size(known) == 0, "unresolved_incident_classification"), F.when(F.col(damage).isNull(), "unresolved_property_damage")))
    skipped = F.when(F.coalesce(raw, F.lit("")) == "", "no_incident_date").when(parsed.isNull(), "unparseable_date")
    made = {f"syn_{name}": F.when(parsed.isNotNull(), value) for name, value in fields.items()}
    return held.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in made.items()], F.when(parsed.isNotNull(), odd).alias("anomalies"), skipped.alias("skipped"))
