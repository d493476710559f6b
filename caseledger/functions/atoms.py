"""Multi-valued cells: atoms between `` - `` marks, precedence, bands and clauses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_atoms(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), " - "), lambda s: F.trim(F.regexp_replace(s, r"^[ -]+|[ -]+$", ""))), lambda s: s != "")


def band(value: Column, floors: Sequence[tuple[float, object]]) -> Column:
    """The first band whose floor the value reaches; floors in descending order; null below all."""
    out = None
    for low, name in floors:
        out = F.when(value >= low, F.lit(name)) if out is None else out.when(value >= low, F.lit(name))
    return out


def ceiling_band(value: Column, tops: Sequence[tuple[float | None, object]]) -> Column:
    """The first band whose top the value stays under; a top of None is open."""
    out = None
    for top, name in tops:
        hit = value.isNotNull() if top is None else value < top
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def rank_of(atom: Column, precedence: Sequence[str]) -> Column:
    """Position in the precedence list by case-insensitive substring; unlisted last.

    ``Scale`` stands for atoms with a dollar sign, ``Injury`` also for lost time and restricted work."""
    out = None
    for i, p in enumerate(precedence):
        if p == "Scale":
            hit = F.contains(atom, F.lit("$"))
        elif p == "Injury":
            hit = F.contains(atom, F.lit("Injury")) | atom.startswith("LTA") | atom.startswith("RW/JT")
        else:
            hit = F.contains(F.lower(atom), F.lit(p.lower()))
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out.otherwise(len(precedence))


def top_atom(atoms: Column, precedence: Sequence[str]) -> Column:
    """The atom of best precedence, first of equals; null for none."""
    ranked = F.transform(atoms, lambda a, i: F.struct(rank_of(a, precedence).alias("r"), i.alias("i"), a.alias("a")))
    return F.array_min(ranked)["a"]


def lookup(value: Column, table: dict[str, object]) -> Column:
    """A rule table of the plan as one CASE; null outside it."""
    out = None
    for k, v in table.items():
        out = F.when(value == k, F.lit(v)) if out is None else out.when(value == k, F.lit(v))
    return out


def resolve_types(atoms: Column, outcome: dict, scale: dict, mechanism: dict, response: Sequence[str], precedence: Sequence[str]) -> Column:
    """struct(type_a, type_b, type_c, type_d).

    Types B and C come from the best-ranked outcome or scale atom alone: a null there is a decision and never gives way to
    a later atom. Type D is the first value that a mechanism atom has. Any outcome, scale or mechanism atom makes a loss
    event; a response alone a near hit. outcome and scale: atom -> (B, C); mechanism: atom -> D."""
    both = {**scale, **outcome}
    keys = lambda *names: F.array(*[F.lit(n) for d in names for n in d]).cast("array<string>")
    top = top_atom(F.filter(atoms, lambda a: F.array_contains(keys(both), a)), precedence)
    first = F.get(F.filter(F.transform(atoms, lambda a: lookup(a, mechanism)), lambda d: d.isNotNull()), F.lit(0))
    happened, responded = F.arrays_overlap(atoms, keys(both, mechanism)), F.arrays_overlap(atoms, keys(response))
    return F.struct(
        F.when(happened, "Loss Event").when(responded, "Near Hit").alias("type_a"), lookup(top, {k: b for k, (b, _) in both.items()}).alias("type_b"),
        lookup(top, {k: c for k, (_, c) in both.items()}).alias("type_c"), first.alias("type_d"),
    )


#: Hazard energy, outcome floor and observed rate by atom; likelihood and class bands (fixed values).
ENERGY = {"Blowout": "E", "Explosion": "E", "Fire": "D", "Shutdown from Gas Release": "D", "Collision": "D", "Crane": "D", "Structural Damage": "D", "Pollution": "C"}
FLOOR = {"Fatality": "E", "LTA >3 days": "C", "LTA 1-3 days": "B", "RW/JT >3 days": "B", "Injury": "B", "RW/JT 1-3 days": "A"}
RATES = {"Crane": 0.241, "Explosion": 0.259, "Fire": 0.097, "Structural Damage": 0.083, "Shutdown from Gas Release": 0.028, "Pollution": 0.017}
LIKELIHOOD = ((0.20, 5), (0.10, 4), (0.05, 3), (0.01, 2), (0.0, 1))
CLASSES = ((21, "Very Serious Incident"), (11, "Serious Incident"), (1, "Incident"))
PRECEDENCE = ("Fatality", "Injury", "Pollution", "Structural Damage", "Scale")


def risk_matrix(atoms: Column, crewed: Column) -> Column:
    """struct(consequence, likelihood, score, class). Only listed mechanisms count; a crewed one rises by a letter below
    E; outcomes set a floor; without an observed rate there is a consequence alone."""
    worst = F.array_max(F.filter(F.transform(atoms, lambda a: lookup(a, ENERGY)), lambda x: x.isNotNull()))
    raised = F.when(crewed & (worst < "E"), F.translate(worst, "ABCD", "BCDE")).otherwise(worst)
    floor = F.array_max(F.filter(F.transform(atoms, lambda a: lookup(a, FLOOR)), lambda x: x.isNotNull()))
    cons = F.when(worst.isNotNull(), F.greatest(raised, floor))
    rate = F.array_max(F.filter(F.transform(atoms, lambda a: lookup(a, RATES).cast("double")), lambda x: x.isNotNull()))
    likely = F.when(cons.isNotNull(), band(rate, LIKELIHOOD))
    score = F.when(likely.isNotNull(), F.instr(F.lit("ABCDE"), cons)) * likely
    return F.struct(cons.alias("consequence"), likely.alias("likelihood"), score.alias("score"), band(score, CLASSES).alias("class"))
