"""Numbered form text: anchors confirmed by their labels, what is odd about them, fields cut between them, revisions.

A document is its lines in order. An anchor is a number, a point and a label, anywhere in a line. Its label counts more
than its number: where the number's own field does not name that label, the longest listed label that opens the text
decides. All of this is expressions over a line; only first occurrences meet by (document, field), of which a document has
as many as its form has fields, so that a document of any length is dealt over its lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A number of one or two digits, a point, white space, then a capital or a bracket (fixed pattern).
ANCHOR = r"(?<!\S)(\d{1,2})\s*\.\s+(?=[A-Z(])"
#: Characters after an anchor that its label is looked for in, and characters of a line that a report shows.
TAIL, SHOWN = 90, 120


@dataclass(frozen=True)
class FormField:
    """A field of a form: its labels, any of which confirms it (none: any text does), and its kind."""

    name: str
    labels: Sequence[str] = ()
    kind: str = "text"


@dataclass(frozen=True)
class Form:
    """A form as data. ``limits`` are lengths by kind, ``cap`` holds for the last field of a document where its kind has none;
    ``furniture`` are patterns of whole lines, ``watermarks`` of parts of lines, ``bleed`` of label text inside a field's
    own text. ``depth_label`` and ``depth_numbers`` tell revisions apart, and ``third_labels`` those that share a number."""

    fields: Mapping[int, FormField]
    limits: Mapping[str, int] = field(default_factory=dict)
    cap: int = 20_000
    furniture: Sequence[str] = ()
    watermarks: Sequence[str] = ()
    bleed: Sequence[str] = ()
    depth_label: str = ""
    depth_numbers: Mapping[int, str] = field(default_factory=dict)
    third_labels: Mapping[str, str] = field(default_factory=dict)

    def label_field(self, tail: Column) -> Column:
        """The field that a text names: the longest label that opens it, of equally long ones the first listed."""
        listed = sorted([(label.upper(), n) for n, f in self.fields.items() for label in f.labels], key=lambda x: -len(x[0]))
        if not listed:
            return F.lit(None).cast("int")
        hints = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(n).alias("n")) for label, n in listed])
        opens = F.array(F.ltrim(F.upper(tail), F.lit(" .:-")))
        return F.element_at(F.transform(opens, lambda x: F.try_element_at(F.filter(hints, lambda h: x.startswith(h["label"])), F.lit(1))["n"]), 1)

    def confirmed(self, printed: Column, tail: Column) -> Column:
        """Whether the printed number's own field has a label in the text, or needs none."""
        # Labels by number as data: a chain of conditions would make one method too large for the JVM to compile.
        own = F.map_from_arrays(F.array(*map(F.lit, self.fields)), F.array(*[F.array(*[F.lit(x.upper()) for x in f.labels or [""]]) for f in self.fields.values()]))
        labels = F.coalesce(F.try_element_at(own, printed), F.array().cast("array<string>"))
        return F.coalesce(F.element_at(F.transform(F.array(F.upper(tail)), lambda x: F.exists(labels, lambda label: x.contains(label))), 1), F.lit(False))

    def limit(self, number: int) -> int:
        return self.limits.get(self.fields[number].kind, self.cap)


def clean_lines(lines: DataFrame, form: Form, text: str = "text") -> DataFrame:
    """Lines without watermarks and furniture, white space squeezed; lines that end up blank go."""
    c = F.trim(F.col(text))
    for p in form.watermarks:
        c = F.regexp_replace(c, p, " ")
    c = F.trim(F.regexp_replace(c, r"\s{2,}", " "))
    page = "^(?:" + "|".join(f"(?:{p})" for p in form.furniture) + ")"
    kept = F.filter(F.array(c), lambda x: (x != "") & ~x.rlike(page) if form.furniture else x != "")
    return _each(lines.withColumn("_kept", kept), "_kept", text).select(*lines.columns)


def _each(d: DataFrame, array: str, name: str) -> DataFrame:
    """An element a row. What makes the array is run once: filters on a plain column, as those that a plain explode is given,
    move below it and run its expressions again."""
    return d.select(*[c for c in d.columns if c not in (array, name)], F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def printed_anchors(lines: DataFrame, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """(doc, line, k, printed, start, tail, text): every anchor of every line, k counting within the line and ``start`` its
    zero-based place."""
    d = lines.select(doc, line, text).filter(F.col(text).rlike(ANCHOR))
    d = d.withColumns({"_m": F.regexp_extract_all(text, F.lit(ANCHOR), F.lit(0)), "_p": F.split(text, ANCHOR, -1)})
    size = lambda array, n: F.aggregate(F.slice(array, 1, n), F.lit(0), lambda a, x: a + F.length(x))
    found = F.transform(
        F.sequence(F.lit(1), F.size("_m")),
        lambda k: F.struct(k.alias("k"), F.regexp_extract(F.element_at("_m", k), r"\d+", 0).cast("int").alias("printed"), (size("_p", k) + size("_m", k - 1)).alias("start"), F.length(F.element_at("_m", k)).alias("n")),
    )
    d = _each(d.select(doc, line, text, found.alias("_x")), "_x", "x")
    return d.select(doc, line, "x.k", "x.printed", "x.start", F.substring(F.col(text), F.col("x.start") + F.col("x.n") + 1, F.lit(TAIL)).alias("tail"), text)


def resolved_anchors(lines: DataFrame, form: Form, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """Printed anchors that name a field of the form, with that ``field`` and ``turn``, which is 1 for a field's first one."""
    a = printed_anchors(lines, doc, line, text).filter(F.col("printed").between(1, max(form.fields)))
    own = form.confirmed(F.col("printed"), F.col("tail"))
    a = a.withColumn("field", F.when(own, F.col("printed")).otherwise(form.label_field(F.col("tail")))).filter("field is not null")
    return a.withColumn("turn", F.row_number().over(Window.partitionBy(doc, "field").orderBy(line, "k")))


def accepted_anchors(resolved: DataFrame, doc: str = "doc", line: str = "line") -> DataFrame:
    """Each field's first anchor, with the highest field before it in the document (0: none)."""
    before = Window.partitionBy(doc).orderBy(line, "k").rowsBetween(Window.unboundedPreceding, -1)
    return resolved.filter("turn = 1").withColumn("highest", F.coalesce(F.max("field").over(before), F.lit(0)))


def anchor_anomalies(resolved: DataFrame, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """(doc, line, k, type, field, other, shown): renumbered anchors (other: the printed number), repeated fields, and
    fields after a higher one (other: that one). Reported only: an anchor out of order keeps its field."""
    row = lambda d, kind, other: d.select(doc, line, "k", F.lit(kind).alias("type"), "field", other.cast("int").alias("other"), F.substring(text, 1, SHOWN).alias("shown"))
    one = lambda when, kind, other: F.when(when, F.struct(F.lit(kind).alias("type"), other.cast("int").alias("other")))
    odd = F.array_compact(F.array(one(F.col("printed") != F.col("field"), "anchor_renumbered", F.col("printed")), one(F.col("turn") > 1, "duplicate_anchor", F.lit(None))))
    out = _each(resolved.select(doc, line, "k", "field", F.substring(text, 1, SHOWN).alias("shown"), odd.alias("_odd")), "_odd", "x")
    return out.select(doc, line, "k", "x.type", "field", "x.other", "shown").unionByName(row(accepted_anchors(resolved, doc, line).filter("field < highest"), "out_of_order_anchor", F.col("highest")))


def form_revision(lines: DataFrame, form: Form, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """(doc, revision) of every document: the number under which the depth label is printed first, and where revisions share
    it, the label printed first under 3; without that label the first of those revisions. Anchors that no field confirms
    count here. ``depth_numbers`` gives a revision's name, or the names that share the number, in order."""
    a = printed_anchors(lines, doc, line, text)
    up = F.upper("tail")
    verdict = F.lit(None).cast("string")
    for n, name in form.depth_numbers.items():
        verdict = F.when(F.col("printed") == n, name).otherwise(verdict)
    verdict = F.when(up.contains(form.depth_label.upper()), verdict)
    at = lambda value, when: F.min(F.when(when, F.struct(line, "k", value.alias("v"))))["v"]
    per = a.groupBy(doc).agg(at(verdict, verdict.isNotNull()).alias("_v"), at(up, F.col("printed") == 3).alias("_third"))
    third = F.lit(None).cast("string")
    for label, name in reversed(form.third_labels.items()):
        third = F.when(F.col("_third").contains(label.upper()), name).otherwise(third)
    shared = F.length("_v") > 1
    named = F.when(F.col("_v").isNotNull() & ~shared, F.col("_v")).when(third.isNotNull(), third).when(shared & F.col("_third").isNull(), F.substring("_v", 1, 1)).otherwise("unknown")
    docs = lines.select(doc).distinct()
    return docs.join(per.select(doc, named.alias("revision")), doc, "left").select(doc, F.coalesce("revision", F.lit("unknown")).alias("revision"))


def line_parts(lines: DataFrame, accepted: DataFrame, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """(doc, field, line, start, part, opens, last): what each line gives to which field. A document's anchors, as many as
    its form has fields at most, meet its lines by the document; ``last`` marks the document's last field."""
    spots = F.sort_array(F.collect_list(F.struct(F.col(line).alias("line"), F.col("start"), F.col("field"))))
    marks = accepted.groupBy(doc).agg(spots.alias("_a"))
    d = lines.select(doc, line, text).join(marks, doc)
    before = F.try_element_at(F.filter("_a", lambda a: a["line"] < F.col(line)), F.lit(-1))
    here = F.filter("_a", lambda a: a["line"] == F.col(line))
    d = d.withColumns({"_b": before, "_h": here, "_last": F.element_at("_a", -1)["field"]})
    head = F.struct(F.col("_b.field").alias("field"), F.lit(0).alias("start"), F.coalesce(F.try_element_at("_h", F.lit(1))["start"], F.length(text)).alias("end"), F.lit(False).alias("opens"))
    rest = F.transform("_h", lambda a, i: F.struct(a["field"].alias("field"), a["start"].alias("start"), F.coalesce(F.get("_h", i + 1)["start"], F.length(text)).alias("end"), F.lit(True).alias("opens")))
    parts = F.filter(F.concat(F.array(head), rest), lambda p: p["field"].isNotNull())
    d = _each(d.select(doc, line, text, "_last", parts.alias("_p")), "_p", "p")
    return d.select(doc, "p.field", line, "p.start", F.substring(F.col(text), F.col("p.start") + 1, F.col("p.end") - F.col("p.start")).alias("part"), "p.opens", (F.col("p.field") == F.col("_last")).alias("last"))


def form_fields(lines: DataFrame, form: Form, doc: str = "doc", line: str = "line", text: str = "text") -> DataFrame:
    """(doc, field, body, bled, overflow): a field's text from its anchor to the next, without its label up to a colon on
    the first line and without label text inside it (``bled`` pieces); lines stay lines. The document's last field is cut at
    its kind's limit and the rest kept in ``overflow``, null where nothing was cut."""
    parts = line_parts(lines, accepted_anchors(resolved_anchors(lines, form, doc, line, text), doc, line), doc, line, text)
    opened = F.when(F.col("opens") & F.col("part").contains(":"), F.regexp_replace("part", r"^[^:]*:", "")).otherwise(F.col("part"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(line).alias("line"), F.col("start"), opened.alias("part"))))
    d = parts.groupBy(doc, "field").agg(F.trim(F.array_join(F.transform(rows, lambda r: r["part"]), "\n")).alias("body"), F.first("last").alias("last"))
    bled = F.lit(0)
    for p in form.bleed:
        d = d.withColumn("bled", bled + F.size(F.regexp_extract_all("body", F.lit(f"(?i){p}"), F.lit(0)))).withColumn("body", F.regexp_replace("body", f"(?i){p}", " "))
        bled = F.col("bled")
    d = d.withColumn("bled", bled)
    tidy = F.filter(F.transform(F.split("body", r"\R"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    d = d.withColumn("body", F.array_join(tidy, "\n"))
    cap = F.lit(form.cap)
    for n in form.fields:
        cap = F.when(F.col("field") == n, form.limit(n)).otherwise(cap)
    over = F.col("last") & (F.length("body") > cap)
    kept = F.when(over, F.substring(F.col("body"), F.lit(1), cap)).otherwise(F.col("body"))
    return d.select(doc, "field", kept.alias("body"), "bled", F.when(over, F.substring(F.col("body"), cap + 1, F.length("body"))).alias("overflow"))


def field_anomalies(fields: DataFrame, docs: DataFrame, form: Form, doc: str = "doc") -> DataFrame:
    """(doc, type, field, n): bled label text, a last field cut, a field longer than its kind allows (n: pieces, or
    characters), and per document the number of fields not found; ``no_anchors_found`` where there are none."""
    one = lambda when, kind, number, n: F.when(when, F.struct(F.lit(kind).alias("type"), number.cast("int").alias("field"), n.cast("long").alias("n")))
    limits = F.lit(None).cast("int")
    for k, f in form.fields.items():
        if f.kind in form.limits:
            limits = F.when(F.col("field") == k, form.limits[f.kind]).otherwise(limits)
    number = F.col("field")
    # All of a document's reports are at most four a field, so the fields are cut once and met once by their documents.
    odd = F.array_compact(F.array(
        one(F.col("bled") > 0, "label_bleed_stripped", number, F.col("bled")), one(F.col("_over").isNotNull(), "terminal_anchor_truncated", number, F.col("_over")), one(F.col("_size") > limits, "field_length_exceeded", number, F.col("_size")),
    ))
    sizes = fields.select(doc, "field", "bled", F.length("overflow").alias("_over"), F.length("body").alias("_size"))
    per = sizes.select(doc, odd.alias("_odd")).groupBy(doc).agg(F.count("*").alias("_n"), F.flatten(F.collect_list("_odd")).alias("_odd"))
    missing = F.lit(len(form.fields)) - F.col("_n")
    whole = F.array_compact(F.array(one(missing > 0, "fields_not_located", F.lit(None), missing), one(F.col("_n").isNull(), "no_anchors_found", F.lit(None), F.lit(0))))
    seen = docs.select(doc).distinct().join(per, doc, "left")
    rows = _each(seen.select(doc, F.concat(F.coalesce("_odd", F.array()), whole).alias("_odd")), "_odd", "x")
    return rows.select(doc, "x.type", "x.field", "x.n")
