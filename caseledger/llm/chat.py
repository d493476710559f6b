r"""Chat formatting: a finite-state machine over roles and a declarative template with per-segment loss flags.

Rows are dealt by conversation, sorted by (turn, role, text) and streamed: the machine checks the order of roles and
emits text segments, each flagged for the loss; a reader parses the formatted segments back. Memory is bounded by one
turn, not by one conversation.

Inside texts the template's control characters are written as escapes (``\`` as ``\\``, ``<`` as ``\l``, ``#`` as ``\h``,
``:`` in roles as ``\c``), so no control string can occur there and the reader restores every text exactly.

Defined results: a null text is empty; a null role is empty and breaks the order; rows of null conversation form one
conversation with a null identifier; equal turn numbers are taken in order of role and text; repeated rows are repeated
turns; a conversation that breaks the order is still formatted, with ``valid`` false and its first bad turn's index
(-1 if none); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Segments of a turn in order: literal, or ``{role}`` / ``{text}``; and the machine's transitions."""

    segments: tuple[str, ...] = ("### ", "{role}", ":\n", "{text}", "</turn>\n")
    loss_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user", ("user", "assistant"): "assistant", ("assistant", "user"): "user",
            ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant",
        }
    )
    final: frozenset[str] = frozenset({"assistant"})


ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h", ":": "\\c"}
_TO = str.maketrans({k: v for k, v in ESCAPES.items() if k != ":"})
_TO_ROLE = str.maketrans(ESCAPES)
_BACK = {v[1]: k for k, v in ESCAPES.items()}


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    first, *parts = text.split("\\")
    out, parts = [first], iter(parts)
    for p in parts:
        if p:
            out += [_BACK[p[0]], p[1:]]
        else:  # an escaped backslash: the split left an empty part, and what follows is plain
            out += ["\\", next(parts, "")]
    return "".join(out)


def format_turn(role: str, text: str, template: Template) -> Iterator[tuple[str, bool]]:
    """(segment, counts for the loss) of one turn."""
    for s in template.segments:
        if s == "{role}":
            yield role.translate(_TO_ROLE), False
        elif s == "{text}":
            yield text.translate(_TO), role in template.loss_roles
        else:
            yield s, False


def read_turn(formatted: str, template: Template) -> tuple[str, str]:
    """(role, text) of one formatted turn, by the template's literals alone."""
    found, at = {}, 0
    parts = template.segments
    for i, s in enumerate(parts):
        if s in ("{role}", "{text}"):
            end = formatted.index(parts[i + 1], at)
            found[s], at = unescape(formatted[at:end]), end
        else:
            if not formatted.startswith(s, at):
                raise ValueError("not a formatted turn")
            at += len(s)
    return found["{role}"], found["{text}"]


def render(segments: list[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string and its loss mask: the ranges of code points that count for the loss."""
    at, mask = 0, []
    for s, flag in segments:
        if flag:
            mask.append((at, at + len(s)))
        at += len(s)
    return "".join(s for s, _ in segments), mask


class Conversation:
    """Running digests of one conversation, all of them taken from the formatted string and its mask, read back."""

    def __init__(self, ident, template: Template):
        self.ident, self.template, self.state = ident, template, template.start
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.bad: int | None = None

    def add(self, role: str, text: str) -> None:
        moved = self.template.moves.get((self.state, role))
        if moved is None and self.bad is None:
            self.bad = self.n
        self.state = moved or role
        self.read(*render(list(format_turn(role, text, self.template))))

    def read(self, formatted: str, mask: list[tuple[int, int]]) -> None:
        self.chars += len(formatted)
        role, text = read_turn(formatted, self.template)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for start, end in mask:
            plain = unescape(formatted[start:end])
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.n += 1

    def row(self) -> tuple:
        return self.ident, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.bad is None and self.state in self.template.final, -1 if self.bad is None else self.bad


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, bad_turn long"
_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("bad_turn", pa.int64())])


def _by_conversation(rows: DataFrame) -> DataFrame:
    dealt = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return dealt.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_digests(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation with the digests of its formatted form, read back."""
    template = template or Template()

    def run(batches):
        now = None
        done: list[tuple] = []
        for b in batches:
            for ident, role, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if now is None or ident != now.ident:
                    if now:
                        done.append(now.row())
                    now = Conversation(ident, template)
                now.add(role, text)
            if len(done) > 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
                done = []
        if now:
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), _ARROW.types, strict=True)], schema=_ARROW)

    return _by_conversation(rows).mapInArrow(run, SCHEMA)


def format_segments(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, turn_index, segment_index, text, loss): the segments themselves, in order."""
    template = template or Template()
    kinds = pa.schema([("conv_id", pa.int64()), ("turn_index", pa.int64()), ("segment_index", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])

    def run(batches):
        last, n, seen = None, 0, False
        for b in batches:
            out = []
            for ident, role, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                n = n + 1 if seen and ident == last else 0
                last, seen = ident, True
                out += [(ident, n, i, s, flag) for i, (s, flag) in enumerate(format_turn(role, text, template))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds.types, strict=True)], schema=kinds)

    return _by_conversation(rows).mapInArrow(run, "conv_id long, turn_index long, segment_index long, text string, loss boolean")
