"""Chat formatting: fingerprints of record layouts select declarative mappings to turns.

A record's layout is the set of its nested field paths (``messages[].role``). The hash
of the sorted paths is its fingerprint; the first record with a fingerprint selects the
mapping with the most paths among those whose paths it has, and later ones reuse it.
Mappings are data: which paths hold a role, a text or a list of messages.

The template marks turns with control strings. Inside roles and texts a backslash becomes
two, ``<|`` becomes ``<\\|``, and a line feed in a role becomes ``\\n``, so no text can hold a
control string and everything can be read back. Each turn gives a segment and the part of it
under the loss mask, so a conversation of any length streams through a task; a conversation
is its segments in order.

Defined results: null texts and roles are empty; records whose layout no mapping knows give
a row with a null layout, role and text, and no segment; turns are in the order of ``turn``
(nulls first), then place in the record, role and text, so ties and repeated rows all stay;
a null conversation id is an id of its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"

#: Names of roles in the layouts, and the canonical ones.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """``turns``: (role, path) of a record's texts in order; or a list of messages at ``each``.

    A role that starts with ``@`` is a path; below ``each``, paths start at a message.
    ``skip_empty`` leaves out turns whose text is missing or empty, such as an empty input.
    """

    name: str
    turns: tuple[tuple[str, str], ...]
    each: str | None = None
    aliases: bool = False
    skip_empty: bool = False
    optional: tuple[str, ...] = ()

    def paths(self) -> frozenset[str]:
        own = {p for role, path in self.turns for p in (path, role[1:] if role[0] == "@" else path)}
        own -= set(self.optional)
        return frozenset(f"{self.each}[].{p}" for p in own) if self.each else frozenset(own)


MAPPINGS = (
    Mapping("turn row", (("@role", "text"),)),
    Mapping("messages", (("@role", "content"),), each="messages", aliases=True),
    Mapping("messages with text", (("@role", "text"),), each="messages", aliases=True),
    Mapping("conversations", (("@from", "value"),), each="conversations", aliases=True),
    Mapping("prompt and completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")),
            skip_empty=True, optional=("system",)),
    Mapping("prompt and response", (("system", "system"), ("user", "prompt"), ("assistant", "response")),
            skip_empty=True, optional=("system",)),
    Mapping("question and answer", (("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", (("user", "instruction"), ("user", "input"), ("assistant", "output")),
            skip_empty=True, optional=("input",)),
)


def field_paths(value, at: str = "") -> Iterator[str]:
    if isinstance(value, dict):
        for key, below in value.items():
            yield from field_paths(below, f"{at}.{key}" if at else key)
    elif isinstance(value, list):
        yield f"{at}[]"
        for below in value:
            yield from field_paths(below, f"{at}[]")
    else:
        yield at


def fingerprint(record: dict) -> str:
    return hashlib.sha256("\n".join(sorted(set(field_paths(record)))).encode()).hexdigest()[:16]


def choose(record: dict, mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping | None:
    """The mapping with the most paths among those the record has; the first listed if several."""
    paths = set(field_paths(record))
    # An empty list of messages has no fields below it.
    fits = [m for m in mappings if m.paths() <= paths or m.each and record.get(m.each) == []]
    return max(fits, key=lambda m: len(m.paths()), default=None)


def _at(value, path: str):
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    found = []
    for item in (_at(record, mapping.each) or []) if mapping.each else [record]:
        for role, path in mapping.turns:
            text = _text(_at(item, path))
            name = _text(_at(item, role[1:])) if role[0] == "@" else role
            if text or not mapping.skip_empty:
                found.append((ROLES.get(name, name) if mapping.aliases else name, text))
    return found


TURNS = "conv_id long, turn long, place int, role string, text string, layout string"


def canonical(
    records: DataFrame, id_col: str = "conv_id", turn_col: str | None = "turn", json_col: str | None = None,
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """One row per turn of each record: ``conv_id``, ``turn``, ``place``, ``role``, ``text``, ``layout``.

    A record is the row itself, or the JSON object in ``json_col``.
    """
    fields = [F.col(f"`{c}`") for c in records.columns]
    body = F.col(json_col) if json_col else F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    rows = records.select(
        F.col(id_col).cast("long").alias("conv_id"),
        (F.col(turn_col).cast("long") if turn_col else F.lit(0).cast("long")).alias("turn"),
        body.alias("record"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Mapping | None] = {}
        for batch in slices(batches, 2000):
            out = []
            for conv, turn, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                try:
                    record = json.loads(text or "null")
                except ValueError:
                    record = None
                mapping = None
                if isinstance(record, dict):
                    mark = fingerprint(record)
                    if mark not in known:
                        known[mark] = choose(record, mappings)
                    mapping = known[mark]
                if mapping is None:
                    out.append((conv, turn, 0, None, None, None))
                    continue
                out += [
                    (conv, turn, k, role, said, mapping.name)
                    for k, (role, said) in enumerate(turns_of(record, mapping))
                ]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv_id", "turn", "place", "role", "text", "layout"],
            )

    return rows.mapInArrow(run, TURNS)


def _escaped(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def formatted(turns: DataFrame) -> DataFrame:
    """``turns`` with their ``segment`` and its part under the loss mask: ``loss_start``, ``loss_end``.

    Code points from the segment's start, end exclusive; both null where no loss is taken.
    """
    role = F.replace(_escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    text = _escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    known = F.col("layout").isNotNull()
    learned = known & (F.col("role") == "assistant")
    return turns.select(
        "conv_id", "turn", "place",
        F.when(known, F.concat(head, text, F.lit(END + "\n"))).alias("segment"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(text)).alias("loss_end"),
    )


_SEGMENT = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    found = _SEGMENT.fullmatch(segment)
    return unescape(found[1]), unescape(found[2])


class _Digest:
    """What is read back of one conversation, segment by segment."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        role, text = read_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            learned = unescape(segment[start:end])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode("utf-8", "surrogatepass"))


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation: what is read back from its segments.

    Rows are sorted within partitions by conversation and turn and streamed, so a task
    holds one segment and two running digests, however long a conversation is.
    """
    ordered = segments.where(F.col("segment").isNotNull()).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "place", "segment"
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(done):
        flat = [(c, d.turns, d.all.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars) for c, d in done]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            columns = (batch.column(k).to_pylist() for k in ("conv_id", "segment", "loss_start", "loss_end"))
            for conv, segment, start, end in zip(*columns):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = conv, _Digest()
                state.add(segment, start, end)
            if done:
                yield rows(done)
        if state is not None:
            yield rows([(now, state)])

    return ordered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
