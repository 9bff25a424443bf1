"""Records of many layouts to one chat template, and back.

A record is a JSON text. The paths of its fields, lists written ``[]``, are sorted
and hashed; the hash, the fingerprint of its schema, selects a declared layout,
which says where the turns are and what their roles are called. Turns are put
into a template that marks them; control strings inside texts are escaped, so
that the template can be read back exactly.

Layouts and escapes are worked out row by row, wherever a row lies. Then the turns of
a conversation meet in one task, sorted; they are streamed through it and leave as parts
of about a million code points (or one turn), so a very long
conversation is never held as a whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import pieces

START, END = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1_000_000
#: what roles are called elsewhere
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
              "model": "assistant"}


@dataclass(frozen=True)
class Turn:
    """Turns that a layout holds: ``each`` is the path of their list ('' for the record
    itself); ``role`` a path (``@role``) or a role; ``texts`` paths below
    ``each``, joined by an empty line where filled."""

    role: str
    texts: tuple[str, ...]
    each: str = ""


@dataclass(frozen=True)
class Layout:
    """The field paths of a record and the turns they hold. Any of ``optional`` may be missing."""

    name: str
    turns: tuple[Turn, ...]
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()

    def fingerprints(self) -> Iterator[str]:
        for n in range(len(self.optional) + 1):
            for some in combinations(self.optional, n):
                yield fingerprint_of({*self.paths, *some})


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the leaves of a JSON value; an empty object or list, a null and a
    scalar are leaves."""
    if isinstance(value, dict) and value:
        return set().union(
            *(field_paths(v, f"{at}.{_name(k)}" if at else _name(k)) for k, v in value.items())
        )
    if isinstance(value, list) and value:
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return {at}


def _name(key: str) -> str:
    """A key whose dots, brackets and line ends cannot be taken for structure."""
    return re.sub(r"[\\.\[\]\n]", lambda m: f"\\{ord(m[0]):02x}", key)


LAYOUTS = (
    Layout("turn row", (Turn("@role", ("text",)),), ("role", "text")),
    Layout("prompt and completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",))),
           ("prompt", "completion")),
    Layout("prompt and response", (Turn("user", ("prompt",)), Turn("assistant", ("response",))),
           ("prompt", "response")),
    Layout("question and answer",
           (Turn("system", ("system",)), Turn("user", ("question",)), Turn("assistant", ("answer",))),
           ("question", "answer"), ("system",)),
    Layout("instruction",
           (Turn("system", ("system",)), Turn("user", ("instruction", "input")),
            Turn("assistant", ("output",))),
           ("instruction", "output"), ("input", "system")),
    Layout("messages", (Turn("@role", ("content",), "messages[]"),),
           ("messages[].role", "messages[].content")),
    Layout("no messages", (), ("messages",)),
    Layout("messages in parts", (Turn("@role", ("content[].text",), "messages[]"),),
           ("messages[].role", "messages[].content[].type", "messages[].content[].text")),
    Layout("from and value",
           (Turn("system", ("system",)), Turn("@from", ("value",), "conversations[]")),
           ("conversations[].from", "conversations[].value"), ("system",)),
)


def registry(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """Layout by fingerprint. Two layouts with one schema are refused."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for fingerprint in layout.fingerprints():
            if found.setdefault(fingerprint, layout) is not layout:
                raise ValueError(f"{layout.name} and {found[fingerprint].name} have one schema")
    return found


def _values(value, path: str) -> list:
    """All values at a path; lists on the way are gone through."""
    for step in path.split(".") if path else ():
        name = step.removesuffix("[]")
        value = [v[name] for v in _listed(value) if isinstance(v, dict) and name in v]
        if step.endswith("[]"):
            value = [x for v in value for x in _listed(v)]
    return _listed(value)


def _listed(value) -> list:
    return value if isinstance(value, list) else [value]


def _text(value) -> str:
    if value is None:
        return ""
    if not isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    try:
        value.encode()
        return value
    except UnicodeEncodeError:  # half a surrogate pair, written as an escape
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def turns_of(record, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) in order. An optional field that is missing gives no turn; a
    null text is empty, a null role has no name."""
    found = []
    for turn in layout.turns:
        for item in _values(record, turn.each):
            at = [_values(item, path) for path in turn.texts]
            if not turn.each and turn.texts[0] in layout.optional and not at[0]:
                continue
            role = turn.role
            if role.startswith("@"):
                role = _text(next(iter(_values(item, role[1:])), None))
            parts = [_text(value) for values in at for value in values]
            text = "\n\n".join(p for p in parts if p) if len(parts) > 1 else "".join(parts)
            found.append((ROLE_NAMES.get(role, role), text))
    return found


def canonical_turns(
    records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS, ignored: tuple[str, ...] = ()
) -> DataFrame:
    """conv_id, turn, item, role, text, layout, fingerprint from records (conv_id,
    turn, record): one row per turn of a record, ``item`` numbering them.

    ``ignored`` names top-level fields that say nothing about the layout. A record whose
    fingerprint no layout has, or that is no JSON (no fingerprint), gives one row without
    layout, role and text, so nothing goes missing; ``format_chats`` leaves such rows out.
    A record without turns gives no row.
    """
    rows = records.select("conv_id", F.col("turn").cast("long").alias("turn"), "record")
    known = registry(layouts)

    def read(text: str | None) -> list[tuple]:
        try:
            record = json.loads(text) if text is not None else None
        except ValueError:
            return [(0, None, None, None, None)]
        if not isinstance(record, dict):
            return [(0, None, None, None, None)]
        record = {k: v for k, v in record.items() if k not in ignored}
        fingerprint = fingerprint_of(field_paths(record))
        layout = known.get(fingerprint)
        if layout is None:
            return [(0, None, None, None, fingerprint)]
        return [
            (i, role, text, layout.name, fingerprint)
            for i, (role, text) in enumerate(turns_of(record, layout))
        ]

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [read(text) for text in batch.column(2).to_pylist()]
            at = pa.array([i for i, some in enumerate(found) for _ in some], pa.int64())
            item, role, text, layout, fingerprint = (
                [row[k] for some in found for row in some] for k in range(5)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(item, pa.int64()),
                 *(pa.array(x, pa.string()) for x in (role, text, layout, fingerprint))],
                ["conv_id", "turn", "item", "role", "text", "layout", "fingerprint"],
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        read_all,
        f"conv_id {kind}, turn long, item long, role string, text string, layout string, "
        "fingerprint string",
    )


def escape(text: str) -> str:
    """Put a backslash into everything that looks like a control string or an
    escaped one, so that ``<|`` is found in marks only."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_chats(
    turns: DataFrame, trained_role: str = "assistant", part_chars: int = PART_CHARS
) -> DataFrame:
    """conv_id, part, text, loss: the formatted conversation, its parts in order.

    ``turns`` is (conv_id, turn, item, role, text[, layout]); rows without layout are left
    out. Rows go by turn (nulls first), item, then role and text for ties; repeated rows are
    repeated turns. ``loss`` lists (start, length) in code points of the part's text, one
    for each text of ``trained_role``: the escaped text without marks. A part holds the turns
    that fit into ``part_chars`` code points, one at least. The parts of a
    conversation put together are its formatted text. They lie side by side in one
    partition, in order. No turns, no rows.
    """
    if "layout" in turns.columns:
        turns = turns.filter("layout IS NOT NULL")
    rows = turns.select(
        "conv_id", "turn", "item", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "item", "role", "text")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = _Part(part_chars)
        for batch in pieces(batches):
            done = []
            columns = [batch.column(i).to_pylist() for i in (0, 3, 4)]
            for conv_id, role, text in zip(*columns):
                if not part.takes(conv_id, len(text)):
                    if part.chunks:
                        done.append(part.row())
                    part.begin(conv_id)
                part.add(role, text, role == trained_role)
            yield from _parts(done, batch.schema.field(0).type)
            id_type = batch.schema.field(0).type
        if part.chunks:
            yield from _parts([part.row()], id_type)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        assemble,
        f"conv_id {kind}, part long, text string, loss array<struct<start:long,length:long>>",
    )


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _parts(rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        ids, nos, texts_, loss = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array(nos, pa.int64()), pa.array(texts_, pa.string()),
             pa.array(loss, _LOSS)],
            ["conv_id", "part", "text", "loss"],
        )


class _Part:
    """The part that is being filled."""

    def __init__(self, limit: int):
        self.limit = limit
        self.conv_id, self.no, self.chunks, self.loss, self.size = None, -1, [], [], 0

    def takes(self, conv_id, more: int) -> bool:
        return bool(self.chunks) and conv_id == self.conv_id and self.size + more <= self.limit

    def begin(self, conv_id) -> None:
        self.no = self.no + 1 if conv_id == self.conv_id else 0
        self.conv_id, self.chunks, self.loss, self.size = conv_id, [], [], 0

    def add(self, role: str, text: str, trained: bool) -> None:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if trained:
            self.loss.append({"start": self.size + len(head), "length": len(body)})
        chunk = f"{head}{body}{END}\n"
        self.chunks.append(chunk)
        self.size += len(chunk)

    def row(self) -> tuple:
        return self.conv_id, self.no, "".join(self.chunks), self.loss


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def read_part(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text; anything else is refused."""
    found, at = [], 0
    while at < len(text):
        match = _TURN.match(text, at)
        if match is None:
            raise ValueError(f"no turn at {at}")
        found.append((unescape_role(match[1]), unescape(match[2])))
        at = match.end()
    return found


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, part, nth, role, text: the turns, read back from formatted parts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 50):
            found = [read_part(text) for text in batch.column(2).to_pylist()]
            at = pa.array([i for i, some in enumerate(found) for _ in some], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at),
                 pa.array([i for some in found for i in range(len(some))], pa.int64()),
                 pa.array([t[0] for some in found for t in some], pa.string()),
                 pa.array([t[1] for some in found for t in some], pa.string())],
                ["conv_id", "part", "nth", "role", "text"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.select("conv_id", "part", "text").mapInArrow(
        read, f"conv_id {kind}, part long, nth long, role string, text string"
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read
    back from the parts as ``format_chats`` returns them (in order, side by side).

    The loss mask is applied to the formatted text and what lies under it unescaped.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, id_type = None, None
        for batch in pieces(batches, 50):
            id_type, done = batch.schema.field(0).type, []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for conv_id, part, text, loss in zip(*columns):
                if part == 0:
                    if now:
                        done.append(now.row())
                    now = _Digest(conv_id)
                now.add(text, loss)
            yield from _digests(done, id_type)
        if now:
            yield from _digests([now.row()], id_type)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        digest,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


class _Digest:
    """Running counts and digests of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> None:
        for role, body in read_part(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
        for span in loss:
            start = span["start"]
            body = unescape(text[start : start + span["length"]])
            self.loss_chars += len(body)
            self.loss.update(body.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.chars)


def _digests(rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = list(zip(*rows))
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )
