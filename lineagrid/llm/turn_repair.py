"""Repair of conversations by the cheapest edits, with an audit of what was edited.

The rows of a conversation are kept (0), given another role (3) or deleted (4), and
turns are inserted (3), until the initials of the roles read ``(s?(ua)+)?``. Four
states say how far such a reading has come; the dynamic program holds the best
edits for each. Of equally cheap edits the least string of initials counts.

Edits are nodes that point at the edit before them, so all candidates share their
beginnings. A node knows its ancestors 1, 2, 4, ... steps back and a rolling hash of its
string. Two strings are compared by searching their longest common prefix through
those ancestors; an agreement of hashes is verified along the nodes.

Rows are streamed. A state that can no longer win is given up; what all remaining states
have in common is decided and leaves at once, so of a very long conversation a task
holds what is still open and 16 bytes for each different row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import pieces

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: rows between two attempts to send off what is decided
OPEN_ROWS = 256
_BLANKS = "\x20\t\n\x0b\x0c\r"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: state after keeping a row with this initial
KEPT = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: state after a turn with the role that is due, and that role
DUE = {
    NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"),
    ASSISTANT: (USER, "user"),
}
COMPLETE = (NOTHING, ASSISTANT)


class Node:
    """The last edit of a string of edits."""

    __slots__ = ("parent", "letter", "depth", "hash", "up", "row", "role")

    def __init__(self, parent: Node | None, letter: str, row=None, role=None):
        self.parent, self.letter, self.row, self.role = parent, letter, row, role
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth, self.hash = parent.depth + 1, next_hash(parent.hash, letter)
        up, k = [parent], 0
        while len(up[k].up) > k:
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)


def next_hash(before: int, letter: str) -> int:
    return (before * 1_000_003 + ord(letter)) % 2_305_843_009_213_693_951


def ancestor(node: Node, depth: int) -> Node:
    left = node.depth - depth
    while left:
        k = left.bit_length() - 1
        node = node.up[k]
        left = node.depth - depth
    return node


def common(a: Node, b: Node) -> Node:
    """The last node that two strings share."""
    depth = min(a.depth, b.depth)
    a, b = ancestor(a, depth), ancestor(b, depth)
    if a is b:
        return a
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and k < len(b.up) and a.up[k] is not b.up[k]:
            a, b = a.up[k], b.up[k]
    return a.parent


class Order:
    """Comparison of strings of edits. Pairs of nodes once verified to be equal strings
    are remembered."""

    def __init__(self):
        self.equal: set[tuple[Node, Node]] = set()

    def forget(self) -> None:
        self.equal.clear()

    def _difference(self, a: Node, b: Node) -> tuple[Node, Node] | None:
        """The first nodes in which two equally long strings differ, looked for along the
        nodes up to a place known to be equal."""
        found, p, q = None, a, b
        while p is not q and (p, q) not in self.equal:
            if p.letter != q.letter:
                found = p, q
            p, q = p.parent, q.parent
        if found is None and a is not b:
            self.equal.add((a, b))
        return found

    def less(self, a: Node, b: Node) -> bool:
        depth = min(a.depth, b.depth)
        x, y = ancestor(a, depth), ancestor(b, depth)
        if x.hash == y.hash:
            differs = self._difference(x, y)
            if differs is None:
                return a.depth < b.depth
        else:
            for k in reversed(range(len(x.up))):
                if k < len(x.up) and k < len(y.up) and x.up[k].hash != y.up[k].hash:
                    x, y = x.up[k], y.up[k]
            differs = self._difference(x.parent, y.parent) or (x, y)
        return differs[0].letter < differs[1].letter


class Repair:
    """The dynamic program over the rows of one conversation."""

    def __init__(self):
        self.order = Order()
        self.root = Node(None, "")
        self.best: dict[int, tuple[int, Node]] = {NOTHING: (0, self.root)}
        self._insert()

    def _offer(self, best: dict, state: int, cost: int, node: Node) -> bool:
        old = best.get(state)
        if old is None or cost < old[0] or (cost == old[0] and self.order.less(node, old[1])):
            best[state] = cost, node
            return True
        return False

    def _insert(self) -> None:
        """Turns may be inserted between any two rows. Two in a row come back to
        the state they started from, so a state is improved at most once by each other."""
        changed = list(self.best)
        while changed:
            state = min(changed, key=lambda s: self.best[s][0])
            changed.remove(state)
            cost, node = self.best[state]
            to, role = DUE[state]
            cost += COSTS[INSERT]
            old = self.best.get(to)
            if old is None or cost <= old[0]:
                if self._offer(self.best, to, cost, Node(node, INSERT, None, role)):
                    changed.append(to)

    def add(self, row, initial: str, fault: str) -> None:
        """The next row. ``fault``: blank, duplicate, truncated or empty."""
        best: dict[int, tuple[int, Node]] = {}
        may_stay = fault not in ("blank", "duplicate")
        more = TRUNCATED_COST if fault == "truncated" else 0
        for state, (cost, node) in self.best.items():
            moves = [(state, cost + COSTS[DELETE], DELETE, None)]
            if may_stay:
                kept = KEPT.get((state, initial))
                if kept is not None:
                    moves.append((kept, cost + COSTS[KEEP] + more, KEEP, None))
                to, role = DUE[state]
                moves.append((to, cost + COSTS[REROLE] + more, REROLE, role))
            for to, cost_to, letter, role in moves:
                old = best.get(to)
                if old is None or cost_to <= old[0]:
                    self._offer(best, to, cost_to, Node(node, letter, row, role))
        self.best = best
        self._insert()
        # what these states may still become, a complete reading becomes more cheaply: where
        # they go on with a system turn, it deletes that row
        done = best[ASSISTANT][0] if ASSISTANT in best else None
        if done is not None:
            if NOTHING in best and best[NOTHING][0] > done + COSTS[DELETE]:
                del best[NOTHING]
            if SYSTEM in best and best[SYSTEM][0] > done:
                del best[SYSTEM]

    def decided(self) -> list[Node]:
        """Edits that all states have in common, each returned once, in order."""
        nodes = [node for _, node in self.best.values()]
        shared = nodes[0]
        for node in nodes[1:]:
            shared = common(shared, node)
        return self._leave(shared)

    def finish(self) -> list[Node]:
        """The rest of the best edits."""
        ends = [self.best[s] for s in COMPLETE if s in self.best]
        cost, node = ends[0]
        for other_cost, other in ends[1:]:
            if other_cost < cost or (other_cost == cost and self.order.less(other, node)):
                cost, node = other_cost, other
        return self._leave(node)

    def _leave(self, last: Node) -> list[Node]:
        path = []
        node = last
        while node is not self.root:
            path.append(node)
            node = node.parent
        if path:  # nothing looks behind this node again
            self.order.forget()
            self.root = last
            last.parent, last.up = None, ()
        path.reverse()
        return path


def fault_of(role: str, text: str, seen: set[bytes]) -> str:
    """The first fault of a row; ``seen`` holds digests of the rows before."""
    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
    again = key in seen
    seen.add(key)
    said = text.rstrip(_BLANKS)
    if not said:
        return "blank"
    if again:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


def repair(rows: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """conv_id, no, edit, turn, old_role, fault, role, text: one row per edit.

    ``rows`` is (conv_id, turn, role, text); other columns do not matter. Rows go by
    turn (nulls first), then role and text for ties, so repeated rows are neighbours. A
    null role or text is one blank. ``turn``, ``old_role`` and ``fault`` are those of the row edited
    (null for an insert), ``role`` and ``text`` what stands there afterwards (null for a
    delete). Conversations of ``also`` (conv_id) without rows give one row without an edit.
    The edits of a conversation lie side by side in one partition, in order.
    """
    blank = F.lit(" ")
    cols = [
        rows["conv_id"].alias("conv_id"), rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"], blank).alias("role"), F.coalesce(rows["text"], blank).alias("text"),
        F.lit(True).alias("there"),
    ]
    found = rows.select(*cols)
    if also is not None:
        none = F.lit(None)
        found = found.unionByName(
            also.select(
                "conv_id", none.cast("long").alias("turn"), none.cast("string").alias("role"),
                none.cast("string").alias("text"), F.lit(False).alias("there"),
            )
        )
    found = found.repartition("conv_id").sortWithinPartitions(
        "conv_id", "there", "turn", "role", "text"
    )

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in pieces(batches):
            id_type, done = batch.schema.field(0).type, []
            for conv_id, turn, role, text, there in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done += now.end()
                    now = _Conversation(conv_id)
                if there:
                    done += now.add(turn, role, text)
            yield from _edits(done, id_type)
        if now is not None:
            yield from _edits(now.end(), id_type)

    kind = found.schema["conv_id"].dataType.simpleString()
    return found.mapInArrow(
        edit,
        f"conv_id {kind}, no long, edit string, turn long, old_role string, fault string, "
        "role string, text string",
    )


class _Conversation:
    """The rows of one conversation as they come, the edits as they are decided."""

    def __init__(self, conv_id):
        self.conv_id, self.no, self.rows = conv_id, 0, 0
        self.repair, self.seen = Repair(), set()

    def add(self, turn, role: str, text: str) -> list[tuple]:
        fault = fault_of(role, text, self.seen)
        self.repair.add((turn, role, text, fault), role[:1], fault)
        self.rows += 1
        return self._rows(self.repair.decided()) if self.rows % OPEN_ROWS == 0 else []

    def end(self) -> list[tuple]:
        if not self.rows:
            return [(self.conv_id, None, None, None, None, None, None, None)]
        return self._rows(self.repair.finish())

    def _rows(self, nodes: list[Node]) -> list[tuple]:
        found = []
        for node in nodes:
            turn, old, text, fault = node.row or (None, None, "", None)
            node.row = None
            stays = node.letter != DELETE
            found.append((
                self.conv_id, self.no, node.letter, turn, old, fault,
                (node.role or old) if stays else None, text if stays else None,
            ))
            self.no += 1
        return found


def _edits(rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
            ["conv_id", "no", "edit", "turn", "old_role", "fault", "role", "text"],
        )


def repaired_turns(edits: DataFrame) -> DataFrame:
    """conv_id, no, role, text of the repaired conversations."""
    return edits.filter(F.col("edit") != DELETE).select("conv_id", "no", "role", "text")


def audits(edits: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256, from the edits as ``repair`` returns them (in order, side by side).

    ``gaps`` are numbers missing between the least and the greatest turn, ``illegal``
    neighbours before the repair whose initials are not su, ua or au. The digest is of the
    repaired ``role:text``, put together by line feeds.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in pieces(batches):
            id_type, done = batch.schema.field(0).type, []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not row[1]:  # the first edit of a conversation, or none at all
                    if now is not None:
                        done.append(now.row())
                    now = _Audit(row[0])
                now.add(*row[2:])
            yield from _audits(done, id_type)
        if now is not None:
            yield from _audits([now.row()], id_type)

    kind = edits.schema["conv_id"].dataType.simpleString()
    return edits.mapInArrow(
        fold,
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, repaired_sha256 string",
    )


class _Audit:
    """Running figures of one conversation."""

    def __init__(self, conv_id):
        self.conv_id, self.first, self.last, self.turns = conv_id, None, None, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.before, self.illegal, self.cost, self.letters = None, 0, 0, []
        self.digest, self.lines = hashlib.sha256(), 0

    def add(self, edit, turn, old_role, fault, role, text) -> None:
        if edit is None:
            return
        self.letters.append(edit)
        self.cost += COSTS[edit]
        if edit != INSERT:
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
            if fault:
                self.faults[fault] += 1
            if fault == "truncated" and edit != DELETE:
                self.cost += TRUNCATED_COST
            initial = old_role[:1]
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
        if edit != DELETE:
            self.digest.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost,
                "".join(self.letters), self.digest.hexdigest())


def _audits(rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)],
            ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
             "repaired_sha256"],
        )


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: rows with planted faults, by CRC-32 of
    ``conv_id:turn`` modulo 20: 0 drops the row (``there`` is false), 1 empties
    its text, 2 takes out its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's. Nulls
    are one blank, in the key too; a null id or turn itself stays null."""
    blank = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    )
    kind, text = F.crc32(key) % 20, F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        (kind != 0).alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy"),
    )
    return rows.drop("copy")
