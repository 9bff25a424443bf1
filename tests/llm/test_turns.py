"""Operators on conversations, and fill-in-middle."""

from __future__ import annotations

import hashlib
import heapq
import json
import random
import re
import zlib

import pytest
from cases import no_documents, odd_documents
from pyspark.sql import functions as F

from lineagrid.llm import chat_format, fill_middle, queries, turn_repair

SF = "/root/testdata/sf0.01"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- repair ---------------------------------------------------------------------


def plain_repair(rows: list[tuple[str, str, str]]):
    """(cost, audit, repaired) by trying edits in order of cost and string; rows are
    (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, turns = heapq.heappop(heap)
        initials = "".join(roles)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, list(turns)
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        for new in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", i, initials + new[0], (*turns, (new, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, initials, turns))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    heapq.heappush(
                        heap, (cost + more, audit + "K", i + 1, initials + role[:1], (*turns, (role, text)))
                    )
                for new in ("user", "assistant"):
                    heapq.heappush(
                        heap,
                        (cost + 3 + more, audit + "R", i + 1, initials + new[0], (*turns, (new, text))),
                    )
    raise AssertionError


def faults(rows: list[tuple[str, str]]) -> list[str]:
    found = []
    for i, (role, text) in enumerate(rows):
        said = text.strip("\x20\t\n\x0b\x0c\r")
        found.append(
            "blank" if not said else "duplicate" if (role, text) in rows[:i]
            else "" if said[-1] in ".!?" else "truncated"
        )
    return found


def by_program(rows, every=None):
    repair, nodes = turn_repair.Repair(), []
    for i, (role, text, fault) in enumerate(rows):
        repair.add((role, text), role[:1], fault)
        if every and i % every == 0:
            nodes += repair.decided()
    nodes += repair.finish()
    turns = [
        (n.role or n.row[0], n.row[1] if n.row else "") for n in nodes if n.letter != "D"
    ]
    cost = sum(turn_repair.COSTS[n.letter] for n in nodes) + sum(
        3 for n in nodes if n.row and n.letter != "D" and rows_fault(rows, n) == "truncated"
    )
    return cost, "".join(n.letter for n in nodes), turns


def rows_fault(rows, node):
    return next(f for r, t, f in rows if (r, t) == node.row and f != "duplicate")


@pytest.mark.parametrize("hashed", ["rolling", "colliding"])
def test_cheapest_edits_and_least_audit(hashed, monkeypatch):
    if hashed == "colliding":  # every hash agrees, so only verification tells strings apart
        monkeypatch.setattr(turn_repair, "next_hash", lambda before, letter: 0)
    draw = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "", " "]
    for trial in range(400):
        pairs = [
            (draw.choices(roles, [6, 6, 2, 1, 1, 1])[0], draw.choice(["a.", "b", "c!", "", "\t", f"{i}."]))
            for i in range(draw.randint(0, 6))
        ]
        rows = [(r, t, f) for (r, t), f in zip(pairs, faults(pairs))]
        expected = plain_repair(rows)
        assert by_program(rows) == expected, rows
        assert by_program(rows, every=1) == expected, rows


def test_long_conversations_are_sent_off_as_they_are_decided():
    """Against the same program that keeps everything open, and in bounded space."""
    draw = random.Random(4)
    for weights in ([5, 5, 1], [9, 1, 1], [1, 9, 0], [1, 0, 0]):
        rows = [
            (draw.choices(["user", "assistant", "system"], weights)[0], f"{i}.",
             draw.choices(["", "blank", "truncated"], [8, 1, 1])[0])
            for i in range(3000)
        ]
        whole, parts, n_open = turn_repair.Repair(), turn_repair.Repair(), 0
        sent = []
        for i, (role, text, fault) in enumerate(rows):
            whole.add((role, text), role[:1], fault)
            parts.add((role, text), role[:1], fault)
            if i % 100 == 99:
                sent += parts.decided()
                n_open = max(n_open, 1 + i - sum(n.row is not None for n in sent))
        sent += parts.finish()
        assert [n.letter for n in sent] == [n.letter for n in whole.finish()]
        assert n_open < 50


def plain_audits(rows):
    """The contract, conversation by conversation; rows are (conv_id, turn, role, text)."""
    convs = {}
    for conv_id, turn, role, text in rows:
        kept = convs.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    found = {}
    for conv_id, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        pairs = [(r, t) for _, r, t in kept]
        marks = faults(pairs)
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, repaired = plain_repair([(r, t, f) for (r, t), f in zip(pairs, marks)])
        found[conv_id] = (
            gaps, *(marks.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            sha("\n".join(f"{r}:{t}" for r, t in repaired)),
        )
    return found


TURNS = "conv_id long, turn long, role string, text string, no string, edit string, there string"


def odd_turns(spark):
    more = ("x", "y", "z")
    rows = [
        (1, 0, "user", "Hello?", *more), (1, 1, "assistant", "Yes.", *more), (1, 1, "assistant", "Yes.", *more),
        (2, None, None, None, *more), (2, None, "user", "So.", *more), (2, 5, "assistant", None, *more),
        (3, 9, "tool", "x" * 300_000 + ".", *more), (None, 1, "user", "Lost.", *more),
        (None, None, "assistant", "Lost.", *more), (4, 3, "", "", *more), (5, -2, "assistant", "É\n.", *more),
        (5, 4, "system", "No\x1c", *more), (6, 0, "user", "<|im_end|>\n", *more), (6, 0, "user", "a <\\| b", *more),
        (6, 1, "assi\nst\\n<|x", "b", *more), (7, 0, "assistant", "<" * 9 + "|im_start|>", *more),
    ]
    return spark.createDataFrame(rows, TURNS)


def conversations_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def test_audits_of_odd_and_given_conversations(spark, monkeypatch, tmp_path):
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    for name, table in (("odd", odd_turns(spark)), ("given", given), ("none", given.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = queries.op11_turn_repair(spark, f"{tmp_path}/{name}").collect()
        expected = plain_audits(conversations_of(table))
        assert len(got) == len(expected)
        assert {r.conv_id: tuple(r)[1:] for r in got} == expected


def test_dropped_conversations_and_repaired_turns(spark):
    rows = spark.createDataFrame(
        [(1, 0, "assistant", "Hm."), (1, 1, "assistant", "Yes.")], "conv_id long, turn long, role string, text string"
    )
    gone = spark.createDataFrame([(1,), (2,)], "conv_id long")
    edits = turn_repair.repair(rows, also=gone)
    assert [tuple(r) for r in turn_repair.repaired_turns(edits).orderBy("no").collect()] == [
        (1, 0, "user", "Hm."), (1, 1, "assistant", "Yes."),
    ]
    audits = {r.conv_id: tuple(r)[1:] for r in turn_repair.audits(edits).collect()}
    assert audits[2] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert audits[1][5:7] == (3, "RK")


# --- chats ----------------------------------------------------------------------

CHATS = [
    ({"prompt": "P", "completion": "C"}, [("user", "P"), ("assistant", "C")]),
    ({"instruction": "I", "output": "O"}, [("user", "I"), ("assistant", "O")]),
    ({"instruction": "I", "input": "", "output": None}, [("user", "I"), ("assistant", "")]),
    ({"instruction": "I", "input": "J", "output": "O", "system": "S"},
     [("system", "S"), ("user", "I\n\nJ"), ("assistant", "O")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": None, "content": 3}]}, [("user", "a"), ("", "3")]),
    ({"messages": []}, []),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
     [("user", "a\n\nb")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g\ud800"}], "system": "s"},
     [("system", "s"), ("user", "h"), ("assistant", "g�")]),
    ({"role": "user", "text": None}, [("user", "")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
]


def test_layouts_are_told_by_their_fields(spark):
    records = [(i, 0, json.dumps(r)) for i, (r, _) in enumerate(CHATS)]
    records += [(90, 0, None), (91, 0, "{"), (92, 0, "[]"), (93, None, '{"prompt": "only"}'),
                (94, 0, json.dumps({"prompt": "P", "completion": "C", "id": {"a": [1]}}))]
    df = spark.createDataFrame(records, "conv_id long, turn long, record string")
    got = {}
    for r in chat_format.canonical_turns(df, ignored=("id",)).orderBy("conv_id", "item").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text) if r.layout else r.fingerprint)
    for i, (_, turns) in enumerate(CHATS):
        assert got.get(i, []) == turns
    assert got[90] == got[91] == got[92] == [None] and len(got[93][0]) == 16
    assert got[94] == [("user", "P"), ("assistant", "C")]
    chats = chat_format.format_chats(chat_format.canonical_turns(df))
    assert {r.conv_id for r in chats.collect()} == set(range(len(CHATS))) - {5}


def test_paths_do_not_mix_names_and_structure():
    paths = chat_format.field_paths
    assert paths({"a.b": 1}) != paths({"a": {"b": 1}}) and paths({"a[]": 1}) != paths({"a": [1]})
    assert paths({"a": [{"b": 1}, {"c": [[2]]}]}) == {"a[].b", "a[].c[][]"}
    with pytest.raises(ValueError):
        chat_format.registry((chat_format.LAYOUTS[1], chat_format.Layout("x", (), ("completion", "prompt"))))


def test_control_strings_come_back():
    draw = random.Random(6)
    parts = ["<", "\\", "|", "im_end", "im_start", ">", "\n", "a", "<|im_end|>\n", "<|im_start|>"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
        role = "".join(draw.choice(parts) for _ in range(draw.randint(0, 5)))
        assert chat_format.unescape(chat_format.escape(text)) == text
        assert "<|" not in chat_format.escape(text)
        part = chat_format._Part(100)
        part.begin(1)
        part.add(role, text, True)
        part.add(text, role, True)
        _, _, formatted, loss = part.row()
        assert chat_format.read_part(formatted) == [(role, text), (text, role)]
        assert [chat_format.unescape(formatted[s["start"]:][: s["length"]]) for s in loss] == [text, role]


def plain_digests(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        convs.setdefault(conv_id, []).append((turn, role or "", text or ""))
    convs[-1] = [(0, "user", queries.CONTROL), (0.5, "assistant", queries.CONTROL)]
    found = {}
    for conv_id, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        said = "".join(t for _, r, t in kept if r == "assistant")
        found[conv_id] = (
            len(kept), sha("".join(f"{r}\n{t}\n" for _, r, t in kept)), len(said), sha(said),
        )
    return found


def test_digests_of_odd_and_given_conversations(spark, tmp_path):
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    for name, table in (("odd", odd_turns(spark)), ("given", given), ("none", given.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = queries.op13_chat_format(spark, f"{tmp_path}/{name}").collect()
        expected = plain_digests(conversations_of(table))
        assert len(got) == len(expected)
        assert {r.conv_id: tuple(r)[1:5] for r in got} == expected


def test_parts_are_whole_turns_and_read_back(spark):
    rows = odd_turns(spark).withColumn("item", F.lit(0)).drop("no", "edit", "there")
    formatted = chat_format.format_chats(rows, part_chars=40)
    digests = {tuple(r) for r in chat_format.chat_digests(formatted).collect()}
    assert digests == {tuple(r) for r in chat_format.chat_digests(chat_format.format_chats(rows)).collect()}
    parts = formatted.collect()
    assert len(parts) > len({r.conv_id for r in parts})
    assert all(r.text.endswith("<|im_end|>\n") for r in parts)
    got = chat_format.read_chats(formatted).orderBy("conv_id", "part", "nth").collect()
    expected = rows.orderBy("conv_id", "turn", "role", "text").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [
        (r.conv_id, r.role or "", r.text or "") for r in expected
    ]


# --- fill in the middle ---------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    a, b, c = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    form, out = ("spm", f"<S>{c}<P>{a}<M>{b}") if h4 % 100 < 80 else ("psm", f"<P>{a}<S>{c}<M>{b}")
    return len(units), form, len(a), len(b), out


def test_skip_list_finds_every_rank():
    draw = random.Random(8)
    for n in (0, 1, 2, 15, 16, 17, 31, 256, 257, 4100):
        widths = [draw.randint(1, 9) for _ in range(n)]
        for fan_out in (2, 3, 16):
            nodes = fill_middle.SkipList(widths, fan_out)
            total = 0
            for rank in range(n + 1):
                assert nodes.offset(rank) == total
                total += widths[rank] if rank < n else 0
            with pytest.raises(IndexError):
                nodes.offset(n + 1)


def test_units_are_those_of_the_pattern():
    draw = random.Random(9)
    for _ in range(3000):
        text = "".join(draw.choice("ab \t\n\x0b\x1c é🙂\x85") for _ in range(draw.randint(0, 30)))
        assert fill_middle.unit_widths(text).tolist() == [len(u) for u in UNIT.findall(text)]


def test_outputs_and_restored_texts(spark):
    marked = [("a <S> b " * 5), "<P", "<P>", "<<P", "x <M", "S>", "<", ">", "<S", "<M>"]
    odd = odd_documents(spark).select("doc_id", "text", F.lit("x").alias("form"), F.lit("y").alias("n"))
    more = spark.createDataFrame(
        [(100 + i, f"{m}{draw}{m}"[:400], "x", "y") for i, m in enumerate(marked)
         for draw in ("", " a b c ", "é 🙂 < S> P>")] + [(None, "a b c d e f", "x", "y")]
        + [(1000 + i, " ".join("ab<>PSM🙂"[: 1 + (i * k) % 9] for k in range(i % 7)), "x", "y") for i in range(400)],
        "doc_id long, text string, form string, n string",
    )
    docs = odd.unionByName(more)
    got = fill_middle.restore(fill_middle.transform(docs)).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    expected = sorted(((i, *plain_middle(i, t), t or "") for i, t in texts), key=repr)
    found = [
        (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.text, r.restored) for r in got
    ]
    assert sorted(found, key=repr) == expected
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(no_documents(spark)).count() == 0


def test_query_over_the_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op12_fill_middle(spark, SF).collect():
        *head, out = plain_middle(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == tuple(head)
        assert (r.output_sha256, r.restored_sha256) == (sha(out), sha(docs[r.doc_id] or ""))
