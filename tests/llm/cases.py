"""Documents with everything that may go wrong, and small brute-force helpers."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: the columns of documents, and some whose names operators use inside
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, "
    "size string, kept string, name string, taken string, class_id string, words string"
)

PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()


def prose(seed: int, n: int = 60) -> str:
    return " ".join(f"{PROSE[(seed * 7 + i * i) % 14]}{(seed * 31 + i) % 97}" for i in range(n))


def document(doc_id, text, source="a"):
    n = None if text is None else len(text)
    return (doc_id, text, "en", source, n, "x", "x", "x", "x", "x", "x", "x")


def odd_documents(spark):
    """Nulls, empty and blank texts, exact and near copies, ties, a long text, a
    repeated row, and extra columns."""
    base = prose(1, 120)
    rows = [
        document(1, None), document(2, ""), document(3, " \n\t "), document(4, "One word"),
        document(5, base), document(6, base.replace(" ", "\n", 3)), document(7, base + " extra"),
        document(8, base.upper()), document(9, prose(2), None), document(10, prose(2), "b"),
        document(11, "x" * 200_000, "b"), document(12, " ".join(prose(k) for k in range(3, 90)), "c"),
        document(13, prose(5), None), document(13, prose(5), None), document(14, "né 中 \x1c \u00a0 ß"),
        document(15, "a b c d e f g h i\na b c d e f g h i\n\na b c d e f g h i", "é"),
        document(16, prose(6) + "\n" + prose(7), "b"), document(17, "intro\n" + prose(7), "b"),
        document(18, "This token = \"0123456789abcdef0123\" and Mrs Anna Meier, a@b.example.com", "b"),
        document(19, "You are an idiot and trash", "b"), document(20, "# " * 40, "b"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, width: int) -> set:
    found = words(lowered(text))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def components(sets: dict, percent: int) -> dict:
    """Smallest key reachable by links, by comparing all pairs."""
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: find(key) for key in keys}
