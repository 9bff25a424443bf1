"""Cleaning and scanning of statement texts, as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineagrid.functions.names import last_two_parts, strip


# Words that end an inline comment.
COMMENT_END_WORDS = [
    "SELECT", "FROM", "WHERE", "AND", "OR", "JOIN", "LEFT", "RIGHT", "FULL",
    "INNER", "OUTER", "CROSS", "GROUP", "HAVING", "ORDER", "UNION",
    "INTERSECT", "EXCEPT", "QUALIFY", "WINDOW",
]
# The mask that stands for the i-th #name# placeholder.
MASK_PREFIX, MASK_SUFFIX = "__SQLGLOT_PH_", "__"
PLACEHOLDER = "#[^#]+#"

# quoted text, also in the form q'[...]' that needs no doubled quotes inside
_FREE_QUOTE = "|".join(
    rf"{a}(?s:.*?){b}'" for a, b in [(r"\[", r"\]"), (r"\{", r"\}"), (r"\(", r"\)"), ("<", ">"), ("!", "!"), ("~", "~")]
)
FREE_LITERAL = rf"(?<![\w$#\"])[nN]?[qQ]'(?:{_FREE_QUOTE})"
LITERAL = rf"(?:{FREE_LITERAL}|'[^']*+(?:''[^']*+)*+')"

# blanks of spreadsheets and word processors, which the query language takes as blanks
WIDE_BLANK = r"[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def _sub(text: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def clean_statement(text: Column) -> Column:
    """Undo spreadsheet line ends, squeeze blanks, keep line breaks."""
    # a plain search spares most texts the patterns
    found = reduce(or_, [text.contains(part) for part in ("000", "\r", "\t", "  ")])
    plain = _sub(_sub(text, "(?i)_x000D_", "\n"), "\r\n?", "\n")
    return strip(F.when(found, _sub(plain, "[\t ]{2,}|\t", " ")).otherwise(text))


def plain_blanks(text: Column) -> Column:
    """Wide blanks outside quotes as plain ones."""
    kept = rf"({LITERAL}|\"[^\"]*\")|{WIDE_BLANK}"
    # a blank after a quoted part changes no token
    return F.when(text.rlike(WIDE_BLANK), _sub(text, kept, "$1 ")).otherwise(text)


def inline_comments_to_block(text: Column) -> Column:
    """``-- remark`` becomes ``/*remark*/``; quoted text is left alone. The
    remark ends before a line end, comma, bracket, semicolon or clause word."""
    words = "|".join(COMMENT_END_WORDS)
    pattern = (
        rf"({LITERAL}|\"[^\"]*\")"
        rf"|--[^\S\n\r]*([^\n\r]*?)[^\S\n\r]*(?=[\n\r,);]|(?i:\b(?:{words})\b)|\z)"
    )
    marked = _sub(text, pattern, "$1\ue010$2\ue011")
    marked = _sub(marked, "(['\"])\ue010\ue011", "$1")
    opened = F.replace(marked, F.lit("\ue010"), F.lit("/*"))
    return F.replace(opened, F.lit("\ue011"), F.lit("*/"))


def placeholders(text: Column) -> Column:
    """All ``#name#`` placeholders in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(0))


def _weave(text: Column, filler) -> Column:
    """Put ``filler(i)`` where the i-th placeholder of the text stood."""
    pieces = F.split(text, PLACEHOLDER, -1)
    joined = F.transform(
        pieces,
        lambda piece, i: F.concat(F.when(i > 0, filler(i - 1)).otherwise(F.lit("")), piece),
    )
    return F.when(text.contains("#"), F.array_join(joined, "")).otherwise(text)


def _mask(i: Column) -> Column:
    return F.concat(F.lit(MASK_PREFIX), i.cast("string"), F.lit(MASK_SUFFIX))


def mask_placeholders(text: Column) -> Column:
    return _weave(text, _mask)


def placeholder_map(text: Column) -> Column:
    found = placeholders(text)
    return F.map_from_arrays(F.transform(found, lambda _, i: _mask(i)), found)


def restore_placeholders(text: Column, mapping: Column) -> Column:
    return F.aggregate(
        F.map_entries(mapping), text, lambda acc, e: F.replace(acc, e["key"], e["value"])
    )


# Placeholders inside the token table keep their number and their own text
# together, so two mentions stay different names and print as written.
MARKED = "\ue000[0-9]+\ue001[^\ue002]*\ue002"


def mark_placeholders(text: Column) -> Column:
    found = placeholders(text)
    return _weave(
        text,
        lambda i: F.concat(
            F.lit("\ue000"), i.cast("string"), F.lit("\ue001"),
            F.replace(F.get(found, i), F.lit("#"), F.lit("")), F.lit("\ue002"),
        ),
    )


def unmark_placeholders(text: Column) -> Column:
    return F.when(
        text.contains("\ue000"),
        _sub(text, "\ue000[0-9]+\ue001([^\ue002]*)\ue002", "#$1#"),
    ).otherwise(text)


# Rewrites of dynamic SQL, in the order in which they apply.
_QUOTES = "'{1,3}"
_NAME = "[A-Za-z_][A-Za-z0-9_]*"
DYNAMIC_REWRITES = [
    (rf"{_QUOTES}\s*\|\|\s*({_NAME})\s*\|\|\s*{_QUOTES}", "#$1#"),
    (rf"\|\|\s*({_NAME})\s*\|\|", "#$1#"),
    (rf"{_QUOTES}\s*\|\|\s*'([^']*)'\s*\|\|\s*{_QUOTES}", "'$1'"),
    (r"'\s*\|\|\s*'", ""),
    (r"(?is),\s*SELECT\s+.*?\bWHERE\s+1\s*=\s*1'\s*;", ""),
    (r"(?i),\s*SELECT\s+", ", "),
    (rf"(#{_NAME}#)'(\s*,)", "$1$2"),
    (rf"(?i)(#{_NAME}#)'(\s+FROM\b)", "$1$2"),
    (r"(?i)(?<=[\s)])'(?=(?:WHEN|FROM|WHERE|ORDER\s+BY|GROUP\s+BY|AND|OR|CASE|ELSE|END)\b)", ""),
    (r"(?i)PARTITION\s*\(\s*P\s*#[^#]+#\s*\)", ""),
    (r"(?i)PARTITION\s*\([^)]*\)", ""),
    (r"''", "'"),
]


def normalize_dynamic_sql(text: Column) -> Column:
    for pattern, replacement in DYNAMIC_REWRITES:
        text = _sub(text, pattern, replacement)
    quotes = F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))
    text = F.when(quotes % 2 == 1, _sub(text, r"'\s*$", "")).otherwise(text)
    return _sub(text, r"'\s*;\s*$", ";")


def frame(text: Column) -> Column:
    """The text with quoted parts and remarks set aside."""
    return _sub(text, rf"{LITERAL}|\"[^\"]*\"|(?s:/\*.*?\*/)|--[^\n]*", "x")


def foreign_mark(text: Column) -> Column:
    """An error where a text itself holds one of the marks used in here, or NULL."""
    return F.when(text.rlike("[\ue000-\ue002\ue010\ue011]"), F.lit("private-use mark in the text"))


_END = r"(?:\)|[\s;]*\z)"
_NEXT_CLAUSE = rf"(?:(?:WHERE|GROUP|ORDER|HAVING|UNION|INTERSECT|EXCEPT|MINUS)\b|{_END})"


def frame_error(frame_text: Column) -> Column:
    """Why a frame cannot be that of a single query, or NULL."""
    opened = F.length(F.replace(frame_text, F.lit(")"), F.lit("")))
    closed = F.length(F.replace(frame_text, F.lit("("), F.lit("")))
    return (
        F.when(~frame_text.rlike(r"(?i)^[\s(x]*(?:SELECT|WITH)\b"), F.lit("not a query"))
        .when(frame_text.rlike("['\"]"), F.lit("unbalanced quotes"))
        .when(opened != closed, F.lit("unbalanced brackets"))
        .when(frame_text.rlike(r"(?i),\s*SELECT\b"), F.lit("SELECT after a comma"))
        .when(~frame_text.rlike(r"(?i)\bSELECT\b"), F.lit("no SELECT"))
        .when(frame_text.rlike(rf"(?i)\bSELECT\s*(?:FROM\b|WHERE\b|{_END})"), F.lit("nothing selected"))
        .when(frame_text.rlike(rf"(?i)\b(?:FROM|JOIN)\s*(?:,|ON\b|{_NEXT_CLAUSE})"), F.lit("no source"))
        .when(frame_text.rlike(rf"(?i)\b(?:WHERE|HAVING|AND|OR)\s*{_NEXT_CLAUSE}"), F.lit("no condition"))
        .when(frame_text.rlike(rf"(?i),\s*(?:FROM\b|{_NEXT_CLAUSE})"), F.lit("dangling comma"))
    )


# The text scans for table mentions and their aliases.
TABLE_REF = r"(?iU)\b(?:FROM|JOIN)\s+([\w.\[\]\"]+)"
ALIASED_TABLE_REF = TABLE_REF + r"\s+(?:AS\s+)?(\w+)"


def text_alias_pairs(text: Column) -> Column:
    """Array of (alias, schema, table) found by scanning the plain text once."""
    found = F.regexp_extract_all(text, F.lit(ALIASED_TABLE_REF), F.lit(0))
    words = F.transform(found, lambda pair: F.split(pair, r"(?U)\s+"))
    return F.transform(words, lambda w: F.struct(
        F.lower(F.element_at(w, -1)).alias("alias"), *last_two_parts(F.element_at(w, 2)),
    ))


def last_by_alias(pairs: Column) -> Column:
    """Of pairs with one alias, the last in the text; by alias. Sorted by alias and place,
    a pair is the last of its alias if the next one has another."""
    placed = F.array_sort(F.transform(
        pairs, lambda p, i: F.struct(p["alias"].alias("alias"), i.alias("nth"), p.alias("pair"))
    ))

    def lasts(rows: Column) -> Column:
        last = F.filter(rows, lambda r, i: ~F.coalesce(
            F.get(rows, i + 1)["alias"] == r["alias"], F.lit(False)
        ))
        return F.transform(last, lambda r: r["pair"])

    # a variable of its own, so that the text is scanned once and not for every pair
    return F.element_at(F.transform(F.array(placed), lasts), 1)


def text_table_refs(text: Column) -> Column:
    """Array of distinct (schema, table) in order of first mention."""
    refs = F.regexp_extract_all(text, F.lit(TABLE_REF), F.lit(1))
    refs = F.filter(refs, lambda ref: F.lower(ref) != "select")
    return F.array_distinct(F.transform(refs, lambda ref: F.struct(*last_two_parts(ref))))


NOT_PREFIX = (
    r"(?is)^NOT ((?:[\p{L}_#\"][\p{L}\p{N}_$@#.\"]*)(?:\([^()]*\))?) "
    r"(LIKE|ILIKE|RLIKE|SIMILAR TO|IN|BETWEEN)\b(?!.*\bOR\b)(.*)$"
)


def readable_not(predicate: Column) -> Column:
    """``NOT x LIKE y`` reads ``x NOT LIKE y``; the same for IN and BETWEEN."""
    return _sub(predicate, NOT_PREFIX, "$1 NOT $2$3")
