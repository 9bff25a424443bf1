"""Word lists and token classes shared by the structural jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineagrid.functions.text import FREE_LITERAL, LITERAL, MARKED

# Words of the query language that are never a column or alias.
RESERVED = """
ALL AND ANY AS ASC BETWEEN BOTH BY CASE CONNECT CONNECT_BY_ROOT CROSS CUBE CURRENT
CURRENT_DATE CURRENT_TIMESTAMP CURRENT_USER DENSE_RANK DESC DISTINCT ELSE END
ESCAPE EXCEPT EXISTS FALSE FETCH FOLLOWING FOR FROM FULL GROUP GROUPING HAVING
IGNORE ILIKE IN INNER INTERSECT IS JOIN KEEP LEADING LEFT LIKE LIMIT
LOCALTIMESTAMP MINUS NATURAL NOCYCLE NOT NULL NULLS OFFSET ON OR ORDER OUTER
OVER PARTITION PRECEDING PRIOR QUALIFY RANGE RESPECT RIGHT RLIKE ROLLUP ROWS
SELECT SETS SIBLINGS SIMILAR SOME START SYMMETRIC SYSDATE SYSTIMESTAMP THEN
TRAILING TRUE UNBOUNDED UNION UNIQUE USING WHEN WHERE WINDOW WITH WITHIN
""".split()
# Words that stand for a value, so that a name after one is an alias.
VALUE_WORDS = """
CURRENT_DATE CURRENT_TIMESTAMP CURRENT_USER FALSE LOCALTIMESTAMP NULL SYSDATE SYSTIMESTAMP TRUE
""".split()
# Fixed values: (word before, word) of phrases in which the word is no column.
PHRASES = """
NULLS FIRST, NULLS LAST, DENSE_RANK FIRST, DENSE_RANK LAST, CURRENT ROW, WITH TIME, WITH LOCAL,
LOCAL TIME, TIME ZONE, ON CONVERSION, ON OVERFLOW, ON EMPTY, ON ERROR, IS NAN, IS INFINITE, IS EMPTY,
IS JSON, NOT NAN, NOT INFINITE, NOT EMPTY, NOT JSON, FOLLOWING EXCLUDE, PRECEDING EXCLUDE,
ASC GROUPS, DESC GROUPS
""".replace("\n", " ").split(",")
# Words between two operands in the brackets of a function.
BETWEEN_OPERANDS = ["VALUE", "PASSING", "PLACING"]
# Functions whose brackets open with a name that is no column.
NAMING_CALLS = ["XMLELEMENT", "XMLPI"]
# Functions whose brackets may open with a word before the operand, and these words.
CONTENT_CALLS, CONTENT_WORDS = ["XMLSERIALIZE", "XMLPARSE"], ["CONTENT", "DOCUMENT"]
# Functions whose first argument may be a unit of time, and these units.
UNIT_CALLS = ["DATEADD", "DATEDIFF", "DATEPART", "DATENAME", "TIMESTAMPADD", "TIMESTAMPDIFF"]
UNITS = """
YEAR QUARTER MONTH WEEK DAY HOUR MINUTE SECOND MILLISECOND MICROSECOND
""".split()
# Time zones of the database, named like columns.
ZONES = ["DBTIMEZONE", "SESSIONTIMEZONE"]
# Words that turn the source before them, and what may follow such a word.
PIVOTS, AFTER_PIVOT = ["PIVOT", "UNPIVOT"], ["(", "XML", "INCLUDE", "EXCLUDE"]
SET_WORDS = ["UNION", "INTERSECT", "EXCEPT", "MINUS"]
JOIN_WORDS = ["LEFT", "RIGHT", "FULL", "INNER", "CROSS", "NATURAL"]

# Clauses whose columns are reported, in report order.
CLAUSES = [
    "PROJECTION", "WHERE", "HAVING", "JOIN_ON", "GROUP_BY", "ORDER_BY", "WINDOW", "QUALIFY",
]

_PART = rf"(?:\"[^\"]*\"|(?:[\p{{L}}_]|{MARKED})(?:[\p{{L}}\p{{N}}_$@#]++|{MARKED})*+)"
TOKEN = "|".join(
    [
        FREE_LITERAL,
        rf"'(?:[^'\ue000]++|{MARKED}|'')*+'",
        r"/\*(?s:.*?)\*/",
        r"--[^\n]*",
        r"\(\s*\+\s*\)",
        rf"{_PART}(?:\s*\.\s*{_PART})*+(?:\s*\.\s*\*)?",
        r"[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?",
        r":[A-Za-z_0-9]+",
        r"#[\p{L}\p{N}_]+#",
        r"<>|<=|>=|!=|\^=|\|\||=>",
        r"\S",
    ]
)


def without_partition_clause(sql: Column) -> Column:
    """``t PARTITION (p) a`` names the same table as ``t a``."""
    return F.regexp_replace(
        sql, F.lit(rf"({LITERAL})|(?i:\bPARTITION\s*\((?!\s*ORDER\b)[^()]*\))"), F.lit("$1")
    )


def token_array(marked_sql: Column) -> Column:
    """The tokens of a text without its remarks; a dotted name is one token."""
    found = F.regexp_extract_all(marked_sql, F.lit(f"(?:{TOKEN})"), F.lit(0))
    kept = F.filter(found, lambda t: ~(t.startswith("/*") | t.startswith("--")))
    return F.when(marked_sql.rlike(r"/\*|--"), kept).otherwise(found)


def is_name(word: Column) -> Column:
    """An identifier or dotted name that is not a reserved word."""
    return F.coalesce(
        word.rlike("^[\\p{L}_\"\ue000]") & ~word.rlike("^[nN]?[qQ]'") & ~F.upper(word).isin(RESERVED),
        F.lit(False),
    )


def is_literal(word: Column) -> Column:
    return F.coalesce(word.rlike("^(?:[nN]?[qQ]?'|[0-9])"), F.lit(False))


def in_phrase(before: Column, word: Column) -> Column:
    """Whether a word and the one before it (both upper case) are a fixed phrase."""
    phrases = [p.strip() for p in PHRASES]
    return F.coalesce(F.concat(before, F.lit(" "), word).isin(phrases), F.lit(False))


def ends_operand(word: Column) -> Column:
    """A token after which another bare name can only be an alias."""
    return F.coalesce(
        is_name(word) | is_literal(word) | word.isin(")", "(+)")
        | F.upper(word).isin("END", *VALUE_WORDS)
        | word.startswith(":"),
        F.lit(False),
    )


def name_parts(token: Column) -> Column:
    """Parts of a dotted token without quotes and blanks."""
    found = F.regexp_extract_all(token, F.lit(rf"{_PART}|\*"), F.lit(0))
    return F.transform(found, lambda p: F.regexp_replace(p, F.lit('^"|"$'), F.lit("")))
