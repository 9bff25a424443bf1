"""Dotted names: parts, table references, database links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Characters that count as white space at the ends of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def bare_identifier(part: Column) -> Column:
    """A name without its square brackets or double quotes."""
    part = F.regexp_replace(strip(part), F.lit(r"(?s)^\[(.*)\]$"), F.lit("$1"))
    return F.regexp_replace(part, F.lit('(?s)^"(.*)"$'), F.lit("$1"))


def last_two_parts(ref: Column) -> list[Column]:
    """(schema_name, table_name) of a dotted reference."""
    parts = F.filter(F.split(ref, r"\."), lambda p: p != "")
    return [
        F.when(F.size(parts) >= 2, bare_identifier(F.try_element_at(parts, F.lit(-2))))
        .otherwise(F.lit("")).alias("schema_name"),
        F.coalesce(bare_identifier(F.try_element_at(parts, F.lit(-1))), F.lit("")).alias("table_name"),
    ]


def table_only(name: Column) -> Column:
    """What follows the last dot."""
    name = strip(F.coalesce(name, F.lit("")))
    return strip(F.element_at(F.split(name, r"\."), -1))


def split_dblink(name: Column) -> tuple[Column, Column]:
    """(table, '@link') at the first '@'; an empty link is no link."""
    name = strip(F.coalesce(name, F.lit("")))
    at = F.instr(name, "@")
    link = strip(name.substr(at + 1, F.length(name)))
    table = F.when(at > 0, strip(name.substr(F.lit(1), at - 1))).otherwise(name)
    dblink = F.when((at > 0) & (link != ""), F.concat(F.lit("@"), link)).otherwise(F.lit(""))
    return table, dblink


def qualified(schema: Column, name: Column) -> Column:
    return F.concat_ws(".", F.when(schema != "", schema), F.when(name != "", name))
