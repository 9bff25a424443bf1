"""Fill-in-middle: a text is cut at two places and its parts are put in another order.

The units of a text (a word with the white space before it; white space at the
end) are the bottom lane of an indexable skip list. Every node carries two
widths, how many units and how many code points it spans; the lanes above are
express lanes whose nodes add up those of ``FAN_OUT`` nodes below. A cut is given
as a rank in units: descending by the accumulated widths finds its place in code
points without looking at the units before it one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import pieces, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
FAN_OUT = 16
_BLANKS = np.array([0x20, *range(0x09, 0x0E)], np.uint32)


def unit_widths(text: str) -> np.ndarray:
    """Code points of each unit, in order."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64)
    blank = np.isin(points, _BLANKS)
    last = np.append(blank[1:], True) & ~blank  # last character of a word
    ends = np.flatnonzero(last) + 1
    if blank[-1]:
        ends = np.append(ends, len(points))
    return np.diff(ends, prepend=0)


class SkipList:
    """Nodes with a width in units and a width in code points, in lanes."""

    def __init__(self, widths: np.ndarray, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        self.length = len(widths)
        units, points = np.ones(len(widths), np.int64), np.asarray(widths, np.int64)
        self.lanes = [(units, points)]  # from the bottom up
        while len(units) > fan_out:
            starts = np.arange(0, len(units), fan_out)
            units, points = np.add.reduceat(units, starts), np.add.reduceat(points, starts)
            self.lanes.append((units, points))

    def offset(self, rank: int) -> int:
        """Code points before the unit of that rank (0 to ``length``)."""
        if not 0 <= rank <= self.length:
            raise IndexError(rank)
        node, left, passed = 0, rank, 0
        for units, points in reversed(self.lanes):
            stop = min(node + self.fan_out, len(units))
            for width, chars in zip(units[node:stop].tolist(), points[node:stop].tolist()):
                if width > left:
                    break
                left, passed, node = left - width, passed + chars, node + 1
            if not left:
                break
            node *= self.fan_out
        return passed


def draws(key: str) -> list[int]:
    """Four numbers below 2^32 from a key."""
    digest = hashlib.sha256(key.encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def rearranged(
    text: str, key: str, rate: int, spm_rate: int
) -> tuple[str, int, str, int | None, int | None]:
    """Output, units, form, and code points of prefix and middle (None if plain)."""
    widths = unit_widths(text)
    h1, h2, h3, h4 = draws(key)
    if not text or h3 % 100 >= rate or any(mark in text for mark in MARKS):
        return text, len(widths), "plain", None, None
    nodes = SkipList(widths)
    first, second = sorted((h1 % (nodes.length + 1), h2 % (nodes.length + 1)))
    low, high = nodes.offset(first), nodes.offset(second)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < spm_rate:
        form, out = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, out = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return out, nodes.length, form, low, high - low


def transform(
    docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80
) -> DataFrame:
    """doc_id, text (the output), form (plain, psm, spm), n (units), prefix_chars,
    middle_chars, one row per row of ``docs``.

    ``rate`` percent of the documents are rearranged, ``spm_rate`` percent of those
    with the suffix first. Cuts and forms come from SHA-256 of ``seed:doc_id``, so
    reruns and copies of a row agree. Null and empty texts are plain and empty (n
    0); a text that holds a mark is plain; a null id is drawn for as empty. Only id
    and text are read, other columns do not matter. A text of blanks is one unit. Each
    text is cut in one task, in slices of few rows.
    """
    rows = texts(docs)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("key", key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 100):
            found = [
                rearranged(text, key, rate, spm_rate)
                for text, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            out, n, form, prefix, middle = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(form, pa.string()),
                 pa.array(n, pa.int64()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
                ["doc_id", "text", "form", "n", "prefix_chars", "middle_chars"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        cut, f"doc_id {kind}, text string, form string, n long, prefix_chars long, middle_chars long"
    )


def restore(outputs: DataFrame, name: str = "restored") -> DataFrame:
    """Add the original text, rebuilt from ``text`` and ``form`` alone."""

    def after(text, mark):
        """What follows the first such mark."""
        return F.substring(text, F.instr(text, mark) + F.lit(len(mark)), F.length(text))

    def before(text, mark):
        return F.substring_index(text, mark, 1)

    text = F.col("text")
    psm = F.concat(
        after(before(text, SUFFIX), PREFIX), after(text, MIDDLE),
        before(after(text, SUFFIX), MIDDLE),
    )
    spm = F.concat(
        before(after(text, PREFIX), MIDDLE), after(text, MIDDLE),
        after(before(text, PREFIX), SUFFIX),
    )
    return outputs.withColumn(
        name,
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text),
    )
