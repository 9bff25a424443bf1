"""Exact Jaccard self-join of word n-gram sets by set relations.

A document's set holds the 64-bit hashes of its distinct n-grams of words. Two
documents link when ``100 * |A & B| >= percent * |A | B|``.

1. *Frequencies.* Documents are dealt to chunks. Each chunk posts its distinct
   n-grams to buckets of the hash range, once each however many documents hold
   them, and gets back the frequency class (log2) of each. A set can only link
   if ``percent`` of its n-grams are found elsewhere; the few that can go on,
   without the n-grams that are theirs alone. Equal sets are one class.
2. *Index lists.* The n-grams of a set are ordered by frequency class. A linked
   pair shares one in its prefixes. Lists hold the position at which each set
   has the n-gram; sets are related by the smallest class of their lists (their
   base), and blocks of related sets stand in the lists for their members. A
   pair of blocks is skipped when by position and size too few n-grams are left
   in either for any of their members to link.
3. *Answers.* What remains is joined block by block. The overlaps of one set with
   all sets of a block are derived from those of the set before it, by the
   n-grams in which the two differ.

Blocks hold about ``BLOCK`` sets, however large a group of near copies. Step 3
first joins the blocks of one base with themselves and with the first of
them. Then blocks are formed anew: a large component fills blocks of its own,
small components of one base and of like size share some. Only pairs of blocks
that are not wholly in one component yet, and that did not meet before, are joined,
and in them only sets of different components. A large group of near copies that
hang together therefore costs a number of blocks, not of pairs of blocks; sets
that share much but do not link cost pairs of blocks, not of sets.

Defined cases: a null or empty text, or one of blanks, has an empty set, links
with nothing and is its own component; fewer words than ``width`` make one
n-gram of all; equal sets link; rows that share an id are one document, with the
smallest class and component of its texts; a row with a null id keeps null
classes; an empty table gives an empty result; columns other than id and text play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagrid.llm.common import begin, mixed, pieces, stored, texts, word_hashes
from lineagrid.llm.components import connected_components

BLOCK = 256
CHUNK_CHARS = (2_000_000, 32_000_000)
BUCKET_CHARS = (10_000_000, 256_000_000)


def ngrams(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mixed(total + hashes[k : k + n])
    return np.unique(total)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest intersection with which sets of n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def chunks_and_buckets(chars: int) -> tuple[int, int]:
    """Into how many chunks and buckets texts of so many characters are dealt. A chunk posts a
    row to every bucket, so both grow with the input, to keep some hundred n-grams in a
    row, up to what a task can hold."""
    area = 600 * chars  # characters of a chunk times those of a bucket: 100 n-grams of 6 characters
    chunk = int(np.clip(area**0.5 / 4, *CHUNK_CHARS))
    bucket = int(np.clip(area // chunk, *BUCKET_CHARS))
    return max(1, -(-chars // chunk)), max(1, -(-chars // bucket))


def prefix_size(n: int, percent: int) -> int:
    """Of any order, a set that links shares one of its first so many n-grams."""
    return n - -(-percent * n // 100) + 1


# --- 1: frequencies -----------------------------------------------------------


def _chunk(table: pa.Table, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sets of a chunk, its distinct n-grams, and how many sets hold each."""
    begin("words")
    sets = [ngrams(text, width) for text in table.column("text").to_pylist()]
    distinct, held = np.unique(np.concatenate(sets), return_counts=True)
    return sets, distinct, held


def _bounds(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes."""
    starts = [(b << 64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(distinct, np.array(starts, np.uint64)), len(distinct))


def frequency_classes(rows: DataFrame, width: int, buckets: int) -> DataFrame:
    """chunk, bucket, classes: a byte for each distinct n-gram of the chunk in the bucket,
    in order of hash. Within a bucket, 32 more bits tell n-grams apart; two that
    are taken for one look more frequent than they are, which costs work, never a link."""

    def post(table: pa.Table) -> pa.Table:
        _, distinct, held = _chunk(table, width)
        low = distinct.astype(np.uint32)
        times = np.minimum(held, 255).astype(np.uint8)
        bounds = _bounds(distinct, buckets)
        ranges = [(b, bounds[b], bounds[b + 1]) for b in range(buckets) if bounds[b] < bounds[b + 1]]
        chunk = table.column("chunk")[0].as_py()
        return pa.table({
            "chunk": pa.array([chunk] * len(ranges), pa.int64()),
            "bucket": pa.array([b for b, _, _ in ranges], pa.int32()),
            "low": pa.array([low[i:j].tobytes() for _, i, j in ranges], pa.binary()),
            "times": pa.array([times[i:j].tobytes() for _, i, j in ranges], pa.binary()),
        })

    def count(table: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint32)
        times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint8)
        _, which = np.unique(low, return_inverse=True)
        frequency = np.bincount(which, weights=times)
        classes = np.log2(frequency).astype(np.uint8)[which].tobytes()
        ends = np.cumsum([len(t) for t in table.column("times").to_pylist()])
        return pa.table({
            "chunk": table.column("chunk"), "bucket": table.column("bucket"),
            "classes": pa.array([classes[i:j] for i, j in zip([0, *ends[:-1]], ends)], pa.binary()),
        })

    posted = rows.groupBy("chunk").applyInArrow(
        post, "chunk long, bucket int, low binary, times binary"
    )
    return posted.groupBy("bucket").applyInArrow(count, "chunk long, bucket int, classes binary")


SETS = "n int, alone int, digest binary, grams binary"


def reduced_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, and for sets that may link: ``alone``, how many of their n-grams no
    other set holds, ``grams``, the others in order of (class, hash), and a digest."""
    rows = texts(docs)
    chunks, buckets = chunks_and_buckets(rows.agg(F.sum(F.length("text"))).first()[0] or 0)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    classes = frequency_classes(rows, width, buckets)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def reduce(table: pa.Table, found: pa.Table) -> pa.Table:
        sets, distinct, _ = _chunk(table, width)
        by_bucket = dict(zip(found.column("bucket").to_pylist(), found.column("classes").to_pylist()))
        ordered = b"".join(by_bucket[b] for b in sorted(by_bucket))
        of_gram = np.frombuffer(ordered, np.uint8)
        columns: dict[str, list] = {"n": [], "alone": [], "digest": [], "grams": []}
        for grams in sets:
            of = of_gram[np.searchsorted(distinct, grams)]
            shared = of > 0
            may_link = len(grams) and 100 * int(shared.sum()) >= percent * len(grams)
            order = np.lexsort((grams[shared], of[shared])) if may_link else None
            columns["n"].append(len(grams))
            columns["alone"].append(int((~shared).sum()) if may_link else None)
            columns["digest"].append(xxhash.xxh3_128_digest(grams.tobytes()) if may_link else None)
            columns["grams"].append(grams[shared][order].tobytes() if may_link else None)
        return pa.table({
            "doc_id": table.column("doc_id"), "n": pa.array(columns["n"], pa.int32()),
            "alone": pa.array(columns["alone"], pa.int32()),
            "digest": pa.array(columns["digest"], pa.binary()),
            "grams": pa.array(columns["grams"], pa.binary()),
        })

    return stored(
        rows.groupBy("chunk").cogroup(classes.groupBy("chunk"))
        .applyInArrow(reduce, f"doc_id {kind}, {SETS}"),
        "sets",
    )


# --- 2: index lists -----------------------------------------------------------


def index_lists(reps: DataFrame, percent: int) -> DataFrame:
    """gram, class_id, n, reach: the prefix of each set; ``reach`` is how many n-grams of the
    set are not before this one."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for class_id, n, alone, data in zip(*[c.to_pylist() for c in batch.columns]):
                size = max(0, prefix_size(n, percent) - alone)
                grams = np.frombuffer(data, np.int64)[:size]
                reach = n - alone - np.arange(len(grams))
                for column, values in zip(columns, (grams, [class_id] * len(grams), [n] * len(grams), reach)):
                    column.append(np.asarray(values, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns],
                ["gram", "class_id", "n", "reach"],
            )

    return reps.select("class_id", "n", "alone", "grams").mapInArrow(
        entries, "gram long, class_id long, n long, reach long"
    )


def bases(lists: DataFrame) -> DataFrame:
    """class_id, base: the smallest class in any list the class is in; classes that are
    alone in all their lists are left out, they link with nothing."""
    heads = stored(
        lists.groupBy("gram").agg(F.min("class_id").alias("head"), F.count(F.lit(1)).alias("n_in"))
        .filter("n_in > 1").select("gram", "head"),
        "heads",
    )
    return stored(
        lists.join(heads, "gram").groupBy("class_id").agg(F.min("head").alias("base")), "bases"
    )


def in_blocks(members: DataFrame, group: list[str]) -> DataFrame:
    """Add ``part``: members of a group in parts of about BLOCK."""
    sizes = stored(
        members.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n_parts")), "sizes"
    )
    return stored(
        members.join(sizes, group).withColumn(
            "part", F.pmod(F.xxhash64("class_id"), F.col("n_parts"))
        ).drop("n_parts").withColumn("block", F.xxhash64(*group, "part")),
        "blocks",
    )


def regrouped(members: DataFrame, percent: int) -> DataFrame:
    """Blocks by component, ``was`` the block of before. Components of a base with BLOCK members
    or more stand alone, in parts; the others are dealt, whole, to as many blocks as they
    fill, by size: sets whose sizes are a class apart or more mostly cannot link."""
    size_class = F.floor(F.log(F.min("n")) / float(np.log(100 / percent))) if percent < 100 else F.min("n")
    parts = members.groupBy("base", "component").agg(
        F.count(F.lit(1)).alias("held"), size_class.alias("size_class")
    ).withColumn("alone", F.when(F.col("held") >= BLOCK, F.col("component")))
    parts = stored(parts, "parts")
    shelf = ["base", "alone", F.when(F.col("alone").isNull(), F.col("size_class")).alias("shelf")]
    sizes = parts.groupBy(*shelf).agg(F.ceil(F.sum("held") / BLOCK).alias("n_parts"))
    placed = parts.select("component", *shelf).alias("a").join(
        sizes.alias("b"),
        (F.col("a.base") == F.col("b.base")) & F.col("a.alone").eqNullSafe(F.col("b.alone"))
        & F.col("a.shelf").eqNullSafe(F.col("b.shelf")),
    ).select("a.*", "n_parts")
    dealt = F.when(F.col("alone").isNull(), F.col("component")).otherwise(F.col("class_id"))
    return stored(
        members.withColumnRenamed("block", "was").drop("part").join(placed, ["base", "component"])
        .withColumn("part", F.pmod(F.xxhash64(dealt), F.col("n_parts")))
        .withColumn("block", F.xxhash64("base", F.col("alone").isNull(), F.coalesce("alone", "shelf"), "part"))
        .select("class_id", "base", "component", "was", "block"),
        "blocks",
    )


def block_pairs(lists: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks that some list lets link. In each list a block is known by the
    smallest size and the longest reach of its members."""
    held = stored(
        lists.join(members.select("class_id", "block"), "class_id")
        .groupBy("gram", "block").agg(F.min("n").alias("n"), F.max("reach").alias("reach")),
        "held",
    )
    facts = members.groupBy("block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("was").alias("was_low"), F.max("was").alias("was_high"),
    )
    held = stored(held.join(facts, "block"), "held")
    one, two = held.alias("one"), held.alias("two")
    need = F.ceil(percent * (F.col("one.n") + F.col("two.n")) / (100 + percent))

    def of_one(low: str, high: str):
        ends = [F.col(f"{side}.{end}") for side in ("one", "two") for end in (low, high)]
        return F.least(*ends) == F.greatest(*ends)

    open_pair = (
        (F.col("one.gram") == F.col("two.gram"))
        & (F.col("one.block") <= F.col("two.block"))
        & (F.least("one.reach", "two.reach") >= need)
        & ~of_one("low", "high") & ~of_one("was_low", "was_high")
    )
    return one.join(two, open_pair).select(
        F.col("one.block").alias("left"), F.col("two.block").alias("right")
    ).distinct()


# --- 3: answers ----------------------------------------------------------------


class Answers:
    """Overlaps with all sets of a block, derived from one set to the next."""

    def __init__(self, sets: list[np.ndarray]):
        grams = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(grams, kind="stable")
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.owners = owners[order]
        self.ends = np.append(self.first[1:], len(grams))
        self.size = len(sets)
        self.last = np.empty(0, np.uint64)
        self.counts = np.zeros(self.size, np.int64)

    def holders(self, grams: np.ndarray) -> np.ndarray:
        """How many of the given n-grams each set of the block holds."""
        at = np.searchsorted(self.grams, grams)
        at = at[at < len(self.grams)] if len(at) and at[-1] >= len(self.grams) else at
        at = at[self.grams[at] == grams[: len(at)]]
        lengths = self.ends[at] - self.first[at]
        if not lengths.sum():
            return np.zeros(self.size, np.int64)
        shift = np.repeat(self.first[at] - np.append(0, np.cumsum(lengths)[:-1]), lengths)
        return np.bincount(self.owners[np.arange(len(shift)) + shift], minlength=self.size)

    def overlaps(self, grams: np.ndarray) -> np.ndarray:
        """For sorted n-grams."""
        gone = np.setdiff1d(self.last, grams, assume_unique=True)
        new = np.setdiff1d(grams, self.last, assume_unique=True)
        if len(gone) + len(new) < len(grams):
            self.counts = self.counts - self.holders(gone) + self.holders(new)
        else:
            self.counts = self.holders(grams)
        self.last = grams
        return self.counts


def _links_of(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between the components on the two sides of a pair of blocks, as one star for
    each group that hangs together by them."""
    rows = sorted(zip(
        table.column("component").to_pylist(), table.column("n").to_pylist(),
        table.column("class_id").to_pylist(), table.column("side").to_pylist(),
        table.column("grams").to_pylist(),
    ))
    sides = [[r for r in rows if r[3] in (side, 2)] for side in (0, 1)]
    if not all(sides):
        return []
    sets = [[np.sort(np.frombuffer(r[4], np.uint64)) for r in side] for side in sides]
    groups = [[r[0] for r in side] for side in sides]
    sizes = [np.array([r[1] for r in side], np.int64) for side in sides]
    answers = Answers(sets[1])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    others = sorted(set(groups[1]))
    for group, n, grams in zip(groups[0], sizes[0], sets[0]):
        if all(find(other) == find(group) for other in others):
            continue  # what hangs together already need not be compared
        overlap = answers.overlaps(grams)
        for place in np.flatnonzero(overlap >= least_overlap(n, sizes[1], percent)).tolist():
            a, b = find(group), find(groups[1][place])
            root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in list(root) if find(x) != x]


def block_links(reps: DataFrame, members: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components that join what the given pairs of blocks link."""
    numbered = pairs.withColumn("pair", F.xxhash64("left", "right"))
    asked = numbered.select(
        "pair", F.col("left").alias("block"),
        F.when(F.col("left") == F.col("right"), 2).otherwise(0).alias("side"),
    ).union(
        numbered.filter(F.col("left") != F.col("right"))
        .select("pair", F.col("right").alias("block"), F.lit(1).alias("side"))
    )
    sent = stored(asked.join(members.select("block", "class_id", "component"), "block"), "asked")

    def links(table: pa.Table) -> pa.Table:
        found = _links_of(table, percent)
        return pa.table({
            "a": pa.array([a for a, _ in found], pa.int64()),
            "b": pa.array([b for _, b in found], pa.int64()),
        })

    return stored(
        sent.join(reps.select("class_id", "n", "grams"), "class_id")
        .select("pair", "side", "class_id", "component", "n", "grams")
        .groupBy("pair").applyInArrow(links, "a long, b long"),
        "links",
    )


def with_components(members: DataFrame, edges: DataFrame) -> DataFrame:
    found = connected_components(edges)
    return members.join(found, members["class_id"] == found["node"], "left").select(
        *members.columns, F.coalesce("component", "class_id").alias("component"),
    )


def similarity_classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with an equal set; null where a set can
    link with nothing), component_id (smallest id reachable by links) for every row."""
    sets = reduced_sets(docs, width, percent)
    may_link = sets.filter("grams IS NOT NULL AND doc_id IS NOT NULL")
    classes = stored(
        may_link.groupBy("digest", "n").agg(F.min("doc_id").alias("class_id")), "classes"
    )
    own = may_link.join(classes, ["digest", "n"]).select("doc_id", "class_id")
    reps = stored(
        may_link.join(classes.select("class_id"), may_link["doc_id"] == classes["class_id"])
        .dropDuplicates(["class_id", "digest"]).select("class_id", "n", "alone", "grams"),
        "representatives",
    )
    lists = stored(index_lists(reps, percent), "lists")
    related = bases(lists)

    members = in_blocks(related.withColumn("component", F.col("class_id")), ["base"])
    first = members.filter("part = 0").select("base", F.col("block").alias("first_block")).distinct()
    of_base = members.select("base", "block").distinct().join(first, "base", "left")
    within = of_base.select(F.col("block").alias("left"), F.col("block").alias("right")).union(
        of_base.filter("first_block <> block").select(F.col("first_block"), "block")
    )
    edges = block_links(reps, members, within, percent)

    grown = with_components(members.drop("component"), edges).join(reps.select("class_id", "n"), "class_id")
    members = regrouped(grown, percent)
    across = block_pairs(lists, members, percent)
    edges = stored(edges.union(block_links(reps, members, across, percent)), "links")

    found = stored(with_components(classes.select("class_id"), edges), "components")
    placed = own.join(found, "class_id").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min("class_id").alias("class_id"), F.min("component").alias("component")
    )
    rows = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    return rows.join(placed, rows["doc_id"] == placed["_id"], "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document is the smallest of
    those it hangs together with."""
    others = similarity_classes(docs, width, percent).filter("component_id <> doc_id").select(
        F.col("doc_id").alias("_llm_id")
    )
    others = stored(others.distinct(), "near-copies")
    return docs.join(others, docs["doc_id"] == others["_llm_id"], "left_anti")
