"""Operators that compare documents, and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import corpus_pipeline
import pytest
from cases import components, document, no_documents, odd_documents, prose, shingles, words
from cases import SCHEMA
from pyspark.sql import functions as F

from lineagrid.llm import components as graph
from lineagrid.llm import exact_dedup, line_dedup, mixing, ngram_join
from lineagrid.llm.common import stored
from lineagrid.llm.queries import queries

SF = "/root/testdata/sf0.001"


# --- exact dedup -----------------------------------------------------------------------


def folded(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_copies_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = exact_dedup.annotate_exact_copies(docs).collect()
    texts = {r.doc_id: folded(r.text) for r in docs.collect()}
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[folded(r.text)].append(r.doc_id)
    assert len(rows) == docs.count()
    for r in rows:
        of = groups[texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(of), len(of), r.doc_id == min(of))
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    kept = exact_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(of) for of in groups.values())
    assert exact_dedup.annotate_exact_copies(no_documents(spark)).count() == 0


def test_index_remembers_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    index = exact_dedup.DigestIndex(spark, "remembered", path, buckets=3)
    first = spark.createDataFrame([document(7, "a b"), document(8, "c"), document(9, None)], SCHEMA)
    second = spark.createDataFrame([document(1, "a\nb"), document(2, "d"), document(None, "d")], SCHEMA)
    assert {r.doc_id: r.kept for r in index.annotate(first).collect()} == {7: True, 8: True, 9: True}
    again = {r.doc_id: (r.keep_id, r.kept) for r in index.annotate(second).collect()}
    assert again == {1: (7, False), 2: (2, True), None: (2, False)}
    index.drop()
    found = exact_dedup.DigestIndex(spark, "remembered_again", path, buckets=3)
    assert found.digests().count() == 4
    assert [r.doc_id for r in found.keep(second).collect()] == [2]
    found.drop()


def test_index_is_read_in_order_and_compacted(spark, monkeypatch):
    """Runs are neither exchanged nor sorted when a batch meets them; many become one."""
    index = exact_dedup.new_index(spark)
    for i in range(3):
        index.annotate(spark.createDataFrame([document(i, f"text {i}"), document(9, "same")], SCHEMA))
    assert len(index.runs) == 3 and index.digests().count() == 4
    batch = stored(spark.createDataFrame([document(5, "same")], SCHEMA).select(
        exact_dedup.digest(F.col("text")).alias("digest"), F.lit(1).alias("group_size")), "batch")
    plan = index.look_up(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    monkeypatch.setattr(exact_dedup, "MAX_RUNS", 3)
    index.annotate(spark.createDataFrame([document(7, "new")], SCHEMA))
    assert len(index.runs) == 1 and index.digests().count() == 5
    path, files = index._folder()
    assert len(files.listStatus(path)) == 1
    index.delete()
    assert not files.listStatus(path)


@pytest.mark.parametrize("n_batches", [1, 2, 5])
def test_batches_say_what_the_whole_says(spark, n_batches):
    docs = odd_documents(spark).unionByName(spark.createDataFrame([document(None, "One word"), document(-8, "")], SCHEMA))
    whole = sorted(map(tuple, exact_dedup.annotate_exact_copies(docs).collect()), key=repr)
    parts = sorted(map(tuple, exact_dedup.annotate_batches(docs, n_batches=n_batches).collect()), key=repr)
    assert parts == whole
    assert exact_dedup.annotate_batches(no_documents(spark)).count() == 0


# --- n-gram join ---------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = graph.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {
        **{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)},
    }
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(spark, n):
    """A group of near copies in which some pairs link only through others."""
    draw = random.Random(11)
    base = prose(4, 90).split()
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(len(text))] = f"new{draw.randrange(6)}"
        rows.append(document(1000 - 3 * k, " ".join(text)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [256, 7])
def test_near_copies_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "CHUNK_CHARS", (5_000, 9_000))
    monkeypatch.setattr(ngram_join, "BUCKET_CHARS", (3_000, 7_000))
    docs = near_copies(spark, 60).union(odd_documents(spark))
    rows = ngram_join.similarity_classes(docs, 4, 85).collect()
    sets = {r.doc_id: shingles(r.text, 4) for r in docs.collect()}
    want = components(sets, 85)
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert 1 < len({want[r.doc_id] for r in rows if r.doc_id > 500}) < 60


def from_pools(spark, n):
    """Documents made of one template's text and paragraphs of a pool: each n-gram is found
    elsewhere, but most documents link with nothing; some are near copies of another."""
    draw = random.Random(5)
    template, pool = prose(1, 60), [prose(k, 12) for k in range(2, 40)]
    rows = []
    for k in range(n):
        text = " ".join([template, *draw.sample(pool, 4)])
        rows.append(document(2 * k, text if k % 5 else text + " end"))
        if k % 10 == 0:
            rows.append(document(2 * k + 1, text + " ending"))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [256, 16])
def test_sets_that_share_but_do_not_link_share_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    asked = []
    links = ngram_join.block_links
    monkeypatch.setattr(
        ngram_join, "block_links",
        lambda reps, members, pairs, percent: asked.append((members, pairs)) or links(reps, members, pairs, percent),
    )
    docs = from_pools(spark, 150)
    found = {r.doc_id: r.component_id for r in ngram_join.similarity_classes(docs, 4, 85).collect()}
    assert found == components({r.doc_id: shingles(r.text, 4) for r in docs.collect()}, 85)
    assert 100 < len(set(found.values())) < len(found)
    members, pairs = asked[1]
    n_blocks = members.select("block").distinct().count()
    assert n_blocks < 30 + 3 * len(found) / block
    assert pairs.count() <= n_blocks * (n_blocks + 1) / 2
    if block == 256:  # all of them met in the first pass
        assert pairs.filter("left = right").count() == 0


def test_chunks_and_buckets_grow_with_the_input():
    assert ngram_join.chunks_and_buckets(0) == (1, 1)
    # n-grams in a row posted; at 100 TB a task can hold no more
    for chars, in_a_row in ((10**9, 90), (10**11, 90), (10**12, 90), (10**14, 10)):
        chunks, buckets = ngram_join.chunks_and_buckets(chars)
        assert chars / 6 / chunks / buckets > in_a_row
        assert ngram_join.BUCKET_CHARS[0] / 2 < chars / buckets < 2 * ngram_join.BUCKET_CHARS[1]


def test_one_of_each_near_copy(spark):
    docs = odd_documents(spark)
    kept = ngram_join.one_of_each(docs)
    want = components({r.doc_id: shingles(r.text, 5) for r in docs.collect()}, 80)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if k == v}
    assert ngram_join.one_of_each(no_documents(spark)).count() == 0


def test_answers_by_differences():
    import numpy as np

    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, 30).astype(np.uint64)) for _ in range(20)]
    answers = ngram_join.Answers(sets)
    for asked in [*sets, sets[0][:0], np.array([99], np.uint64)]:
        assert answers.overlaps(asked).tolist() == [len(np.intersect1d(asked, s)) for s in sets]


# --- mixing ---------------------------------------------------------------------------------


def wanted_targets(sizes, limit=3):
    weigh = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        weight = sum(w for s, w in weigh.items() if s not in full) or 1
        over = {s for s in sizes if s not in full and weigh[s] * rest / weight > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else weigh[s] * rest / weight for s in sizes}
        full |= over


@pytest.mark.parametrize("block_words", [7, 256])
def test_mix_meets_targets(spark, block_words):
    docs = odd_documents(spark)
    source = {(r.doc_id, r.text): r.source for r in docs.collect()}
    by_id = {k[0]: v for k, v in source.items()}
    rows = mixing.taken_words(docs, block_words=block_words).collect()
    assert len(rows) == docs.count()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[by_id[r.doc_id]] += r.size
        taken[by_id[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = wanted_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[by_id[r.doc_id]])
        assert r.source_size == sizes[by_id[r.doc_id]]
    assert all(abs(taken[s] - want[s]) <= 0.5001 for s in sizes)
    assert sorted(rows) == sorted(mixing.taken_words(docs, block_words=block_words).collect())


def test_mix_interleaves_sources(spark):
    rows = [document(i, prose(i), s) for i, s in enumerate("aabbbbbccc" * 20)]
    mixed, sizes, facts = mixing.mix(spark.createDataFrame(rows, SCHEMA), block_words=20)
    by_row = {r.row_no: r.source for r in sizes.collect()}
    slots = sorted((r.slot, by_row[r.row_no], r.words) for r in mixed.collect())
    share = {r.source: r.target for r in facts.collect()}
    total, seen, done = sum(share.values()), collections.Counter(), 0
    for _, source, n in slots:
        seen[source] += n
        done += n
        for s in share:
            assert abs(seen[s] - done * share[s] / total) < 20 * 12


def test_mixed_documents_are_whole(spark):
    docs = odd_documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    rows = mixed.collect()
    assert {(r.doc_id, r.text) for r in rows} <= texts
    taken, size = collections.Counter(), {}
    for r in mixing.taken_words(docs).filter("taken > 0").collect():
        taken[r.doc_id] += r.taken
        size[r.doc_id] = r.size
    want = {i: (2 * n + size[i]) // (2 * size[i]) for i, n in taken.items()}
    assert collections.Counter(r.doc_id for r in rows) == {i: n for i, n in want.items() if n}
    assert mixing.mixed_documents(no_documents(spark)).count() == 0
    assert mixing.taken_words(no_documents(spark)).count() == 0


# --- line dedup -------------------------------------------------------------------------------


def plain_line_dedup(rows, min_words):
    """Every pair of places, extended as far as it goes."""
    docs = [(i, (t or "").split("\n")) for i, t in rows]
    worded = [[(k, x, len(words(x))) for k, x in enumerate(lines) if words(x)] for _, lines in docs]
    out = []
    for d, (_, lines) in enumerate(docs):
        cut = set()
        for j in range(len(worded[d])):
            for e in range(d + 1):
                for k in range(len(worded[e]) if e < d else j):
                    n, total = 0, 0
                    while j + n < len(worded[d]) and k + n < len(worded[e]) \
                            and worded[d][j + n][1] == worded[e][k + n][1]:
                        total += worded[d][j + n][2]
                        n += 1
                    if total >= min_words:
                        cut |= set(range(worded[d][j][0], worded[d][j + n - 1][0] + 1))
        for (k, _, _), (after, _, _) in zip(worded[d], worded[d][1:]):
            if {k, after} <= cut:
                cut |= set(range(k, after))
        out.append(("\n".join(x for k, x in enumerate(lines) if k not in cut), len(cut)))
    return out


@pytest.mark.parametrize("min_words", [1, 3, 10])
def test_copied_runs_against_all_pairs(spark, min_words):
    draw = random.Random(13)
    lines = ["", " ", "a", "b c", "d e f", "g", "h i j k"]
    rows = [(i, "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 12)))) for i in range(25)]
    docs = spark.createDataFrame([document(i, t) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.delete_copies(docs, min_words).collect()}
    assert [got[i] for i, _ in rows] == plain_line_dedup(rows, min_words)


def test_copied_runs_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = {r.doc_id: r for r in line_dedup.delete_copies(docs).collect()}
    assert line_dedup.delete_copies(docs).count() == docs.count()
    assert rows[1].text is None and rows[2].text == "" and rows[3].text == " \n\t "
    assert (rows[17].text, rows[17].n_removed) == ("intro", 1)
    assert rows[10].text == "" and rows[9].n_removed == 0 and rows[13].n_removed == 0
    assert line_dedup.delete_copies(no_documents(spark)).count() == 0


# --- pipeline and queries ----------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "ngram_join", "mixing", "byte_bpe",
    ]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = corpus_pipeline.stored(stage(spark, before, SF), name)
        after[name] = before
        assert name == "byte_bpe" or before.columns == columns
    ids = {name: [r.doc_id for r in df.collect()] for name, df in after.items()}
    text = {r.doc_id: r.text for r in docs.collect()}
    groups = collections.defaultdict(list)
    for i in ids["quality_rules"]:
        groups[folded(text[i])].append(i)
    assert sorted(ids["exact_dedup"]) == sorted(min(g) for g in groups.values())
    near = components({i: shingles(text[i], 5) for i in ids["exact_dedup"]}, 80)
    assert sorted(ids["ngram_join"]) == sorted(i for i, c in near.items() if i == c)
    assert sorted(ids["mixing"]) == sorted(ids["byte_bpe"])
    assert corpus_pipeline.run(spark, SF).count() == len(ids["byte_bpe"])


def test_every_operator_is_registered():
    numbers = [re.match(r"op(\d+)_", name)[1] for name in queries()]
    assert sorted(map(int, numbers)) == list(range(1, 11))


def test_join_query_against_all_pairs(spark):
    rows = queries()["op3_ngram_join"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sets = {r.doc_id: shingles(r.text, 4) for r in docs}
    want = components(sets, 85)
    assert sorted(tuple(r) for r in rows) == sorted((i, len(s), want[i]) for i, s in sets.items())


def test_line_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = [tuple(r) for r in rows.collect()]
    got = {r.doc_id: (r.text, r.n_removed) for r in queries()["op10_line_dedup"](spark, SF).collect()}
    assert [got[i] for i, _ in rows] == plain_line_dedup(rows, line_dedup.MIN_WORDS)


def test_toxicity_query_columns(spark):
    rows = queries()["op5_toxicity"](spark, SF)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    assert rows.filter((F.col("score") >= 0.5) != (F.col("predicted") == 1)).count() == 0
