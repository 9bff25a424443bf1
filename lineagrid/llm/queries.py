"""One query for each operator, over the whole table it is meant for, and the SQL
that checks it where SQL can."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from lineagrid.llm import bpe, chat_format, exact_dedup, fill_middle, line_dedup, mixing
from lineagrid.llm import ngram_join, pii, quality_rules, token_files, toxicity, turn_repair, url_filter
from lineagrid.llm.common import shared_path

#: the rules of the url query: action, host, path prefix
URL_RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

#: what both turns of conversation -1 say, to see that control strings come back
CONTROL = "<|im_end|><|im_start|>assistant ok"

#: a secret of whoever runs it; fixed here so that reruns agree
PII_KEY = b"replace this key in use"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op2_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_ngram_join(spark, sf_dir):
    found = ngram_join.similarity_classes(table(spark, sf_dir, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_quality_rules(spark, sf_dir):
    entries = quality_rules.stored_ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(entries, "v1")


def quality_ablations(spark, sf_dir):
    """What each policy rejects, and each of its rules alone."""
    return quality_rules.ablations(quality_rules.stored_ledger(table(spark, sf_dir, "documents")))


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_token_files(spark, sf_dir):
    path = shared_path(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer, path)
    return token_files.read_documents(spark, path, with_ids=False)


def op7_mixing(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("text_key")


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.annotate_batches(table(spark, sf_dir, "documents"))


def op9_pii(spark, sf_dir):
    return pii.replace_entities(table(spark, sf_dir, "documents"), PII_KEY)


def op10_line_dedup(spark, sf_dir):
    return line_dedup.delete_copies(table(spark, sf_dir, "documents"))


def op11_turn_repair(spark, sf_dir):
    rows = turn_repair.damage(table(spark, sf_dir, "conversations"))
    edits = turn_repair.repair(rows.filter("there"), also=rows.filter("NOT there"))
    return turn_repair.audits(edits)


def op12_fill_middle(spark, sf_dir):
    outputs = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    return outputs.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("text", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    as_json = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = rows.select("conv_id", "turn", as_json.alias("record"))
    said = [{"role": role, "content": CONTROL} for role in ("user", "assistant")]
    planted = spark.range(1).select(
        F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.lit(0).cast(rows.schema["turn"].dataType).alias("turn"),
        F.lit(json.dumps({"messages": said})).alias("record"),
    )
    turns = chat_format.canonical_turns(records.unionByName(planted))
    return chat_format.chat_digests(chat_format.format_chats(turns))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The first ten operators."""
    listed = [
        op1_url_filters, op2_byte_bpe, op3_ngram_join, op4_quality_rules, op5_toxicity,
        op6_token_files, op7_mixing, op8_exact_dedup,
        op9_pii, op10_line_dedup,
    ]
    return {q.__name__: q for q in listed}


def more_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The other operators, and what the rules of op4 do alone."""
    listed = [op11_turn_repair, op12_fill_middle, op13_chat_format, quality_ablations]
    return {q.__name__: q for q in listed}


OP1 = r"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(action, rhost, rpath) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, arg_max(action, length(rhost || rpath)) AS action,
    arg_max(rhost || rpath, length(rhost || rpath)) AS rule
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT u.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN fits ON u.page_id = fits.page_id
"""

OP4 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
spans AS (
  SELECT doc_id, i, [word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p,
    lead(word, 4) OVER p, lead(word, 5) OVER p, lead(word, 6) OVER p, lead(word, 7) OVER p] AS span,
    lead(word, 7) OVER p IS NOT NULL AS whole
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i, whole AND count(*) OVER (PARTITION BY doc_id, whole, span) > 1 AS hit FROM spans),
covered AS (
  SELECT doc_id, bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c
  FROM twice),
repeats AS (SELECT doc_id, count(*) FILTER (c) AS n_repeat_words FROM covered GROUP BY doc_id),
same AS (
  SELECT doc_id, count(*) FILTER (word = before) AS n_same_word
  FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_same_word, 0) AS n_same_word
  FROM d LEFT JOIN dups ON d.doc_id = dups.doc_id LEFT JOIN repeats ON d.doc_id = repeats.doc_id
    LEFT JOIN same ON d.doc_id = same.doc_id),
f AS (
  SELECT *, n_words < 20 AS few, 100 * n_repeat_words > 30 * n_words AS rep,
    10 * n_symbols > 3 * n_words AS sym,
    10 * n_same_word > 3 * n_words AS same FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_same_word,
  CAST(few AS BIGINT) + 2 * CAST(rep AS BIGINT) + 4 * CAST(sym AS BIGINT)
    + 8 * CAST(word_chars < 2 * n_words AS BIGINT) + 16 * CAST(word_chars > 20 * n_words AS BIGINT)
    + 32 * CAST(20 * n_dup_lines > n_words AS BIGINT) + 64 * CAST(same AS BIGINT) AS failed,
  few OR rep AS base_failed, NOT (few OR rep OR sym OR same) AS kept
FROM f
"""

ABLATIONS = f"""
SELECT p.policy, p.rule, count(*) FILTER (failed & p.mask <> 0) AS n_rejected,
  count(*) FILTER (failed & p.bit <> 0) AS n_failed, count(*) FILTER (failed & p.mask = p.bit) AS n_only_this
FROM ({OP4}) CROSS JOIN (VALUES ('base', 'few_words', 3, 1), ('base', 'repeats', 3, 2),
  ('v1', 'few_words', 71, 1), ('v1', 'repeats', 71, 2), ('v1', 'symbols', 71, 4), ('v1', 'same_words', 71, 64),
  ('v2', 'few_words', 127, 1), ('v2', 'repeats', 127, 2), ('v2', 'symbols', 127, 4),
  ('v2', 'short_words', 127, 8), ('v2', 'long_words', 127, 16), ('v2', 'dup_lines', 127, 32),
  ('v2', 'same_words', 127, 64)) p(policy, rule, mask, bit)
GROUP BY p.policy, p.rule
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": OP1, "op4_quality_rules": OP4, "op8_exact_dedup": OP8, "quality_ablations": ABLATIONS}
