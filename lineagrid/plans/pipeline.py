"""The whole job: statements in, lineage and report out."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagrid.functions.text import clean_statement, strip, unmark_placeholders
from lineagrid.functions.words import CLAUSES
from lineagrid.operators import facts, lists, report, scopes
from lineagrid.operators.lineage import clause_number, mention_rows
from lineagrid.operators.predicates import attribute, condition_mentions
from lineagrid.operators.render import render
from lineagrid.operators.resolve import (
    Model, expand_outputs, resolve, scope_names, sort_columns, with_node,
)
from lineagrid.operators.shapes import STAND_IN, as_shape, places, text_columns, with_number
from lineagrid.operators.tokens import distinct_shapes, read_shapes, shaped, text_key, token_table
from lineagrid.session import (
    drop_job, in_job, keep, keep_bucketed, keep_sized, on_shapes, prepare, settings_for, together,
    with_settings,
)


# Copies of one text that go through one join key where results go back to the statements.
COPIES_PER_PART = 20_000


class Lineage:
    """Column lineage of a table (stmt_id, JOB_NAME, READ_MODE, SELECT_STATEMENT).

    Only rows whose READ_MODE is exactly ``Select`` are read. Every property is
    computed at most once and kept in the shared checkpoint folder. Without
    ``scan_text`` no name is guessed from the plain text of a statement.
    """

    def __init__(self, statements: DataFrame, scan_text: bool = True):
        prepare(statements.sparkSession)
        self.job_id = uuid.uuid4().hex
        self.scan_text = scan_text
        self.statements = statements.filter(F.col("READ_MODE") == "Select")

    def close(self) -> None:
        """Drop the tables the job has kept; its results can be read no longer."""
        drop_job(self.statements.sparkSession, self.job_id)

    def __enter__(self) -> Lineage:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    @cached_property
    @in_job
    def keyed(self) -> DataFrame:
        """(stmt_id, JOB_NAME, h, shape, number, number_at) of every statement with a text. Shapes
        are found once, in the only pass over the texts; few different ones take little room here.
        Empty texts go after that pass: a filter ahead of it would clean each text twice."""
        found = self._keyed_statements().drop("READ_MODE", "SELECT_STATEMENT", "text")
        return keep_sized(found).filter("shape <> ''")

    @cached_property
    @in_job
    def shapes(self) -> DataFrame:
        return keep_sized(distinct_shapes(self.keyed))

    @cached_property
    @in_job
    def shape_settings(self) -> dict[str, str]:
        """Settings for work on the shapes, by the characters they have."""
        n_characters = self.shapes.agg(F.sum(F.length("text"))).first()[0]
        return settings_for(self.statements.sparkSession, n_characters or 0)

    @cached_property
    @on_shapes
    def texts(self) -> DataFrame:
        return keep_bucketed(read_shapes(self.shapes), "texts")

    @cached_property
    @in_job
    def instances(self) -> DataFrame:
        """(h, number, seq): the different texts of each shape, with their first statement."""
        return keep_sized(self.keyed.groupBy("h", "number").agg(F.min("stmt_id").alias("seq")))

    @cached_property
    @on_shapes
    def tokens(self) -> DataFrame:
        return keep_bucketed(facts.with_references(token_table(self.texts)), "tokens")

    @cached_property
    @on_shapes
    def scopes(self) -> DataFrame:
        return keep_bucketed(facts.scopes_of(self.tokens, self.pivots), "scopes")

    @cached_property
    @on_shapes
    def pivots(self) -> DataFrame:
        return facts.pivots_of(self.tokens)

    @cached_property
    @on_shapes
    def blocks(self) -> DataFrame:
        return keep_bucketed(facts.blocks_of(self.tokens, self.scopes), "blocks")

    @cached_property
    @on_shapes
    def ctes(self) -> DataFrame:
        return facts.ctes_of(self.scopes)

    @cached_property
    @on_shapes
    def tables(self) -> DataFrame:
        mentions = facts.table_mentions(self.tokens, self.pivots)
        return keep_bucketed(facts.tables_with_cte(mentions, self.ctes), "tables")

    @cached_property
    @on_shapes
    def ranges(self) -> DataFrame:
        return keep_bucketed(facts.block_ranges(self.blocks, self.tables), "ranges")

    @cached_property
    @on_shapes
    def sources(self) -> DataFrame:
        found = facts.sources_of(self.blocks, self.scopes, self.tables, self.ranges)
        return keep_bucketed(found, "sources")

    @cached_property
    @on_shapes
    def segments(self) -> DataFrame:
        return keep_bucketed(facts.segments_of(self.tokens, self.blocks), "segments")

    @cached_property
    @on_shapes
    def refs(self) -> DataFrame:
        return keep_bucketed(with_node(facts.references_of(self.tokens)), "refs")

    @cached_property
    @on_shapes
    def outputs(self) -> DataFrame:
        found = facts.outputs_of(self.tokens, self.segments, self.refs, self.scopes)
        return keep_bucketed(found, "outputs")

    @cached_property
    @on_shapes
    def model(self) -> Model:
        info = keep_bucketed(scopes.block_info(self.blocks, self.sources, self.outputs), "info")
        keys = keep_bucketed(scopes.source_keys(self.sources, self.scopes), "keys")
        edges = keep(scopes.scope_edges(info, self.sources))
        values, arrived, cyclic = scopes.scope_values(info, self.sources, edges)
        bases = keep(scopes.block_bases(arrived))
        about = keep(scopes.scope_info(values, edges, self.scopes, info))
        stars = keep(scopes.star_aliases(self.outputs, keys))
        traceable = scopes.traceable_names(info, self.outputs, edges, stars, about, bases)
        return Model(
            texts=self.texts, blocks=self.blocks, info=info, ranges=self.ranges,
            tables=self.tables, sources=self.sources, keys=keys, ctes=self.ctes,
            outputs=self.outputs, refs=self.refs, scopes=about, bases=bases,
            stars=stars, traceable=traceable, all_scopes=self.scopes, cyclic=cyclic,
            edges=edges, scan_text=self.scan_text,
        )

    @cached_property
    @on_shapes
    def predicates(self) -> tuple[DataFrame, DataFrame]:
        found, inside = facts.predicates_of(self.tokens, self.segments)
        return found, keep(condition_mentions(self.model, keep(inside)))

    @cached_property
    @on_shapes
    def resolved(self) -> tuple[DataFrame, DataFrame]:
        columns = ["h", "bpos", "q", "n", "node"]
        more = self.predicates[1].select(*columns).unionByName(self.sort_columns.select(*columns))
        return resolve(self.model, more)

    @cached_property
    @on_shapes
    def sort_columns(self) -> DataFrame:
        return keep(sort_columns(self.model))

    @cached_property
    @on_shapes
    def conditions(self) -> DataFrame:
        """(h, bpos, cat, sch, name, where_condition, cond_no): ``cond_no`` numbers the
        conditions of a text."""
        nodes, results = self.resolved
        found, mentions = self.predicates
        by_place = Window.partitionBy("h").orderBy("bpos", "cat", "sch", "name")
        return keep_bucketed(
            attribute(self.model, found, mentions, nodes, results)
            .withColumn("cond_no", F.row_number().over(by_place)),
            "conditions",
        )

    @cached_property
    @on_shapes
    def clause_texts(self) -> DataFrame:
        """(h, cpos, CLAUSE_SQL): the text of each reported clause."""
        two_words = F.col("clause").isin("GROUP_BY", "ORDER_BY")
        words = F.when(two_words, 2).otherwise(1) + F.col("skip")
        ranges = self.segments.filter(F.col("clause").isin(CLAUSES)).select(
            "h", "bpos", "cpos", "clause", (F.col("cpos") + words).alias("start"), "end"
        )
        word = (
            F.when(F.col("clause") == "PROJECTION", "SELECT")
            .when(F.col("clause") == "JOIN_ON", "ON")
            .otherwise(F.replace("clause", F.lit("_"), F.lit(" ")))
        )
        texts = render(ranges, self.texts, ["bpos", "cpos", "clause"]).select(
            "h", "cpos", F.concat(word, F.lit(" "), "text").alias("CLAUSE_SQL")
        )
        return keep_bucketed(texts, "clauses")

    @cached_property
    @on_shapes
    def rows(self) -> DataFrame:
        """One row per resolved mention of each shape of texts, without the texts of clauses
        and conditions (see ``with_texts``).

        ``row_no`` numbers the rows of a text by ``place``: outer blocks first, clauses in
        report order. ``where_places`` is how often ``where_length`` counts the stand-in.
        """
        nodes, results = self.resolved
        found = mention_rows(self.model, nodes, results, self.sort_columns)
        conditions = self.conditions.select(
            "h", "bpos", "cat", "sch", F.col("name").alias("name_t"), "cond_no",
            F.length("where_condition").alias("where_length"),
            places(F.col("where_condition")).alias("where_places"),
        )
        place = F.struct("level_no", "block_id", clause_number(F.col("clause")).alias("clause_no"),
                         "pos", "path")
        in_place = Window.partitionBy("h").orderBy("place")
        joined = (
            together(found.join(self.blocks.select("h", "bpos", "block_id", "level_no"), ["h", "bpos"]))
            .join(conditions, ["h", "bpos", "cat", "sch", "name_t"], "left")
            .select(
                "h", "block_id", place.alias("place"), "cpos", "cond_no",
                F.coalesce("where_length", F.lit(0)).alias("where_length"),
                F.coalesce("where_places", F.lit(0)).alias("where_places"),
                F.col("cat").alias("CATALOG"),
                F.when(F.col("sch") != "", F.col("sch")).otherwise(F.col("cat")).alias("SCHEMA"),
                F.col("name_t").alias("TABLE"), F.col("col").alias("COLUMN"),
                F.col("reason").alias("REASON"), F.col("clause").alias("CLAUSE"),
                unmark_placeholders(F.col("tok")).alias("raw_sql"),
            )
            .withColumn("row_no", F.row_number().over(in_place))
        )
        return keep_bucketed(joined, "rows")

    def text_rows(self) -> DataFrame:
        """``rows`` of each different text, with its number and ``seq``, its first statement."""
        longer = (F.length("number") - len(STAND_IN)) * F.col("where_places")
        found = self.instances.join(self.rows, "h").withColumn("where_length", F.col("where_length") + longer)
        return with_number(found, ["CATALOG", "SCHEMA", "TABLE", "COLUMN"]).drop("where_places")

    def with_texts(self, rows: DataFrame) -> DataFrame:
        """Rows with (h, cpos, cond_no) and the texts of their clause and condition."""
        conditions = self.conditions.select("h", "cond_no", F.col("where_condition").alias("WHERE_CONDITION"))
        return rows.join(self.clause_texts, ["h", "cpos"]).join(conditions, ["h", "cond_no"], "left").fillna(
            "", ["WHERE_CONDITION"]
        )

    def _keyed_statements(self) -> DataFrame:
        return shaped(self.statements).withColumn("h", text_key(F.col("shape")))

    @cached_property
    @on_shapes
    def hot_shapes(self) -> DataFrame:
        """(h, n_parts, has_number): the shapes whose statements take more than one part."""
        parts = F.ceil(F.col("n_copies") / COPIES_PER_PART).cast("int")
        return keep_sized(self.texts.select("h", parts.alias("n_parts"), "has_number").filter("n_parts > 1"))

    @property
    def hot_texts(self) -> DataFrame:
        """(h, n_parts): those of them that are one text."""
        return self.hot_shapes.filter("NOT has_number").drop("has_number")

    @in_job
    def _per_statement(self, by_text: DataFrame, *columns: str) -> DataFrame:
        """Rows of ``by_text`` for every statement with a text of that shape, with its number.

        The statements of a shape are dealt out to parts and its rows repeated once
        per part, so no task gets all of them; the part is in the join key. Shapes
        of one part are not listed. The rows are written first, so that the planner knows
        their size: where they are few, statements are not exchanged; else they meet the
        statements in a join of two exchanges, which adaptive execution can split.
        """
        hot = self.hot_shapes.drop("has_number")
        with with_settings(self.statements.sparkSession, self.shape_settings):
            rows = keep_sized(by_text)

        def part_key(part):
            return F.when(
                F.col("n_parts").isNotNull(),
                F.concat("h", F.encode(part.cast("string"), "utf-8")),
            ).otherwise(F.col("h"))

        own_part = F.pmod(F.xxhash64("stmt_id"), F.col("n_parts"))
        # statements are not kept as they were given
        found = self._keyed_statements() if "SELECT_STATEMENT" in columns else self.keyed
        keyed = (
            found.join(hot, "h", "left")
            .select(part_key(own_part).alias("part_key"), "stmt_id", "number", *columns)
        )
        repeated = (
            rows.join(hot, "h", "left")
            .withColumn("part", F.explode(
                F.sequence(F.lit(0), F.coalesce(F.col("n_parts"), F.lit(1)) - 1)
            ))
            .withColumn("part_key", part_key(F.col("part")))
            .drop("h", "n_parts", "part")
        )
        return with_number(keyed.join(repeated, "part_key"), text_columns(by_text)).drop("part_key", "number")

    def lineage(self) -> DataFrame:
        """Lineage rows of every statement, copies included."""
        return self._per_statement(self.with_texts(self.rows), "JOB_NAME").select(
            "stmt_id", "JOB_NAME", "block_id", "CATALOG", "SCHEMA", "TABLE", "COLUMN", "REASON",
            "CLAUSE", "CLAUSE_SQL", "WHERE_CONDITION",
        )

    def rejects(self) -> DataFrame:
        """Statements whose text could not be read, with the reason."""
        bad = self.texts.filter("parse_error IS NOT NULL").select("h", "parse_error")
        return self._per_statement(bad, "JOB_NAME", "SELECT_STATEMENT").select(
            "stmt_id", "JOB_NAME", "SELECT_STATEMENT", "parse_error"
        )

    def unresolved(self) -> DataFrame:
        """Mentions without schema and table, with job and reason."""
        rows = self.rows.filter("SCHEMA = '' AND TABLE = ''").filter(
            ~F.upper("COLUMN").startswith("V_")
        ).select("h", "COLUMN", "REASON")
        return self._per_statement(rows, "JOB_NAME", "SELECT_STATEMENT").select(
            "stmt_id", "JOB_NAME", "COLUMN", "REASON", "SELECT_STATEMENT"
        )

    @in_job
    def trace_outputs(self, targets: DataFrame) -> DataFrame:
        """Physical columns behind named outputs: targets (stmt_id, block_id,
        target) give rows (stmt_id, block_id, target, CATALOG, ...). Stars are
        followed for names that no output spells out."""
        keyed = self.keyed.select("stmt_id", "h", "number", "number_at").join(targets, "stmt_id")
        asked = keyed.join(self.blocks.select("h", "bpos", "block_id"), ["h", "block_id"]).withColumn(
            "n", F.lower("target")
        ).withColumn("n", as_shape("n")).drop("number_at")
        found = self._traced(keep_sized(asked.select("h", "bpos", "n").distinct()))
        return with_number(asked.join(found, ["h", "bpos", "n"]), ["cat", "sch", "name_t", "col"]).select(
            "stmt_id", "block_id", "target", F.col("cat").alias("CATALOG"),
            F.col("sch").alias("SCHEMA"), F.col("name_t").alias("TABLE"),
            F.col("col").alias("COLUMN"), F.col("reason").alias("REASON"),
        )

    @on_shapes
    def _traced(self, wanted: DataFrame) -> DataFrame:
        """(h, bpos, n, cat, sch, name_t, col, reason) behind the outputs ``n`` of shapes."""
        m = self.model
        feeds, ends = expand_outputs(wanted, m, keep(scope_names(m)))
        up = lambda c: F.upper(unmark_placeholders(F.col(c)))
        ends_at = self.resolved[1].withColumnRenamed("path", "end_path")
        # what a star finds in several blocks counts once, what feeds one output does not
        way = lambda own, value: F.when(F.col("folds"), F.lit(0).cast("long")).otherwise(value).alias(own)
        named = feeds.join(ends_at, ["h", "node"]).select(
            "h", "bpos", "n", way("feed", F.xxhash64("path")), way("rid", F.col("rid")),
            "cat", "sch", "name_t", "col", "reason", F.concat("path", "end_path").alias("path"),
        )
        none = F.lit(0).cast("long")
        starred = ends.select(
            "h", "bpos", "n", none.alias("feed"), none.alias("rid"),
            up("table.cat").alias("cat"), up("table.sch").alias("sch"),
            up("table.name").alias("name_t"), F.upper("n").alias("col"), "reason",
            F.array().cast("array<int>").alias("path"),
        )
        # of equal columns the one reached first in the text gives the reason
        first = F.min(F.struct("path", "reason"))
        found = named.unionByName(starred).groupBy(
            "h", "bpos", "n", "feed", "rid", "cat", "sch", "name_t", "col"
        ).agg(first.alias("first")).withColumn("reason", F.col("first.reason"))
        return keep_sized(found.drop("first", "feed", "rid"))

    def named_outputs(self) -> DataFrame:
        """(stmt_id, block_id, target): every named output of every block, each name once."""
        named = self.outputs.filter("out_name IS NOT NULL").join(
            self.blocks.select("h", "bpos", "block_id"), ["h", "bpos"]
        )
        return self._per_statement(
            named.groupBy("h", "block_id", F.lower("out_name").alias("target")).agg(F.lit(1).alias("one")).drop("one")
        )

    # --- stage records -------------------------------------------------

    def query_blocks(self) -> DataFrame:
        texts = render(
            self.blocks.select("h", "bpos", F.col("head").alias("start"), F.col("tail").alias("end")),
            self.texts, ["bpos"],
        )
        parents = self.blocks.select(
            "h", F.col("bpos").alias("parent_bpos"), F.col("block_id").alias("parent_id")
        )
        found = (
            self.blocks.join(parents, ["h", "parent_bpos"], "left")
            .join(texts, ["h", "bpos"])
            .select("h", "block_id", "parent_id", "block_type", "alias_name", "level_no",
                    F.col("block_id").alias("ordinal_position"), "is_root",
                    F.col("text").alias("raw_sql"))
        )
        return self._per_statement(found)

    def catalog_tables(self) -> DataFrame:
        return self._per_statement(lists.catalog_tables(self))

    def catalog_columns(self) -> DataFrame:
        found = self.with_texts(self.rows).select(
            "h", "block_id", F.col("CATALOG").alias("catalog_name"),
            F.col("SCHEMA").alias("schema_name"), F.col("TABLE").alias("table_name"),
            F.col("COLUMN").alias("column_name"), F.col("REASON").alias("reason"),
            F.col("CLAUSE").alias("clause_type"), F.col("CLAUSE_SQL").alias("clause_sql"), "raw_sql",
        )
        return self._per_statement(found)

    def column_list(self) -> DataFrame:
        return self._per_statement(lists.column_list(self))

    def table_list(self) -> DataFrame:
        return self._per_statement(lists.table_list(self))

    def where_list(self) -> DataFrame:
        return self._per_statement(lists.where_list(self))

    def schema_list(self) -> DataFrame:
        return self._per_statement(lists.schema_list(self))

    @cached_property
    @in_job
    def table_conditions(self) -> DataFrame:
        """(table_id, nth, predicate): the conditions that touch each table, in order. The
        long form of what the report shows in one cell."""
        rows = report.with_some_key(report.report_rows(self.text_rows())).filter("cond_no IS NOT NULL")
        conditions = self.conditions.select("h", "cond_no", strip(F.col("where_condition")).alias("where_text"))
        # each condition is split once for all texts of a shape
        cut = report.cut_texts(conditions.withColumn("text_id", F.struct("h", "cond_no")), "where_text")
        pieces = keep_sized(cut.select("text_id.*", "chunk_no", "pred_no", "predicate", "key"))
        texts = with_number(self.instances.join(conditions, "h"), ["where_text"]).select(
            "h", "number", "cond_no", report.text_id("where_text").alias("text_id")
        )
        uses = rows.join(texts, ["h", "number", "cond_no"]).groupBy(
            report.table_id().alias("table_id"), "text_id"
        ).agg(F.min(F.struct("COLUMN", "seq", "row_no")).alias("first"))
        found = with_number(
            texts.dropDuplicates(["text_id"]).join(pieces, ["h", "cond_no"]), ["predicate", "key"]
        ).select("text_id", "chunk_no", "pred_no", "predicate", report.text_id("key").alias("pred_id"))
        return keep(report.conditions_by_table(uses, keep(found)))

    @in_job
    def report(self) -> DataFrame:
        """The final table, sorted; see ``operators.report``.

        The best row of a column is chosen on numbers alone; texts are fetched for the
        chosen rows, from tables that are bucketed on the text key.
        """
        rows = report.with_some_key(report.report_rows(self.text_rows()))
        best = report.best_places(rows).join(self.instances, "seq").drop("seq")
        chosen = best.join(self.rows.select("h", "row_no", "cpos", "cond_no", "CLAUSE"), ["h", "row_no"])
        shown = with_number(self.with_texts(chosen), ["CLAUSE_SQL", "WHERE_CONDITION"]).withColumn(
            "CLAUSE", report.shown_clause()
        )
        return report.in_order(report.merge_back(shown, report.cells(self.table_conditions)))


def build_report(statements: DataFrame) -> DataFrame:
    return Lineage(statements).report()
