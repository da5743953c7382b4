"""Validated docs, queries and qrels of four collection layouts, with an issue for every rejected row.

Inputs are tables of numbered lines or decoded records with an ordering column or columns; `order` says which row of an id
counts as the first."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import computed
from ..functions.text import strip
from ..operators.rules import Rule, duplicate_judgments, duplicates, good, issue_rows, judged, with_reference
from ..sources import json_records as js
from ..sources import lines as ln
from ..sources import paragraphs as pp

LINE_ORDER = ("file", "line_num")


def _order(cols: tuple[str, ...]) -> tuple[Column, bool]:
    """The order as a value, and whether it tells the rows of a key apart, as file and line number do."""
    return F.struct(*cols), cols[:2] in (LINE_ORDER, pp.ORDER)


def unrepeated(rows: DataFrame, key: str, order: tuple[str, ...], issue_type: str) -> DataFrame:
    by, unique = _order(order)
    return duplicates(rows, key, by, issue_type, unique)


def unrepeated_judgments(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    by, unique = _order(order)
    return duplicate_judgments(rows, by, unique)


def pair_id() -> Column:
    return F.concat_ws("::", "query_id", "doc_id")


@dataclass(frozen=True)
class Checked:
    """A validated table: rows, with `issue` null where they are accepted."""

    rows: DataFrame
    columns: tuple[str, ...]
    record_type: str
    split: str | None = None

    @property
    def accepted(self) -> DataFrame:
        return good(self.rows).select(*self.columns)

    @property
    def issues(self) -> DataFrame:
        return issue_rows(self.rows, self.record_type, self.split)

    def counts(self) -> DataFrame:
        """(table, split, written, skipped), in one pass."""
        return self.rows.agg(F.count_if(F.col("issue").isNull()).alias("written"), F.count_if(F.col("issue").isNotNull()).alias("skipped")).select(
            F.lit(self.record_type).alias("table"), F.lit(self.split).cast("string").alias("split"), "written", "skipped"
        )


# Tab-separated collections


def tsv_docs(lines: DataFrame, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    return _tsv_pairs(lines, "doc", "doc_id", "doc_text", None, order)


def tsv_queries(lines: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    return _tsv_pairs(lines, "query", "query_id", "query_text", split, order)


def _tsv_pairs(lines: DataFrame, record: str, key: str, text: str, split: str | None, order: tuple[str, ...]) -> Checked:
    cell = lambda i: strip(F.get("cells", F.lit(i)))
    rows = ln.tsv_pair(lines).withColumn(key, F.coalesce(cell(0), F.lit(""))).withColumn(text, F.coalesce(cell(1), F.lit("")))
    rules = [
        Rule(f"invalid_{record}_row_format", F.size("cells") != 2, detail=F.left(strip("line"), F.lit(300))),
        Rule(f"missing_{record}_id", F.col(key) == ""),
        Rule(f"empty_{text}", F.col(text) == "", F.col(key)),
    ]
    return Checked(unrepeated(judged(rows, rules), key, order, f"duplicate_{key}"), (key, text), record, split)


def relevance(c: Column) -> Column:
    """An integer of up to 64 bits as Python reads it: optional sign, digits, single underscores between them; null otherwise."""
    return F.when(c.rlike(r"^[+-]?[0-9]+(_[0-9]+)*\z"), F.replace(c, F.lit("_"), F.lit("")).try_cast("bigint"))


def tsv_qrels(lines: DataFrame, queries: DataFrame, docs: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    cell = lambda i: F.coalesce(strip(F.get("cells", F.lit(i))), F.lit(""))
    rows = ln.tsv_cells(lines).withColumns({"query_id": cell(0), "doc_id": cell(2), "raw": cell(3)}).withColumn("relevance", relevance(F.col("raw")))
    rules = [
        Rule("invalid_qrel_row_format", F.size("cells") != 4, detail=F.left(strip("line"), F.lit(300))),
        Rule("missing_qrel_query_id", F.col("query_id") == ""),
        Rule("missing_qrel_doc_id", F.col("doc_id") == "", F.col("query_id")),
        Rule("invalid_relevance", F.col("relevance").isNull(), pair_id(), F.col("raw")),
    ]
    return referenced(judged(rows, rules), queries, docs, split, order, pair_id())


def referenced(rows: DataFrame, queries: DataFrame, docs: DataFrame, split: str | None, order: tuple[str, ...], query_record: Column) -> Checked:
    """Judgments with their references checked, then their duplicates."""
    rows = with_reference(rows, "query_id", queries.select("query_id"), "missing_query_ref", query_record)
    rows = with_reference(rows, "doc_id", docs.select("doc_id"), "missing_doc_ref", pair_id())
    return Checked(unrepeated_judgments(rows, order), ("query_id", "doc_id", "relevance"), "qrel", split)


# JSON-lines collections: docs with sentence lists, queries with evidence


def _fields(lines: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """The lines with their kind and the fields of their value, without the value."""
    read = js.json_lines(lines)
    return computed(read, "f", F.struct(*[c.alias(n) for n, c in fields.items()])).select(*[c for c in read.columns if c != "v"], "f.*")


def _json_rules(record: str) -> list[Rule]:
    return [
        Rule(f"invalid_{record}_json", F.col("kind").isNull()),
        Rule(f"invalid_{record}_record_format", F.col("kind") != "dict", detail=F.concat(F.lit("type="), F.col("kind"))),
    ]


def sentences_of(v: Column) -> Column:
    """The texts of a VARIANT array's elements, trimmed, without blank ones."""
    return F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), js.as_text), lambda x: x != "")


def json_docs(lines: DataFrame, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    v = F.col("v")
    abstract = js.member(v, "abstract")
    rows = _fields(lines, {"doc_id": js.as_text(js.member(v, "doc_id")), "title": js.as_text(js.member(v, "title")), "abstract_kind": js.python_type(abstract), "doc_text": sentences_of(abstract)})
    rules = [
        *_json_rules("doc"),
        Rule("missing_doc_id", F.col("doc_id") == ""),
        Rule("invalid_abstract_format", F.col("abstract_kind") != "list", F.col("doc_id"), F.concat(F.lit("type="), F.col("abstract_kind"))),
        Rule("empty_doc_text", F.size("doc_text") == 0, F.col("doc_id")),
    ]
    return Checked(unrepeated(judged(rows, rules), "doc_id", order, "duplicate_doc_id"), ("doc_id", "title", "doc_text"), "doc")


def json_queries(lines: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    v = F.col("v")
    rows = _fields(lines, {"query_id": js.as_text(js.member(v, "id")), "query_text": js.as_text(js.member(v, "claim"))})
    rules = [*_json_rules("query"), Rule("missing_query_id", F.col("query_id") == ""), Rule("empty_query_text", F.col("query_text") == "", F.col("query_id"))]
    return Checked(unrepeated(judged(rows, rules), "query_id", order, "duplicate_query_id"), ("query_id", "query_text"), "query", split)


def evidence_qrels(lines: DataFrame, queries: DataFrame, docs: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER) -> tuple[Checked, DataFrame]:
    """(judgments, issues of whole lines): each key of a line's evidence object is a doc of relevance 1."""
    v = F.col("v")
    evidence = js.member(v, "evidence")
    rows = _fields(lines, {"query_id": js.as_text(js.member(v, "id")), "evidence_kind": js.python_type(evidence), "doc_ids": F.map_keys(F.try_variant_get(evidence, "$", "map<string,variant>"))})
    rows = judged(rows, [*_json_rules("qrel"), Rule("missing_qrel_query_id", F.col("query_id") == "")])
    rows = with_reference(rows, "query_id", queries.select("query_id"), "missing_query_ref", F.col("query_id"))
    rows = judged(rows, [Rule("invalid_evidence_format", F.col("evidence_kind") != "dict", F.col("query_id"), F.concat(F.lit("type="), F.col("evidence_kind")))])
    keys = F.transform("doc_ids", strip)
    each = rows.where(F.col("issue").isNull()).select(*order, "query_id", F.explode(F.concat(F.array_distinct(F.filter(keys, lambda k: k != "")), F.filter(keys, lambda k: k == ""))).alias("doc_id"))
    each = judged(each.withColumn("relevance", F.lit(1).cast("long")), [Rule("missing_evidence_doc_id", F.col("doc_id") == "", F.col("query_id"))])
    each = with_reference(each, "doc_id", docs.select("doc_id"), "missing_doc_ref", pair_id())
    checked = Checked(unrepeated_judgments(each, order), ("query_id", "doc_id", "relevance"), "qrel", split)
    return checked, issue_rows(rows, "qrel", split)


# Nested samples: a question with its context passages and the supporting ones


@dataclass(frozen=True)
class MultiHop:
    queries: Checked
    docs: Checked
    qrels: Checked
    notes: DataFrame  # issues that skip nothing: a context or a list of facts of the wrong type


def multi_hop(samples: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> MultiHop:
    """samples: (order columns, v VARIANT). keep may store the accepted samples, from which docs, facts and notes all start."""
    js.enable(samples.sparkSession)
    v = F.col("v")
    kind = js.python_type(v)
    parts = {"context": js.member(v, "context"), "facts": js.member(v, "supporting_facts")}
    fields = {"kind": kind, "query_id": js.as_text(js.member(v, "_id")), "query_text": js.as_text(js.member(v, "question")), **{f"{n}_kind": js.python_type(p) for n, p in parts.items()}}
    fields |= {n: F.try_variant_get(p, "$", "array<variant>") for n, p in parts.items()}
    rows = computed(samples, "f", F.struct(*[c.alias(n) for n, c in fields.items()])).select(*order, "f.*")
    rules = [
        Rule("invalid_sample_format", F.col("kind") != "dict", detail=F.concat(F.lit("type="), F.col("kind"))),
        Rule("missing_query_id", F.col("query_id") == ""),
        Rule("empty_query_text", F.col("query_text") == "", F.col("query_id")),
    ]
    queries = Checked(unrepeated(judged(rows, rules), "query_id", order, "duplicate_query_id"), ("query_id", "query_text"), "query", split)
    kept = keep(queries.rows.where(F.col("issue").isNull()).drop("issue"))
    wrong = lambda part, name, record: issue_rows(judged(kept, [Rule(name, F.col(f"{part}_kind") != "list", F.col("query_id"), F.concat(F.lit("type="), F.col(f"{part}_kind")))]), record, split)
    notes = wrong("context", "invalid_context_format", "doc").unionByName(wrong("facts", "invalid_supporting_facts_format", "qrel"))

    def entries(part: str) -> DataFrame:
        each = kept.select(*order, "query_id", F.posexplode(part).alias("at", "entry"))
        pair = F.try_variant_get("entry", "$", "array<variant>")
        is_pair = F.coalesce(js.python_type(F.col("entry")) == "list", F.lit(False)) & (F.size(pair) == 2)
        title, second = js.as_text(F.get(pair, F.lit(0))), F.get(pair, F.lit(1))
        fields = F.struct(is_pair.alias("pair"), title.alias("title"), js.python_type(second).alias("second_kind"), sentences_of(second).alias("doc_text"))
        return computed(each.withColumn("at", F.col("at") + 1), "f", fields).select(*order, "query_id", "at", "f.*")

    own = F.concat_ws("::", "query_id", "title")
    context = entries("context").withColumn("doc_id", own)
    nth = F.concat(F.lit("context_idx="), F.col("at").cast("string"))
    rules = [
        Rule("invalid_context_entry_format", ~F.col("pair"), F.col("query_id"), nth),
        Rule("missing_doc_title", F.col("title") == "", F.col("query_id"), nth),
        Rule("invalid_context_sentences_format", F.col("second_kind") != "list", own, F.concat(F.lit("type="), F.col("second_kind"))),
        Rule("empty_doc_sentences", F.size("doc_text") == 0, own),
    ]
    docs = Checked(unrepeated(judged(context, rules), "doc_id", (*order, "at"), "duplicate_doc_id"), ("doc_id", "title", "doc_text"), "doc", split)
    nth = F.concat(F.lit("fact_idx="), F.col("at").cast("string"))
    facts = judged(
        entries("facts").drop("second_kind", "doc_text").withColumns({"doc_id": own, "relevance": F.lit(1).cast("long")}),
        [Rule("invalid_supporting_fact_entry_format", ~F.col("pair"), F.col("query_id"), nth), Rule("missing_supporting_fact_title", F.col("title") == "", F.col("query_id"), nth)],
    )
    columns = ["query_id", "doc_id", "relevance", "issue"]
    titles = facts.where(F.col("issue").isNull()).select(*columns).dropDuplicates(["query_id", "doc_id"])
    titles = with_reference(titles, "doc_id", docs.accepted.select("doc_id"), "missing_supporting_doc_in_context", F.col("doc_id"))
    qrels = Checked(titles.unionByName(facts.where(F.col("issue").isNotNull()).select(*columns)), ("query_id", "doc_id", "relevance"), "qrel", split)
    return MultiHop(queries, docs, qrels, notes)


def multi_hop_stats(builds: dict[str, MultiHop]) -> DataFrame:
    """(split, eight counts) of each split and, with split null, of all: a rollup."""
    tables = []
    for split, b in builds.items():
        for name, part in (("query", b.queries), ("doc", b.docs), ("qrels", b.qrels)):
            tables.append(part.rows.select(F.lit(split).alias("split"), F.lit(name).alias("part"), F.col("issue").isNull().alias("ok"), (F.col("query_id") if name == "qrels" else F.lit(None).cast("string")).alias("q")))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    n = lambda part, ok, name: F.count_if((F.col("part") == part) & (F.col("ok") == ok)).alias(name)
    positives = F.count_distinct(F.when((F.col("part") == "qrels") & F.col("ok"), F.struct("split", "q")))
    counts = every.rollup("split").agg(
        n("doc", True, "doc_count"), n("query", True, "query_count"), n("qrels", True, "qrels_count"), positives.alias("positive_query_count"),
        n("doc", False, "skipped_doc_count"), n("query", False, "skipped_query_count"), n("qrels", False, "skipped_qrels_count"),
    )
    return counts.withColumn("orphan_query_count", F.col("query_count") - F.col("positive_query_count"))


# Decoded paragraphs and outlines


def paragraph_docs(rows: DataFrame, order: tuple[str, ...]) -> Checked:
    rows = rows.withColumns({"doc_id": pp.paragraph_id(), "doc_text": pp.paragraph_text()})
    rules = [Rule("missing_doc_id", F.col("doc_id") == ""), Rule("empty_doc_text", F.col("doc_text") == "", F.col("doc_id"))]
    return Checked(unrepeated(judged(rows, rules), "doc_id", order, "duplicate_doc_id"), ("doc_id", "doc_text"), "doc")


def outline_queries(rows: DataFrame, split: str, order: tuple[str, ...]) -> Checked:
    rows = rows.withColumns({"query_id": F.coalesce(strip("page_id"), F.lit("")), "query_text": F.coalesce(strip("page_name"), F.lit(""))})
    rules = [Rule("missing_query_id", F.col("query_id") == ""), Rule("empty_query_text", F.col("query_text") == "", F.col("query_id"))]
    return Checked(unrepeated(judged(rows, rules), "query_id", order, "duplicate_query_id"), ("query_id", "query_text"), "query", split)


def spaced_qrels(lines: DataFrame, queries: DataFrame, docs: DataFrame, split: str, order: tuple[str, ...] = LINE_ORDER) -> Checked:
    """Four fields between white space; the fourth is ignored, every judgment has relevance 1."""
    cell = lambda i: F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
    rows = ln.blank_separated(lines).withColumns({"query_id": cell(0), "doc_id": cell(2), "relevance": F.lit(1).cast("long")})
    rules = [Rule("invalid_qrel_row_format", F.size("cells") != 4, detail=F.left(strip("line"), F.lit(300)))]
    return referenced(judged(rows, rules), queries, docs, split, order, pair_id())


# Over several tables


def orphans(queries: DataFrame, qrels: DataFrame, positive_only: bool = False) -> DataFrame:
    """(query_id) of the queries without an accepted judgment (of positive relevance)."""
    judged_ = qrels.where("relevance > 0") if positive_only else qrels
    return queries.select("query_id").join(judged_.select("query_id"), "query_id", "left_anti")


def build_stats(docs: Checked, splits: dict[str, tuple[Checked, Checked]]) -> DataFrame:
    """(part, metric, value): the counts of docs and, per split, of queries and judgments."""
    long = lambda df, part: df.select(F.lit(part).alias("part"), F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in df.columns])))
    out = long(docs.counts().select(F.col("written").alias("doc_count"), F.col("skipped").alias("skipped_count")), "docs")
    for split, (queries, qrels) in splits.items():
        out = out.unionByName(long(queries.counts().select(F.col("written").alias("query_count"), F.col("skipped").alias("skipped_query_count")), split))
        out = out.unionByName(long(qrels.counts().select(F.col("written").alias("qrels_count"), F.col("skipped").alias("skipped_qrels_count")), split))
        out = out.unionByName(long(qrels.accepted.agg(F.count_distinct("query_id").alias("positive_query_count")), split))
        out = out.unionByName(long(orphans(queries.accepted, qrels.accepted).agg(F.count(F.lit(1)).alias("orphan_query_count")), split))
    return out


def error_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue_type").agg(F.count(F.lit(1)).alias("count"))
