"""Queries over the operators of the core, with the SQL that says the same.

The tables stand in for raw deliveries: lines and records are derived from their columns, the same way in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .functions import vectors as vx
from .functions.binding import computed
from .operators import chunking, encoders
from .operators.rules import ISSUE, duplicates, good
from .plans import collections as co
from .plans import embedding as em
from .queries import SQL_WHITE, query, table
from .runtime import scratch_folder
from .sinks import tables as sinks
from .sources import json_records as js
from .sources import paragraphs as pp
from .streaming import ingest

WS = f"w AS (SELECT {SQL_WHITE} AS ws)"


def txt(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


# Text functions


@query(f"WITH {WS} SELECT query_id, trim(coalesce(query_text, ''), ws) AS normal FROM queries, w")
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "queries").select("query_id", F.coalesce(tx.strip("query_text"), F.lit("")).alias("normal"))


SQL_CLEAN = "list_filter(list_transform(coalesce(doc_text, []), lambda x: trim(x, ws)), lambda x: x IS NOT NULL AND x <> '')"


@query(f"WITH {WS} SELECT doc_id, len(kept) AS items, array_to_string(kept, '|') AS joined FROM (SELECT doc_id, {SQL_CLEAN} AS kept FROM docs, w)")
def clean_array(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "docs").select("doc_id", tx.clean_items("doc_text").alias("k")).select("doc_id", F.size("k").cast("long").alias("items"), F.array_join("k", "|").alias("joined"))


@query("SELECT doc_id, CASE WHEN len(text) = 0 OR text IS NULL THEN 1 ELSE greatest(1, cjk + (length(text) - cjk) // 4) END::INT AS tokens FROM (SELECT doc_id, text, length(regexp_replace(text, '[^一-鿿]', '', 'g')) AS cjk FROM documents)")
def estimate_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", tx.estimate_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))


SQL_PARAGRAPHS = f"""
{WS}, p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\n{{2,}}'), lambda x: trim(x, ws)), lambda x: x <> '') AS ps FROM documents, w WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM p),
g AS (SELECT *, sum(CASE WHEN i > 1 AND regexp_matches(p, '^(?:[-*•]|(?:\\(?\\d+\\)?|[A-Z]|[IVXivx]+)[\\.\\):])\\s+') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM u)
"""


@query(f"WITH {SQL_PARAGRAPHS} SELECT doc_id, b::INT AS position, string_agg(p, ' ' ORDER BY i) AS block FROM g GROUP BY doc_id, b")
def paragraph_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = table(spark, folder, "documents").where("text is not null").select("doc_id", F.posexplode(tx.paragraph_blocks("text")).alias("p", "block"))
    return blocks.select("doc_id", (F.col("p") + 1).alias("position"), "block")


@query(f"WITH {SQL_PARAGRAPHS} SELECT doc_id, count(*) AS paragraphs, max(b)::BIGINT AS blocks FROM g GROUP BY doc_id")
def list_item_merge(spark: SparkSession, folder: str) -> DataFrame:
    counted = table(spark, folder, "documents").where("text is not null").select("doc_id", F.size(tx.paragraphs("text")).cast("long").alias("paragraphs"), F.size(tx.paragraph_blocks("text")).cast("long").alias("blocks"))
    return counted.where("paragraphs > 0")


@query(f"""WITH {WS}, s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(30), 'g'), '([。！？])\\s*', '\\1' || chr(30), 'g'), chr(30)), lambda x: trim(x, ws)), lambda x: x <> '') AS ss FROM documents, w WHERE text IS NOT NULL)
SELECT doc_id, (generate_subscripts(ss, 1))::INT AS position, unnest(ss) AS sentence FROM s""")
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "documents").where("text is not null").select("doc_id", F.posexplode(tx.sentences("text")).alias("p", "sentence"))
    return parts.select("doc_id", (F.col("p") + 1).alias("position"), "sentence")


@query("""SELECT query_id, 'Find passages about: ask ' || query_text AS templated, 'ask ' || query_text || ' ?' AS filled FROM queries WHERE query_text IS NOT NULL""")
def prepare_texts(spark: SparkSession, folder: str) -> DataFrame:
    q = F.col("query_text")
    return table(spark, folder, "queries").where(q.isNotNull()).select("query_id", tx.prepared(q, "ask ", "Find passages about: ").alias("templated"), tx.prepared(q, "ask ", "{text} ?").alias("filled"))


@query("""SELECT doc_id || '#c' || lpad((c."order")::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') AS chunk_id FROM (SELECT doc_id, len(candidates) AS n, unnest(candidates) AS c FROM doc_candidates)""")
def chunk_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "doc_candidates").select("doc_id", F.size("candidates").alias("n"), F.explode("candidates").alias("c"))
    return rows.select(tx.chunk_id(F.col("doc_id"), F.col("c.order"), F.col("n")).alias("chunk_id"))


# Raw lines to tables


def corpus(spark: SparkSession, folder: str, layout: str) -> DataFrame:
    return table(spark, folder, "corpus_lines").where(F.col("layout") == layout).select("file", "line_num", "line")


SQL_TSV = f"""{WS},
l AS (SELECT file, line_num, rtrim(line, chr(10)) AS line, ws FROM corpus_lines, w WHERE layout = 'tsv' AND trim(coalesce(line, ''), ws) <> ''),
c AS (SELECT *, strpos(line, chr(9)) AS t FROM l),
d AS (SELECT file, line_num, t, CASE WHEN t = 0 THEN trim(line, ws) ELSE trim(substr(line, 1, t - 1), ws) END AS doc_id, CASE WHEN t = 0 THEN '' ELSE trim(substr(line, t + 1), ws) END AS doc_text FROM c),
j AS (SELECT *, CASE WHEN t = 0 THEN 'invalid_doc_row_format' WHEN doc_id = '' THEN 'missing_doc_id' WHEN doc_text = '' THEN 'empty_doc_text' END AS e FROM d),
k AS (SELECT *, CASE WHEN e IS NULL AND row_number() OVER (PARTITION BY doc_id, e IS NULL ORDER BY file, line_num) > 1 THEN 'duplicate_doc_id' ELSE e END AS issue FROM j)
"""


@query(f"WITH {SQL_TSV} SELECT doc_id, doc_text FROM k WHERE issue IS NULL")
def tsv_docs_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    return co.tsv_docs(corpus(spark, folder, "tsv")).accepted


@query(f"WITH {SQL_TSV} SELECT file, line_num, issue AS issue_type, CASE WHEN issue IN ('empty_doc_text', 'duplicate_doc_id') THEN doc_id END AS record_id FROM k WHERE issue IS NOT NULL")
def issue_log(spark: SparkSession, folder: str) -> DataFrame:
    return co.tsv_docs(corpus(spark, folder, "tsv")).issues.select("file", "line_num", "issue_type", "record_id")


@query(f"""WITH {SQL_TSV} SELECT '{{"line_num":' || line_num || ',"issue_type":"' || issue || '"' || CASE WHEN issue IN ('empty_doc_text', 'duplicate_doc_id') THEN ',"record_id":' || to_json(doc_id)::VARCHAR ELSE '' END || '}}' AS record FROM k WHERE issue IS NOT NULL""")
def optional_fields(spark: SparkSession, folder: str) -> DataFrame:
    return co.tsv_docs(corpus(spark, folder, "tsv")).issues.select(F.to_json(F.struct("line_num", "issue_type", "record_id")).alias("record"))


SQL_JSON = f"""{WS},
r AS (SELECT file, line_num, ws, CASE WHEN json_valid(line) AND NOT regexp_matches(regexp_replace(line, '"(?:[^"\\\\]|\\\\.)*"', '""', 'g'), ',\\s*[}}\\]]') THEN line::JSON END AS j
  FROM corpus_lines, w WHERE layout = 'jsonl' AND trim(coalesce(line, ''), ws) <> ''),
f AS (SELECT *, json_type(j) AS kind, CASE WHEN json_type(j, '$.doc_id') = 'BOOLEAN' THEN CASE WHEN (j->>'$.doc_id')::BOOLEAN THEN 'True' ELSE 'False' END ELSE coalesce(trim(j->>'$.doc_id', ws), '') END AS doc_id, coalesce(trim(j->>'$.title', ws), '') AS title, json_type(j, '$.abstract') AS akind,
  list_filter(list_transform(json_extract_string(j, '$.abstract[*]'), lambda x: trim(x, ws)), lambda x: x IS NOT NULL AND x <> '') AS doc_text FROM r),
e AS (SELECT *, CASE WHEN j IS NULL THEN 'invalid_doc_json' WHEN kind <> 'OBJECT' THEN 'invalid_doc_record_format' WHEN doc_id = '' THEN 'missing_doc_id'
  WHEN akind IS NULL OR akind <> 'ARRAY' THEN 'invalid_abstract_format' WHEN len(doc_text) = 0 THEN 'empty_doc_text' END AS e FROM f),
k AS (SELECT *, CASE WHEN e IS NULL AND row_number() OVER (PARTITION BY doc_id, e IS NULL ORDER BY file, line_num) > 1 THEN 'duplicate_doc_id' ELSE e END AS issue FROM e)
"""


@query(f"WITH {SQL_JSON} SELECT doc_id, title, array_to_string(doc_text, '|') AS doc_text FROM k WHERE issue IS NULL")
def jsonl_docs_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    return co.json_docs(corpus(spark, folder, "jsonl")).accepted.withColumn("doc_text", F.array_join("doc_text", "|"))


@query(f"WITH {SQL_JSON} SELECT issue AS issue_type, count(*) AS \"count\" FROM k WHERE issue IS NOT NULL GROUP BY 1")
def error_summary(spark: SparkSession, folder: str) -> DataFrame:
    return co.error_summary(co.json_docs(corpus(spark, folder, "jsonl")).issues)


@query(f"WITH {SQL_JSON} SELECT coalesce(CASE kind WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str' WHEN 'NULL' THEN 'NoneType' WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'float' ELSE CASE WHEN kind IS NOT NULL THEN 'int' END END, 'malformed') AS kind, count(*) AS n FROM f GROUP BY 1")
def jsonl_shape_filter(spark: SparkSession, folder: str) -> DataFrame:
    return js.json_lines(corpus(spark, folder, "jsonl")).groupBy(F.coalesce("kind", F.lit("malformed")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def query_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line a delivery of a query; without its tab where lang is null."""
    q = table(spark, folder, "queries")
    return q.select("loaded_at", F.concat(txt("query_id"), F.when(F.col("lang").isNull(), " ").otherwise("\t"), txt("query_text")).alias("line"))


SQL_QUERIES = f"""
ql AS (SELECT loaded_at, coalesce(query_id, '') || CASE WHEN lang IS NULL THEN ' ' ELSE chr(9) END || coalesce(query_text, '') AS line FROM queries),
qc AS (SELECT loaded_at, rtrim(line, chr(10)) AS line, strpos(rtrim(line, chr(10)), chr(9)) AS t, ws FROM ql, w WHERE trim(line, ws) <> ''),
qd AS (SELECT loaded_at, line, t, CASE WHEN t = 0 THEN trim(line, ws) ELSE trim(substr(line, 1, t - 1), ws) END AS query_id, CASE WHEN t = 0 THEN '' ELSE trim(substr(line, t + 1), ws) END AS query_text FROM qc),
qj AS (SELECT *, CASE WHEN t = 0 THEN 'invalid_query_row_format' WHEN query_id = '' THEN 'missing_query_id' WHEN query_text = '' THEN 'empty_query_text' END AS e FROM qd),
qk AS (SELECT *, CASE WHEN e IS NULL AND row_number() OVER (PARTITION BY query_id, e IS NULL ORDER BY loaded_at, line) > 1 THEN 'duplicate_query_id' ELSE e END AS issue FROM qj)
"""
ORDER = ("loaded_at", "line")


@query(f"WITH {WS}, {SQL_QUERIES} SELECT query_id, query_text FROM qk WHERE issue IS NULL")
def tsv_queries_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    return co.tsv_queries(query_lines(spark, folder), "train", ORDER).accepted


@query(f"WITH {WS}, {SQL_QUERIES} SELECT issue AS issue_type, count(*) AS \"count\" FROM qk WHERE issue IS NOT NULL GROUP BY 1")
def tsv_queries_issues(spark: SparkSession, folder: str) -> DataFrame:
    return co.error_summary(co.tsv_queries(query_lines(spark, folder), "train", ORDER).issues)


def doc_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The docs that have a text."""
    return table(spark, folder, "docs").where(F.size(tx.clean_items("doc_text")) > 0).select("doc_id")


def judgment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A line a judgment; three cells where split is null, x for a null relevance. Relevances go beyond 32 bits."""
    cells = ["query_id", F.lit("0"), "doc_id"]
    first = F.concat_ws("\t", *[txt(c) if isinstance(c, str) else c for c in cells])
    last = F.concat(F.lit("\t"), F.coalesce((F.col("relevance").cast("long") * 1_500_000_000).cast("string"), F.lit("x")))
    q = table(spark, folder, "qrels")
    return q.select("judged_at", "loaded_at", F.concat(first, F.when(F.col("split").isNull(), "").otherwise(last)).alias("line"))


SQL_QRELS = f"""{WS}, {SQL_QUERIES},
okq AS (SELECT DISTINCT query_id FROM qk WHERE issue IS NULL),
okd AS (SELECT DISTINCT doc_id FROM docs, w WHERE len({SQL_CLEAN}) > 0),
rl AS (SELECT judged_at, loaded_at, coalesce(query_id, '') || chr(9) || '0' || chr(9) || coalesce(doc_id, '') || CASE WHEN split IS NULL THEN '' ELSE chr(9) || coalesce((relevance::BIGINT * 1500000000)::VARCHAR, 'x') END AS line FROM qrels),
rc AS (SELECT judged_at, loaded_at, line, string_split(line, chr(9)) AS c, ws FROM rl, w),
rd AS (SELECT judged_at, loaded_at, line, len(c) AS n, trim(c[1], ws) AS query_id, trim(c[3], ws) AS doc_id, try_cast(trim(c[4], ws) AS BIGINT) AS relevance FROM rc),
rj AS (SELECT *, CASE WHEN n <> 4 THEN 'invalid_qrel_row_format' WHEN query_id = '' THEN 'missing_qrel_query_id' WHEN doc_id = '' THEN 'missing_qrel_doc_id' WHEN relevance IS NULL THEN 'invalid_relevance'
  WHEN query_id NOT IN (FROM okq) THEN 'missing_query_ref' WHEN doc_id NOT IN (FROM okd) THEN 'missing_doc_ref' END AS e FROM rd),
ro AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id, e IS NULL ORDER BY judged_at, loaded_at, line) AS r, first_value(relevance) OVER (PARTITION BY query_id, doc_id, e IS NULL ORDER BY judged_at, loaded_at, line) AS f FROM rj),
rk AS (SELECT *, CASE WHEN e IS NOT NULL THEN e WHEN r = 1 THEN NULL WHEN relevance = f THEN 'duplicate_qrel_same_relevance' ELSE 'duplicate_qrel_conflicting_relevance' END AS issue FROM ro)
"""
JUDGED = ("judged_at", "loaded_at", "line")


def checked_queries(spark: SparkSession, folder: str) -> co.Checked:
    return co.tsv_queries(query_lines(spark, folder), "train", ORDER)


def checked_qrels(spark: SparkSession, folder: str, queries: co.Checked | None = None) -> co.Checked:
    known = (queries or checked_queries(spark, folder)).accepted
    return co.tsv_qrels(judgment_lines(spark, folder), known, doc_ids(spark, folder), "train", JUDGED)


@query(f"WITH {SQL_QRELS} SELECT query_id, doc_id, relevance FROM rk WHERE issue IS NULL")
def qrels_waterfall(spark: SparkSession, folder: str) -> DataFrame:
    return checked_qrels(spark, folder).accepted


@query(f"WITH {SQL_QRELS} SELECT issue AS issue_type, count(*) AS \"count\" FROM rk WHERE issue IS NOT NULL GROUP BY 1")
def qrels_issues(spark: SparkSession, folder: str) -> DataFrame:
    return co.error_summary(checked_qrels(spark, folder).issues)


@query(f"WITH {SQL_QRELS} SELECT query_id || '::' || doc_id AS record_id, 'existing=' || f || ', new=' || relevance AS detail FROM rk WHERE issue = 'duplicate_qrel_conflicting_relevance'")
def qrels_conflict(spark: SparkSession, folder: str) -> DataFrame:
    return checked_qrels(spark, folder).issues.where("issue_type = 'duplicate_qrel_conflicting_relevance'").select("record_id", "detail")


@query(f"WITH {SQL_QRELS} SELECT query_id || '::' || doc_id AS record_id, 'x' AS detail FROM rk WHERE issue = 'invalid_relevance'")
def invalid_relevance(spark: SparkSession, folder: str) -> DataFrame:
    return checked_qrels(spark, folder).issues.where("issue_type = 'invalid_relevance'").select("record_id", "detail")


@query(f"WITH {SQL_QRELS} SELECT count(DISTINCT query_id) AS positive_queries FROM rk WHERE issue IS NULL")
def positive_queries(spark: SparkSession, folder: str) -> DataFrame:
    return checked_qrels(spark, folder).accepted.agg(F.count_distinct("query_id").alias("positive_queries"))


@query(f"""WITH {SQL_QRELS}, {SQL_TSV.split(",", 1)[1]}, a AS (SELECT query_id FROM qk WHERE issue IS NULL), b AS (SELECT DISTINCT query_id FROM rk WHERE issue IS NULL)
SELECT 'docs' AS part, 'doc_count' AS metric, count(*) AS "value" FROM k WHERE issue IS NULL UNION ALL SELECT 'docs', 'skipped_count', count(*) FROM k WHERE issue IS NOT NULL
UNION ALL SELECT 'train', 'query_count', count(*) FROM a UNION ALL SELECT 'train', 'skipped_query_count', count(*) FROM qk WHERE issue IS NOT NULL
UNION ALL SELECT 'train', 'qrels_count', count(*) FROM rk WHERE issue IS NULL UNION ALL SELECT 'train', 'skipped_qrels_count', count(*) FROM rk WHERE issue IS NOT NULL
UNION ALL SELECT 'train', 'positive_query_count', count(*) FROM b UNION ALL SELECT 'train', 'orphan_query_count', count(*) FROM a WHERE query_id NOT IN (FROM b)""")
def build_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = co.tsv_docs(corpus(spark, folder, "tsv"))
    queries = checked_queries(spark, folder)
    return co.build_stats(docs, {"train": (queries, checked_qrels(spark, folder, queries))})


@query(f"WITH {SQL_QRELS} SELECT query_id FROM qk WHERE issue IS NULL AND query_id NOT IN (SELECT query_id FROM rk WHERE issue IS NULL)")
def anti_orphans(spark: SparkSession, folder: str) -> DataFrame:
    queries = checked_queries(spark, folder)
    return co.orphans(queries.accepted, checked_qrels(spark, folder, queries).accepted)


@query("SELECT split, count(*) AS judgments FROM qrels WHERE query_id IN (SELECT query_id FROM queries WHERE query_text IS NOT NULL) GROUP BY 1")
def semi_query_ref(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "queries").where("query_text is not null").select("query_id")
    return table(spark, folder, "qrels").join(known, "query_id", "left_semi").groupBy("split").agg(F.count(F.lit(1)).alias("judgments"))


@query(f"WITH {WS} SELECT split, count(*) AS judgments FROM qrels WHERE doc_id IN (SELECT doc_id FROM docs, w WHERE len({SQL_CLEAN}) > 0) GROUP BY 1")
def semi_doc_ref(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "qrels").join(doc_ids(spark, folder), "doc_id", "left_semi").groupBy("split").agg(F.count(F.lit(1)).alias("judgments"))


@query("SELECT query_id FROM queries WHERE query_id IS NOT NULL EXCEPT SELECT query_id FROM qrels")
def query_set_difference(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "queries").select("query_id").where("query_id is not null").subtract(table(spark, folder, "qrels").select("query_id"))


@query("SELECT doc_id, title, loaded_at FROM docs WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY loaded_at, coalesce(title, '')) = 1")
def dedupe_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "docs").where("doc_id is not null").select("doc_id", "title", "loaded_at").withColumn("issue", F.lit(None).cast(ISSUE))
    return good(duplicates(rows, "doc_id", F.struct("loaded_at", txt("title")), "duplicate_doc_id"))


SQL_SPACED = f"""{WS}, {SQL_QUERIES},
okq AS (SELECT DISTINCT query_id FROM qk WHERE issue IS NULL), okd AS (SELECT DISTINCT doc_id FROM docs, w WHERE len({SQL_CLEAN}) > 0),
rl AS (SELECT judged_at, loaded_at, concat_ws(' ', query_id, 'Q0', doc_id, relevance::VARCHAR) AS line FROM qrels),
rc AS (SELECT judged_at, loaded_at, line, regexp_split_to_array(trim(line, ws), '\\s+') AS c FROM rl, w),
rj AS (SELECT *, len(c) AS n, c[1] AS query_id, c[3] AS doc_id, CASE WHEN len(c) <> 4 THEN 'invalid_qrel_row_format' WHEN c[1] NOT IN (FROM okq) THEN 'missing_query_ref' WHEN c[3] NOT IN (FROM okd) THEN 'missing_doc_ref' END AS e FROM rc),
rk AS (SELECT *, CASE WHEN e IS NULL AND row_number() OVER (PARTITION BY query_id, doc_id, e IS NULL ORDER BY judged_at, loaded_at, line) > 1 THEN 'duplicate_qrel_same_relevance' ELSE e END AS issue FROM rj)
"""


@query(f"WITH {SQL_SPACED} SELECT query_id, doc_id, 1::BIGINT AS relevance FROM rk WHERE issue IS NULL")
def ws_qrels_parse(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "qrels").select("judged_at", "loaded_at", F.concat_ws(" ", "query_id", F.lit("Q0"), "doc_id", F.col("relevance").cast("string")).alias("line"))
    queries = co.tsv_queries(query_lines(spark, folder), "train", ORDER).accepted
    return co.spaced_qrels(lines, queries, doc_ids(spark, folder), "train", JUDGED).accepted


def claim_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON line a query: its judged docs as evidence; a number as evidence where a judgment lacks its relevance."""
    q = table(spark, folder, "qrels").where("query_id is not null and doc_id is not null")
    per = q.groupBy("query_id").agg(F.collect_set("doc_id").alias("ids"), F.max(F.col("relevance").isNull()).alias("odd"))
    evidence = F.map_from_entries(F.transform("ids", lambda x: F.struct(x, F.array(F.lit(1)))))
    fine = F.to_json(F.struct(F.col("query_id").alias("id"), evidence.alias("evidence")))
    return per.select("query_id", F.when(F.col("odd"), F.to_json(F.struct(F.col("query_id").alias("id"), F.lit(7).alias("evidence")))).otherwise(fine).alias("line"))


@query(f"""WITH {WS}, {SQL_QUERIES}, okd AS (SELECT DISTINCT doc_id FROM docs, w WHERE len({SQL_CLEAN}) > 0),
b AS (SELECT query_id FROM qrels WHERE query_id IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1 HAVING NOT bool_or(relevance IS NULL))
SELECT DISTINCT query_id, doc_id, 1::BIGINT AS relevance FROM qrels WHERE query_id IN (FROM b) AND doc_id IN (FROM okd) AND query_id IN (SELECT query_id FROM qk WHERE issue IS NULL)""")
def evidence_qrels(spark: SparkSession, folder: str) -> DataFrame:
    lines = claim_lines(spark, folder).withColumnRenamed("query_id", "own")
    queries = co.tsv_queries(query_lines(spark, folder), "train", ORDER).accepted
    return co.evidence_qrels(lines, queries, doc_ids(spark, folder), "train", ("own",))[0].accepted


def sample_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A nested JSON sample a delivery of a query: the docs of its judgments as context, those of positive relevance as
    supporting facts."""
    q = table(spark, folder, "qrels").where("query_id is not null and doc_id is not null").groupBy("query_id", "doc_id").agg(F.max("relevance").alias("relevance"))
    docs = table(spark, folder, "docs").where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("loaded_at", F.coalesce("doc_text", F.array().cast("array<string>")).alias("t"))).getField("t").alias("t"))
    text = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    entry = F.when(F.col("t").isNotNull(), F.concat(F.lit("["), text(F.col("doc_id")), F.lit(","), F.to_json("t"), F.lit("]")))
    fact = F.when(F.col("relevance") > 0, F.concat(F.lit("["), text(F.col("doc_id")), F.lit(",0]")))
    per = q.join(docs, "doc_id", "left").groupBy("query_id").agg(F.array_join(F.collect_list(entry), ",").alias("context"), F.array_join(F.collect_list(fact), ",").alias("facts"))
    rows = table(spark, folder, "queries").select("query_id", "query_text", "loaded_at").join(per, "query_id", "left")
    question = F.coalesce(text(F.col("query_text")), F.lit("null"))
    line = F.concat(F.lit('{"_id":'), F.coalesce(text(F.col("query_id")), F.lit("null")), F.lit(',"question":'), question, F.lit(',"context":['), txt("context"), F.lit('],"supporting_facts":['), txt("facts"), F.lit("]}"))
    return rows.select("loaded_at", txt("query_text").alias("q"), line.alias("line"))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    js.enable(spark)
    return computed(sample_lines(spark, folder), "v", js.whole_json(F.col("line"))).drop("line")


SQL_HOPS = f"""{WS},
q0 AS (SELECT trim(coalesce(query_id, ''), ws) AS query_id, trim(coalesce(query_text, ''), ws) AS query_text, loaded_at, coalesce(query_text, '') AS raw FROM queries, w),
q AS (SELECT *, query_id <> '' AND query_text <> '' AS fine FROM q0),
q1 AS (SELECT query_id, query_text FROM q WHERE fine QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY loaded_at, raw) = 1),
dd AS (SELECT doc_id, {SQL_CLEAN} AS t FROM docs, w WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY loaded_at) = 1),
r AS (SELECT query_id, doc_id, max(relevance) AS relevance FROM qrels WHERE query_id IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1, 2),
ctx AS (SELECT query_id, doc_id AS title, t FROM r JOIN q1 USING (query_id) JOIN dd USING (doc_id)),
facts AS (SELECT query_id, doc_id AS title FROM r JOIN q1 USING (query_id) WHERE relevance > 0),
good_docs AS (SELECT * FROM ctx WHERE len(t) > 0)
"""
SAMPLE_ORDER = ("loaded_at", "q")


def hops(spark: SparkSession, folder: str) -> co.MultiHop:
    return co.multi_hop(samples(spark, folder), "train", SAMPLE_ORDER)


@query(f"WITH {SQL_HOPS} SELECT query_id || '::' || title AS doc_id, title, array_to_string(t, '|') AS doc_text FROM good_docs")
def hotpot_docs(spark: SparkSession, folder: str) -> DataFrame:
    return hops(spark, folder).docs.accepted.withColumn("doc_text", F.array_join("doc_text", "|"))


@query(f"WITH {SQL_HOPS} SELECT query_id, query_id || '::' || title AS doc_id, 1::BIGINT AS relevance FROM facts SEMI JOIN good_docs USING (query_id, title)")
def hotpot_qrels(spark: SparkSession, folder: str) -> DataFrame:
    return hops(spark, folder).qrels.accepted


@query(f"""WITH {SQL_HOPS}, p AS (SELECT DISTINCT query_id FROM facts SEMI JOIN good_docs USING (query_id, title)),
s AS (SELECT (SELECT count(*) FROM good_docs) AS doc_count, (SELECT count(*) FROM q1) AS query_count, (SELECT count(*) FROM facts SEMI JOIN good_docs USING (query_id, title)) AS qrels_count, (SELECT count(*) FROM p) AS positive_query_count,
(SELECT count(*) FROM ctx WHERE len(t) = 0) AS skipped_doc_count, (SELECT count(*) FROM q) - (SELECT count(*) FROM q1) AS skipped_query_count, (SELECT count(*) FROM facts ANTI JOIN good_docs USING (query_id, title)) AS skipped_qrels_count,
(SELECT count(*) FROM q1) - (SELECT count(*) FROM p) AS orphan_query_count)
SELECT 'train' AS split, * FROM s UNION ALL SELECT NULL, * FROM s""")
def hotpot_stats_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return co.multi_hop_stats({"train": hops(spark, folder)})


@query(f"""WITH {WS}, d AS (SELECT loaded_at, trim(coalesce(doc_id, ''), ws) AS doc_id, CASE WHEN trim(coalesce(title, ''), ws) <> '' THEN trim(title, ws) ELSE array_to_string({SQL_CLEAN}, ' ') END AS doc_text FROM docs, w)
SELECT doc_id, doc_text FROM d WHERE doc_id <> '' AND doc_text <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY loaded_at, doc_text) = 1""")
def car_docs_fallback_chain(spark: SparkSession, folder: str) -> DataFrame:
    source = lambda s: F.when(F.coalesce(F.col("source"), F.lit("")) == s, F.col("doc_id"))
    other = F.when(~F.coalesce(F.col("source"), F.lit("")).isin("msmarco", "trec_car"), F.col("doc_id"))
    null = F.lit(None).cast("string")
    rows = table(spark, folder, "docs").select("loaded_at", source("msmarco").alias("para_id"), source("trec_car").alias("paragraph_id"), other.alias("id"), null.alias("get_text"), F.lit(" ").alias("text"), F.col("title").alias("paragraph_text"), null.alias("paragraph"), F.col("doc_text").alias("bodies"))
    return co.paragraph_docs(rows.withColumn("t", pp.paragraph_text()), ("loaded_at", "t")).accepted


@query(f"""WITH {WS}, d AS (SELECT loaded_at, trim(coalesce(query_id, ''), ws) AS query_id, trim(coalesce(query_text, ''), ws) AS query_text FROM queries, w)
SELECT query_id, query_text FROM d WHERE query_id <> '' AND query_text <> '' QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY loaded_at, query_text) = 1""")
def car_outline_queries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "queries").select("loaded_at", F.col("query_id").alias("page_id"), F.col("query_text").alias("page_name"), tx.strip("query_text").alias("t"))
    return co.outline_queries(rows, "train", ("loaded_at", "t")).accepted


# Chunks


def _cjk(x: str) -> str:
    return f"length(regexp_replace({x}, '[^一-鿿]', '', 'g'))"


def _tokens(c: str, o: str) -> str:
    return f"greatest(1, {c} + ({o}) // 4)"


def _size(x: str) -> str:
    return _tokens(_cjk(x), f"length({x}) - {_cjk(x)}")


#: Each delivery of a doc (r) with its cleaned texts.
SQL_TEXTS = f"""{WS}, texts AS (SELECT row_number() OVER () AS r, doc_id, {SQL_CLEAN} AS kept FROM docs, w),
items AS (SELECT r, doc_id, generate_subscripts(kept, 1) AS b, unnest(kept) AS x FROM texts)"""


def sql_pack(name: str, parts: str, glue: str, limit: int) -> str:
    """CTEs from parts (r, b, i, part), i from 1 in each (r, b), to name (r, b, chunk, text, big): joined up to the limit. Without
    glue a part beyond the limit stays alone (big)."""
    alone = f"{_tokens('p.c', 'p.o')} > {limit}" if not glue else "false"
    fresh = f"(q.big OR {alone} OR {_tokens('q.c + p.c', f'q.o + {len(glue)} + p.o')} > {limit})"
    return f"""{name}_p AS (SELECT *, {_cjk("part")} AS c, length(part) - {_cjk("part")} AS o FROM {parts}),
{name}_q AS (SELECT r, b, i, 1 AS chunk, c, o, {alone} AS big, part FROM {name}_p p WHERE i = 1
  UNION ALL SELECT p.r, p.b, p.i, q.chunk + {fresh}::INT, CASE WHEN {fresh} THEN p.c ELSE q.c + p.c END, CASE WHEN {fresh} THEN p.o ELSE q.o + {len(glue)} + p.o END, {alone}, p.part
  FROM {name}_q q JOIN {name}_p p ON p.r = q.r AND p.b = q.b AND p.i = q.i + 1),
{name} AS (SELECT r, b, chunk, string_agg(part, '{glue}' ORDER BY i) AS text, bool_or(big) AS big FROM {name}_q GROUP BY r, b, chunk)"""


def sql_chars(name: str, source: str, limit: int) -> str:
    """CTEs from source (r, b, chunk, x) to name (..., s, text): the longest pieces within the limit, from the left."""
    step = lambda at: f"list_max(list_filter(range(1, {4 * limit + 4}), lambda k: {at} + k - 1 <= length(x) AND {_size(f'substr(x, {at}, k)')} <= {limit}))"
    return f"""{name}_q AS (SELECT r, b, chunk, x, 1::BIGINT AS s, {step("1")} AS n FROM {source} WHERE x <> ''
  UNION ALL SELECT r, b, chunk, x, s + n, {step("(s + n)")} FROM {name}_q WHERE s + n <= length(x)),
{name} AS (SELECT r, b, chunk, s, substr(x, s, n) AS text FROM {name}_q)"""


def sql_merge(name: str, source: str, small: int = 200, goal: int = 600) -> str:
    """CTEs from source (r, chunks: a list) to name (r, done: the list with small chunks merged)."""
    n = lambda a, b: _tokens(f"{_cjk(a)} + {_cjk(b)}", f"length({a}) + length({b}) + 2 - {_cjk(a)} - {_cjk(b)}")
    cost = lambda a, b: f"row({n(a, b)} > {goal}, abs({goal} - {n(a, b)}), {n(a, b)})"
    glued = lambda a, b: f"rtrim({a}, {SQL_WHITE}) || chr(10) || chr(10) || ltrim({b}, {SQL_WHITE})"
    left = f"len(done) > 0 AND (len(todo) = 1 OR {cost('done[-1]', 'todo[1]')} <= {cost('todo[1]', 'todo[2]')})"
    return f"""{name}_q AS (SELECT r, []::VARCHAR[] AS done, chunks AS todo FROM {source}
  UNION ALL SELECT r, CASE k WHEN 'keep' THEN list_append(done, todo[1]) WHEN 'left' THEN done[:-2] ELSE done END,
    CASE k WHEN 'keep' THEN todo[2:] WHEN 'left' THEN list_prepend({glued("done[-1]", "todo[1]")}, todo[2:]) ELSE list_prepend({glued("todo[1]", "todo[2]")}, todo[3:]) END
  FROM (SELECT *, CASE WHEN {_size("todo[1]")} >= {small} OR len(done) = 0 AND len(todo) = 1 THEN 'keep' WHEN {left} THEN 'left' ELSE 'right' END AS k FROM {name}_q WHERE len(todo) > 0)),
{name} AS (SELECT r, done FROM {name}_q WHERE len(todo) = 0)"""


SQL_SENTENCES = """list_filter(list_transform(string_split(regexp_replace(regexp_replace(x, '([.!?])\\s+', '\\1' || chr(30), 'g'), '([。！？])\\s*', '\\1' || chr(30), 'g'), chr(30)), lambda y: trim(y, ws)), lambda y: y <> '')"""
SQL_PACKED = f"{SQL_TEXTS}, parts AS (SELECT r, 0 AS b, b AS i, x AS part FROM items), {sql_pack('packed', 'parts', ' ', 600)}"
_AT = "(row_number() OVER (PARTITION BY r ORDER BY {}) - 1)::INT AS position"

SQL_CANDIDATE_CHUNKS = f"""{SQL_TEXTS},
one AS (SELECT r, kept[1] AS text FROM texts WHERE len(kept) = 1),
para AS (SELECT r, ps, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT r, list_filter(list_transform(regexp_split_to_array(text, '\\n{{2,}}'), lambda y: trim(y, ws)), lambda y: y <> '') AS ps FROM one, w)),
blocked AS (SELECT *, sum(CASE WHEN i > 1 AND regexp_matches(p, '^(?:[-*•]|(?:\\(?\\d+\\)?|[A-Z]|[IVXivx]+)[\\.\\):])\\s+') THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS b FROM para),
block AS (SELECT r, b, string_agg(p, ' ' ORDER BY i) AS x FROM blocked GROUP BY 1, 2),
cut AS (SELECT r, b, CASE WHEN {_size("x")} <= 600 THEN [x] ELSE {SQL_SENTENCES} END AS ss FROM block, w),
parts AS (SELECT r, b, generate_subscripts(ss, 1) AS i, unnest(ss) AS part FROM cut UNION ALL SELECT r, 0, b, x FROM items WHERE r NOT IN (SELECT r FROM one)),
{sql_pack("packed", "parts", " ", 600)},
lists AS (SELECT r, list(text ORDER BY b, chunk) AS chunks FROM packed GROUP BY 1), {sql_merge("merged", "lists")}"""


@query(f"""WITH RECURSIVE {SQL_CANDIDATE_CHUNKS} SELECT doc_id, (generate_subscripts(done, 1))::INT AS "order", unnest(done) AS text FROM merged JOIN texts USING (r)""")
def split_to_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return em.doc_candidates(table(spark, folder, "docs")).select("doc_id", F.inline("candidates"))


def over_texts(spark: SparkSession, folder: str, f) -> DataFrame:
    return table(spark, folder, "docs").select("doc_id", F.posexplode(chunking.texts_udf(f)(tx.clean_items("doc_text"))).alias("position", "chunk"))


@query(f"WITH RECURSIVE {SQL_PACKED} SELECT doc_id, {_AT.format('chunk')}, text AS chunk FROM packed JOIN texts USING (r)")
def greedy_pack(spark: SparkSession, folder: str) -> DataFrame:
    return over_texts(spark, folder, chunking.Chunker().pack_sentences)


SQL_HARD = rf"""{SQL_TEXTS},
long AS (SELECT r, b, list_filter(list_transform(regexp_extract_all(x, '[,，:：、\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[^,，:：、\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'), lambda y: trim(y, ws)), lambda y: y <> '') AS ps FROM items, w WHERE {_size("x")} > 40),
parts AS (SELECT r, b, generate_subscripts(ps, 1) AS i, unnest(ps) AS part FROM long),
{sql_pack("packed", "parts", "", 40)},
wide AS (SELECT r, b, chunk, text AS x FROM packed WHERE big), {sql_chars("narrow", "wide", 40)},
every AS (SELECT r, b, 0 AS chunk, 0 AS s, x AS text FROM items WHERE {_size("x")} <= 40 UNION ALL SELECT r, b, chunk, 0, text FROM packed WHERE NOT big UNION ALL FROM narrow)"""


@query(f"WITH RECURSIVE {SQL_HARD} SELECT doc_id, {_AT.format('b, chunk, s')}, text AS chunk FROM every JOIN texts USING (r)")
def hard_split(spark: SparkSession, folder: str) -> DataFrame:
    return over_texts(spark, folder, lambda xs: [c for x in xs for c in chunking.Chunker().split_long(x, 40)])


@query(f"WITH RECURSIVE {SQL_TEXTS}, whole AS (SELECT r, b, 1 AS chunk, x FROM items), {sql_chars('narrow', 'whole', 40)} SELECT doc_id, {_AT.format('b, s')}, text AS chunk FROM narrow JOIN texts USING (r)")
def char_split(spark: SparkSession, folder: str) -> DataFrame:
    return over_texts(spark, folder, lambda xs: [c for x in xs for c in chunking.Chunker().split_chars(x, 40)])


@query(f"WITH RECURSIVE {SQL_TEXTS}, lists AS (SELECT r, kept AS chunks FROM texts WHERE len(kept) > 0), {sql_merge('merged', 'lists')} SELECT doc_id, (generate_subscripts(done, 1) - 1)::INT AS position, unnest(done) AS chunk FROM merged JOIN texts USING (r)")
def merge_small(spark: SparkSession, folder: str) -> DataFrame:
    return over_texts(spark, folder, chunking.Chunker().merge_small)


@query("SELECT count(*) AS docs, sum(coalesce(len(candidates), 0))::BIGINT AS chunks, count(*) FILTER (candidate_count IS DISTINCT FROM coalesce(len(candidates), 0)) AS miscounted FROM doc_candidates")
def candidate_stats(spark: SparkSession, folder: str) -> DataFrame:
    n = F.coalesce(F.when(F.col("candidates").isNotNull(), F.size("candidates")), F.lit(0))
    return table(spark, folder, "doc_candidates").agg(F.count(F.lit(1)).alias("docs"), F.sum(n).cast("long").alias("chunks"), F.count_if(~F.col("candidate_count").eqNullSafe(n)).alias("miscounted"))


@query("""WITH t AS (SELECT (length(regexp_replace(text, '[^一-鿿]', '', 'g')) + (length(text) - length(regexp_replace(text, '[^一-鿿]', '', 'g'))) // 4) AS n FROM documents)
SELECT count(n) AS texts, min(n)::INT AS least, max(n)::INT AS most, round(avg(n), 6) AS mean, count(*) FILTER (n > 200) AS over_limit, count(*) FILTER (n >= 160) AS near_limit FROM t""")
def token_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return encoders.length_stats(table(spark, folder, "documents"), tx.token_estimate("text"), 200).withColumn("mean", F.round("mean", 6))


# Vectors: every eight (or size) of the table are the chunks of a document


def chunk_vectors(spark: SparkSession, folder: str, size: int = 8) -> DataFrame:
    v = table(spark, folder, "embeddings").select(F.concat(F.lit("d"), F.floor(F.col("vec_id") / size).cast("string")).alias("doc_id"), F.struct((F.col("vec_id") % size + 1).cast("int").alias("order"), F.col("vec_id").cast("string").alias("text"), F.col("embedding").cast("array<double>").alias("v")).alias("c"))
    per = v.groupBy("doc_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    return per.select("doc_id", F.transform("cs", lambda c: F.struct(c["order"].alias("order"), c["text"].alias("text"))).alias("candidates"), F.transform("cs", lambda c: c["v"]).alias("vectors"))


SQL_UNIT = "list_transform(e, lambda x: x / CASE WHEN sqrt(list_inner_product(e, e)) = 0 THEN 1 ELSE sqrt(list_inner_product(e, e)) END)"
SQL_VECTORS = "v0 AS (SELECT 'd' || (vec_id // 8) AS doc_id, (vec_id % 8 + 1)::INT AS i, embedding::DOUBLE[] AS e FROM embeddings)"


def sql_mmr(vectors: str, unit: str = SQL_UNIT) -> str:
    """CTEs from v0 (doc_id, i, e) to picks (doc_id, i, score, rank, n)."""
    first = "lambda p, q: CASE WHEN q.g > p.g AND abs(q.g - p.g) > 1e-8 + 1e-5 * abs(p.g) THEN q ELSE p END"  # up the indices, a close score doesn't win
    best = lambda x: f"SELECT x.* FROM {x} x JOIN (SELECT doc_id, list_reduce(list({{'i': i, 'g': score}} ORDER BY i), {first}).i AS i FROM {x} GROUP BY 1) USING (doc_id, i)"
    return f"""{vectors}, v AS (SELECT doc_id, i, {unit} AS e, count(*) OVER (PARTITION BY doc_id) AS n FROM v0),
m AS (SELECT doc_id, d, avg(x) AS x FROM (SELECT doc_id, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM v) GROUP BY 1, 2),
c0 AS (SELECT doc_id, list(x ORDER BY d) AS e FROM m GROUP BY 1), c AS (SELECT doc_id, {SQL_UNIT} AS e FROM c0),
s AS (SELECT doc_id, i, n, v.e, list_inner_product(v.e, c.e) AS rep FROM v JOIN c USING (doc_id)),
a0 AS (SELECT doc_id, i, n, e, rep AS score FROM s), a AS ({best("a0")}),
b0 AS (FROM (SELECT s.doc_id, s.i, s.n, s.e, 0.7 * s.rep - 0.3 * list_inner_product(s.e, a.e) AS score FROM s JOIN a USING (doc_id) WHERE s.i <> a.i)), b AS ({best("b0")}),
t0 AS (FROM (SELECT s.doc_id, s.i, s.n, s.e, 0.7 * s.rep - 0.3 * greatest(list_inner_product(s.e, a.e), list_inner_product(s.e, b.e)) AS score FROM s JOIN a USING (doc_id) JOIN b USING (doc_id) WHERE s.i <> a.i AND s.i <> b.i)), t AS ({best("t0")}),
picks AS (SELECT doc_id, i, n, score, 1 AS rank FROM a UNION ALL SELECT doc_id, i, n, score, 2 FROM b UNION ALL SELECT doc_id, i, n, score, 3 FROM t)"""


SQL_PICKS = "SELECT doc_id, doc_id || '#c' || lpad(i::VARCHAR, 3, '0') AS chunk_id, rank::BIGINT AS chunk_rank, round(score, 5) + 0.0 AS chunk_score FROM picks"


def picks(chosen: DataFrame) -> DataFrame:
    return chosen.select("doc_id", "chunk_id", "chunk_rank", (F.round("chunk_score", 5) + F.lit(0.0)).alias("chunk_score"))


@query(f"WITH {sql_mmr(SQL_VECTORS)} {SQL_PICKS}")
def mmr_top3(spark: SparkSession, folder: str) -> DataFrame:
    return picks(em.selected_chunks(chunk_vectors(spark, folder)))


@query(f"WITH {sql_mmr(SQL_VECTORS.replace('8', '3'))} {SQL_PICKS} WHERE n <= 3")
def direct_keep(spark: SparkSession, folder: str) -> DataFrame:
    return picks(em.selected_chunks(chunk_vectors(spark, folder, 3).where(F.size("vectors") <= 3)))


@query(f"WITH {SQL_VECTORS}, u AS (SELECT doc_id, i, {SQL_UNIT} AS e FROM v0) SELECT doc_id, i AS chunk, (generate_subscripts(e, 1))::INT AS position, round(unnest(e), 6) + 0.0 AS value FROM u")
def l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    unit = chunk_vectors(spark, folder).select("doc_id", F.posexplode(F.transform("vectors", vx.normalized)).alias("p", "e"))
    each = unit.select("doc_id", (F.col("p") + 1).alias("chunk"), F.posexplode("e").alias("q", "x"))
    return each.select("doc_id", "chunk", (F.col("q") + 1).alias("position"), (F.round("x", 6) + F.lit(0.0)).alias("value"))


@query(f"WITH {sql_mmr(SQL_VECTORS)} SELECT doc_id, (generate_subscripts(e, 1))::INT AS position, round(unnest(e), 6) + 0.0 AS value FROM c")
def centroid(spark: SparkSession, folder: str) -> DataFrame:
    mean = chunk_vectors(spark, folder).select("doc_id", F.transform("vectors", vx.normalized).alias("u")).select("doc_id", F.posexplode(vx.centroid(F.col("u"))).alias("p", "x"))
    return mean.select("doc_id", (F.col("p") + 1).alias("position"), (F.round("x", 6) + F.lit(0.0)).alias("value"))


@query(f"WITH {sql_mmr(SQL_VECTORS)} SELECT doc_id, i AS chunk, round(rep, 6) + 0.0 AS score FROM s")
def rep_score(spark: SparkSession, folder: str) -> DataFrame:
    unit = chunk_vectors(spark, folder).select("doc_id", F.transform("vectors", vx.normalized).alias("u")).withColumn("c", vx.centroid(F.col("u")))
    return unit.select("doc_id", F.posexplode(F.transform("u", lambda v: vx.dot(v, F.col("c")))).alias("p", "s")).select("doc_id", (F.col("p") + 1).alias("chunk"), (F.round("s", 6) + F.lit(0.0)).alias("score"))


@query("SELECT count(*) FILTER (len(embedding) <= 64) AS passed FROM embeddings")
def dim_guard(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(vx.checked_dim(F.col("embedding").cast("array<double>"), 64).alias("v")).agg(F.count("v").alias("passed"))


# Encoding with the stand-in encoder

STAND_IN = encoders.LetterProfile
DIM = len(STAND_IN.letters) + 1


def sql_profile(text: str) -> str:
    return "[" + ", ".join(f"(length(lower({text})) - length(replace(lower({text}), '{c}', '')))::DOUBLE" for c in STAND_IN.letters) + ", 1.0::DOUBLE]"


@query(f"WITH {WS}, v AS (SELECT query_id, {sql_profile('query_text')} AS e FROM queries WHERE query_text IS NOT NULL), u AS (SELECT query_id, {SQL_UNIT} AS e FROM v) SELECT query_id, (generate_subscripts(e, 1))::INT AS position, round(unnest(e), 6) AS value FROM u")
def encode_queries(spark: SparkSession, folder: str) -> DataFrame:
    made = table(spark, folder, "queries").where("query_text is not null").select("query_id", encoders.encode_texts("stand-in", STAND_IN, DIM, True)("query_text").alias("e"))
    return made.select("query_id", F.posexplode("e").alias("p", "x")).select("query_id", (F.col("p") + 1).alias("position"), F.round("x", 6).alias("value"))


SQL_CANDIDATES = f"""d AS (SELECT doc_id, row_number() OVER () AS row, c."text" AS text, c."order" AS o FROM (SELECT doc_id, unnest(candidates) AS c FROM doc_candidates)),
w0 AS (SELECT doc_id, o, {sql_profile("coalesce(text, '')")} AS e FROM d)"""


@query(f'WITH {SQL_CANDIDATES}, u AS (SELECT doc_id, o, {SQL_UNIT} AS e FROM w0) SELECT doc_id, o AS "order", (generate_subscripts(e, 1))::INT AS position, round(unnest(e), 6) AS value FROM u')
def encode_docs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "doc_candidates").where(F.size("candidates") > 0)
    texts = F.transform("candidates", lambda c: F.coalesce(c["text"], F.lit("")))
    made = rows.select("doc_id", "candidates", encoders.encode_lists("stand-in", STAND_IN, DIM)(texts).alias("v"))
    each = made.select("doc_id", F.inline(F.arrays_zip(F.col("candidates.order").alias("o"), "v")))
    return each.select("doc_id", F.col("o").alias("order"), F.posexplode("v").alias("p", "x")).select("doc_id", "order", (F.col("p") + 1).alias("position"), F.round("x", 6).alias("value"))


SQL_EMBEDDED = f"""{SQL_CANDIDATE_CHUNKS}, chunks AS (SELECT r, generate_subscripts(done, 1) AS i, unnest(done) AS text, len(done) AS total FROM merged),
v0 AS (SELECT r AS doc_id, i, {sql_profile("text")} AS e FROM chunks)"""


@query(f"""WITH RECURSIVE {sql_mmr(SQL_EMBEDDED)}
SELECT t.doc_id, t.doc_id || '#c' || lpad(p.i::VARCHAR, greatest(3, length(total::VARCHAR))::INT, '0') AS chunk_id, text AS chunk_text, rank::BIGINT AS chunk_rank, round(score, 5) + 0.0 AS chunk_score, (generate_subscripts(v.e, 1))::INT AS position, round(unnest(v.e), 6) AS value
FROM picks p JOIN chunks k ON k.r = p.doc_id AND k.i = p.i JOIN v ON v.doc_id = p.doc_id AND v.i = p.i JOIN texts t ON t.r = p.doc_id""")
def embedded_docs(spark: SparkSession, folder: str) -> DataFrame:
    rows = em.doc_candidates(table(spark, folder, "docs"))
    vectors = encoders.encode_lists("stand-in", STAND_IN, DIM)(F.col("candidates.text"))
    chosen = em.selected_chunks(rows.withColumn("vectors", vectors), dim=DIM)
    each = chosen.select("doc_id", "chunk_id", "chunk_text", "chunk_rank", (F.round("chunk_score", 5) + F.lit(0.0)).alias("chunk_score"), F.posexplode("chunk_vector").alias("p", "x"))
    return each.select("doc_id", "chunk_id", "chunk_text", "chunk_rank", "chunk_score", (F.col("p") + 1).alias("position"), F.round("x", 6).alias("value"))


# Sinks and streams


@query("SELECT vec_id, (vec_id // 100)::INT AS shard FROM embeddings")
def shard_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.with_call_shards(table(spark, folder, "embeddings").withColumn("call", F.col("vec_id") + 1), "call", 100).select("vec_id", "shard")


@query("SELECT query_id, query_text, query_embedding::VARCHAR IS NULL AS no_vector, (generate_subscripts(query_embedding, 1))::INT AS position, coalesce(round(unnest(query_embedding)::DOUBLE, 6), -9) + 0.0 AS value FROM query_vectors WHERE len(query_embedding) > 0")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    sinks.write_shards(table(spark, folder, "query_vectors"), at, sinks.QUERY_COLUMNS, 1000)
    back = spark.read.parquet(at).select("query_id", "query_text", F.col("query_embedding").isNull().alias("no_vector"), F.posexplode("query_embedding").alias("p", "x"))
    return back.select("query_id", "query_text", "no_vector", (F.col("p") + 1).alias("position"), (F.coalesce(F.round(F.col("x").cast("double"), 6), F.lit(-9.0)) + F.lit(0.0)).alias("value"))


@query("SELECT query_id, doc_id, relevance FROM qrels")
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    sinks.write_json_lines(table(spark, folder, "qrels").select("query_id", "doc_id", "relevance"), at)
    return spark.read.schema("query_id string, doc_id string, relevance int").json(at)


@query(f"""WITH RECURSIVE {SQL_CANDIDATE_CHUNKS} SELECT DISTINCT doc_id, "order", text FROM (SELECT trim(doc_id, ws) AS doc_id, (generate_subscripts(done, 1))::INT AS "order", unnest(done) AS text FROM merged JOIN texts USING (r), w) WHERE doc_id <> ''""")
def stream_candidates(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    docs = ingest.stream_parquet(spark, f"{folder}/docs.parquet*")
    ingest.write_available(ingest.candidate_stream(docs, "400 days"), f"{at}/rows", f"{at}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{at}/rows").select("doc_id", F.inline("candidates"))
