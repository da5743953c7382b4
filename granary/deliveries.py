"""Queries that go through files: raw deliveries are written, read back by the sources, and built into datasets by the programs
of plans.builds. Whole tables are written in order, so that the order of lines in files is that of the SQL."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalogue as cat
from . import config, storage
from .functions import text as tx
from .functions import vectors as vx
from .plans import builds
from .plans import collections as co
from .plans import embedding as em
from .queries import query, table
from .runtime import scratch_folder
from .sinks import tables as sinks
from .sources import json_records as js
from .sources import manifests
from .sources.json_arrays import json_array_files
from .sources.lines import numbered_lines
from .sources.paragraphs import ORDER, read_paragraphs

WS = cat.WS
log = logging.getLogger("granary")


def one_line(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]+", " ")


def sql_one_line(x: str) -> str:
    return f"regexp_replace({x}, '[\\r\\n]+', ' ', 'g')"


def written_lines(df: DataFrame, order: list, at: str) -> str:
    """The column line as text files, in order from file to file."""
    df.orderBy(*order).select("line").write.mode("overwrite").text(at)
    return at


def write_array(path: str, lines: DataFrame) -> None:
    """The column line as the elements of one JSON array, a row at a time."""

    def parts():
        before = "["
        for r in lines.toLocalIterator():
            yield before + r.line
            before = ",\n"
        yield "[]" if before == "[" else "]"

    storage.write_text(path, parts())


def stats_rows(spark: SparkSession, stats: dict[str, dict[str, int]]) -> DataFrame:
    return spark.createDataFrame([(part, metric, value) for part, m in stats.items() for metric, value in m.items()], "part string, metric string, value long")


# Sources


@query(f"WITH l AS (SELECT {sql_one_line('line')} AS line FROM corpus_lines WHERE line IS NOT NULL) SELECT row_number() OVER (ORDER BY line) AS number, line FROM l")
def line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers over several files: a line's own number and the lines of the files before its own."""
    lines = table(spark, folder, "corpus_lines").where("line is not null").select(one_line(F.col("line")).alias("line"))
    read = numbered_lines(spark, written_lines(lines, ["line"], scratch_folder(spark)))
    per = read.groupBy("file").agg(F.max("line_num").alias("n"))
    before = per.alias("a").join(per.select(F.col("file").alias("f"), F.col("n").alias("m")), F.col("f") < F.col("file"), "left").groupBy("file").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("before"))
    return read.join(before, "file").select((F.col("line_num") + F.col("before")).alias("number"), "line")


@query(f"WITH {cat.SQL_JSON} SELECT file, line_num, doc_id FROM f WHERE kind = 'OBJECT'")
def lenient_json(spark: SparkSession, folder: str) -> DataFrame:
    """Of the well-formed lines the objects; a malformed one would fail the query."""
    js.enable(spark)
    lines = cat.corpus(spark, folder, "jsonl")
    whole = lines.where(js.whole_json(F.col("line")).isNotNull())
    return js.json_objects(whole).select("file", "line_num", js.as_text(js.member(F.col("v"), "doc_id")).alias("doc_id"))


@query("SELECT row_number() OVER (ORDER BY query_id, loaded_at, query_text) AS line_num, query_id, query_text FROM queries WHERE query_id IS NOT NULL UNION ALL SELECT NULL, 'invalid_json_file', NULL UNION ALL SELECT NULL, 'invalid_json_root_type', 'type=dict'")
def json_array_file(spark: SparkSession, folder: str) -> DataFrame:
    """Queries as one array in a file, read back with its places; beside it a file that is cut off and one that is an object."""
    at = scratch_folder(spark)
    rows = table(spark, folder, "queries").where("query_id is not null").orderBy("query_id", "loaded_at", F.col("query_text").asc_nulls_last())
    write_array(f"{at}/whole.json", rows.select(F.to_json(F.struct("query_id", "query_text")).alias("line")))
    storage.write_text(f"{at}/cut.json", ['[{"a": 1}'])
    storage.write_text(f"{at}/object.json", ["{}"])
    samples, broken = json_array_files(spark, f"{at}/*.json")
    field = lambda n: F.try_variant_get("v", f"$.{n}", "string").alias(n)
    return samples.select("line_num", field("query_id"), field("query_text")).unionByName(broken.select(F.lit(None).cast("long").alias("line_num"), F.col("issue_type").alias("query_id"), F.col("detail").alias("query_text")))


def paragraph_objects(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON object a delivery of a doc: its id and text in other fields by source."""
    source = F.coalesce(F.col("source"), F.lit(""))
    key = lambda s, name: F.when(source == s, F.col("doc_id")).alias(name)
    rest = F.when(~source.isin("msmarco", "trec_car"), F.col("doc_id")).alias("id")
    bodies = F.transform(F.coalesce("doc_text", F.array().cast("array<string>")), lambda x: F.struct(x.alias("text")))
    return table(spark, folder, "docs").select("loaded_at", "doc_id", F.to_json(F.struct(key("msmarco", "para_id"), key("trec_car", "paragraph_id"), rest, F.lit(" ").alias("text"), F.col("title").alias("paragraph_text"), bodies.alias("bodies"))).alias("line"))


SQL_PARAGRAPH_DOCS = f"""d AS (SELECT loaded_at, trim(coalesce(doc_id, ''), ws) AS doc_id, CASE WHEN trim(coalesce(title, ''), ws) <> '' THEN trim(title, ws) ELSE array_to_string({cat.SQL_CLEAN}, ' ') END AS doc_text FROM docs, w),
pd AS (SELECT doc_id, doc_text FROM d WHERE doc_id <> '' AND doc_text <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY loaded_at, doc_text) = 1)"""


@query(f"WITH {WS}, {SQL_PARAGRAPH_DOCS} FROM pd")
def paragraph_files(spark: SparkSession, folder: str) -> DataFrame:
    at = written_lines(paragraph_objects(spark, folder), ["loaded_at", "doc_id"], scratch_folder(spark))
    return co.paragraph_docs(read_paragraphs(spark, at, "granary.sources.decoders.json_lines"), ORDER).accepted


@query("SELECT 'toy' AS name, 'docs.jsonl' AS docs, 'train/queries.jsonl' AS queries")
def manifest_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A dataset found by its manifest, as paths within its folder."""
    at = scratch_folder(spark)
    sinks.write_manifest(f"{at}/toy/dataset.json", sinks.manifest("toy", {}, ("train",)))
    for part in ("docs.jsonl", "train/queries.jsonl"):
        storage.write_text(f"{at}/toy/{part}", ["{}\n"])
    found = manifests.dataset(at, "toy")
    return spark.createDataFrame([(found.name, *[p.removeprefix(f"{found.folder}/") for p in (found.docs, found.queries)])], "name string, docs string, queries string")


@query("SELECT o_orderpriority AS issue_type, count(*) AS listed, sum(o_orderkey)::BIGINT AS places FROM orders GROUP BY 1")
def build_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log of as many issues as there are orders, read back from the one file: every one is listed."""
    at = f"{scratch_folder(spark)}/build_log.json"
    issues = table(spark, folder, "orders").select(F.lit("orders").alias("file"), F.col("o_orderkey").alias("line_num"), F.col("o_orderpriority").alias("issue_type"))
    summary = sinks.write_build_log(at, issues, {})
    listed = spark.read.option("multiLine", True).schema("error_summary map<string,long>, issue_logs array<struct<line_num:long,issue_type:string>>").json(at).select(F.inline("issue_logs"))
    told = listed.groupBy("issue_type").agg(F.count(F.lit(1)).alias("listed"), F.sum("line_num").alias("places"))
    return told.where(F.create_map(*[x for k, n in summary.items() for x in (F.lit(k), F.lit(n))])[F.col("issue_type")] == F.col("listed"))


# Validation of claims, evidence and nested samples


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON line a delivery of a query; an array where lang is null."""
    q = table(spark, folder, "queries")
    fine = F.to_json(F.struct(F.col("query_id").alias("id"), F.col("query_text").alias("claim")))
    return q.select("loaded_at", F.coalesce("query_text", F.lit("")).alias("t"), F.when(F.col("lang").isNull(), F.lit("[1]")).otherwise(fine).alias("line"))


SQL_CLAIMS = f"""{WS}, c AS (SELECT loaded_at, coalesce(query_text, '') AS t, lang IS NULL AS odd, trim(coalesce(query_id, ''), ws) AS query_id, trim(coalesce(query_text, ''), ws) AS query_text FROM queries, w),
e AS (SELECT *, CASE WHEN odd THEN 'invalid_query_record_format' WHEN query_id = '' THEN 'missing_query_id' WHEN query_text = '' THEN 'empty_query_text' END AS e FROM c),
k AS (SELECT *, CASE WHEN e IS NULL AND row_number() OVER (PARTITION BY query_id, e IS NULL ORDER BY loaded_at, t) > 1 THEN 'duplicate_query_id' ELSE e END AS issue FROM e)"""


@query(f"WITH {SQL_CLAIMS} SELECT query_id, query_text FROM k WHERE issue IS NULL")
def claim_queries(spark: SparkSession, folder: str) -> DataFrame:
    return co.json_queries(claims(spark, folder), "train", ("loaded_at", "t")).accepted


@query(f"WITH {SQL_CLAIMS} SELECT issue AS issue_type, CASE WHEN issue IN ('empty_query_text', 'duplicate_query_id') THEN query_id END AS record_id, CASE WHEN issue = 'invalid_query_record_format' THEN 'type=list' END AS detail, count(*) AS n FROM k WHERE issue IS NOT NULL GROUP BY 1, 2, 3")
def claim_issues(spark: SparkSession, folder: str) -> DataFrame:
    issues = co.json_queries(claims(spark, folder), "train", ("loaded_at", "t")).issues
    return issues.groupBy("issue_type", "record_id", "detail").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {WS}, {cat.SQL_QUERIES}, okd AS (SELECT DISTINCT doc_id FROM docs, w WHERE len({cat.SQL_CLEAN}) > 0), okq AS (SELECT query_id FROM qk WHERE issue IS NULL),
b AS (SELECT query_id, bool_or(relevance IS NULL) AS odd FROM qrels WHERE query_id IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1)
SELECT CASE WHEN query_id NOT IN (FROM okq) THEN 'missing_query_ref' ELSE 'invalid_evidence_format' END AS issue_type, query_id AS record_id, CASE WHEN query_id IN (FROM okq) THEN 'type=int' END AS detail FROM b WHERE odd OR query_id NOT IN (FROM okq)
UNION ALL SELECT DISTINCT 'missing_doc_ref', query_id || '::' || doc_id, NULL FROM qrels WHERE doc_id NOT IN (FROM okd) AND query_id IN (FROM okq) AND query_id IN (SELECT query_id FROM b WHERE NOT odd)""")
def evidence_issues(spark: SparkSession, folder: str) -> DataFrame:
    lines = cat.claim_lines(spark, folder).withColumnRenamed("query_id", "own")
    checked, whole = co.evidence_qrels(lines, cat.checked_queries(spark, folder).accepted, cat.doc_ids(spark, folder), "train", ("own",))
    return checked.issues.unionByName(whole).select("issue_type", "record_id", "detail")


@query(f"WITH {cat.SQL_HOPS}, k AS (SELECT *, row_number() OVER (PARTITION BY query_id, fine ORDER BY loaded_at, raw) AS nth FROM q) SELECT CASE WHEN query_id = '' THEN 'missing_query_id' WHEN query_text = '' THEN 'empty_query_text' ELSE 'duplicate_query_id' END AS issue_type, nullif(query_id, '') AS record_id FROM k WHERE NOT fine OR nth > 1")
def hotpot_query_issues(spark: SparkSession, folder: str) -> DataFrame:
    return cat.hops(spark, folder).queries.issues.select("issue_type", "record_id")


@query(f"WITH {cat.SQL_HOPS} SELECT 'empty_doc_sentences' AS issue_type, query_id || '::' || title AS record_id FROM ctx WHERE len(t) = 0")
def hotpot_doc_issues(spark: SparkSession, folder: str) -> DataFrame:
    return cat.hops(spark, folder).docs.issues.select("issue_type", "record_id")


@query(f"WITH {cat.SQL_HOPS} SELECT 'missing_supporting_doc_in_context' AS issue_type, query_id || '::' || title AS record_id FROM facts ANTI JOIN good_docs USING (query_id, title)")
def hotpot_qrel_issues(spark: SparkSession, folder: str) -> DataFrame:
    return cat.hops(spark, folder).qrels.issues.select("issue_type", "record_id")


# Whole builds: the same files serve as train and as dev


SQL_BUILT = f"""{WS},
l AS (SELECT loaded_at, {sql_one_line(f"coalesce(doc_id, '') || chr(9) || array_to_string({cat.SQL_CLEAN}, ' ')")} AS line, ws FROM docs, w),
c AS (SELECT loaded_at, line, trim(substr(line, 1, strpos(line, chr(9)) - 1), ws) AS doc_id, trim(substr(line, strpos(line, chr(9)) + 1), ws) AS doc_text FROM l WHERE trim(line, ws) <> ''),
k AS (SELECT *, CASE WHEN doc_id = '' THEN 'missing_doc_id' WHEN doc_text = '' THEN 'empty_doc_text' WHEN row_number() OVER (PARTITION BY doc_id, doc_text <> '' ORDER BY loaded_at, line) > 1 THEN 'duplicate_doc_id' END AS issue FROM c),
{cat.SQL_QUERIES.replace("|| coalesce(query_text, '') AS line FROM queries)", "|| " + sql_one_line("coalesce(query_text, '')") + " AS line FROM queries)")},
{cat.SQL_QRELS.split("okq AS", 1)[1].join(["okq AS", ""]).replace(f"okd AS (SELECT DISTINCT doc_id FROM docs, w WHERE len({cat.SQL_CLEAN}) > 0)", "okd AS (SELECT doc_id FROM k WHERE issue IS NULL)")},
a AS (SELECT query_id FROM qk WHERE issue IS NULL), b AS (SELECT DISTINCT query_id FROM rk WHERE issue IS NULL),
n AS (SELECT 'query_count' AS metric, count(*) AS "value" FROM a UNION ALL SELECT 'skipped_query_count', count(*) FROM qk WHERE issue IS NOT NULL
  UNION ALL SELECT 'qrels_count', count(*) FROM rk WHERE issue IS NULL UNION ALL SELECT 'skipped_qrels_count', count(*) FROM rk WHERE issue IS NOT NULL
  UNION ALL SELECT 'positive_query_count', count(*) FROM b UNION ALL SELECT 'orphan_query_count', count(*) FROM a WHERE query_id NOT IN (FROM b))
SELECT 'docs' AS part, 'doc_count' AS metric, count(*) AS "value" FROM k WHERE issue IS NULL UNION ALL SELECT 'docs', 'skipped_count', count(*) FROM k WHERE issue IS NOT NULL
UNION ALL SELECT 'train', * FROM n UNION ALL SELECT 'dev', * FROM n"""


@query(f"WITH {SQL_BUILT}")
def built_tab_separated(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    docs = table(spark, folder, "docs").select("loaded_at", one_line(F.concat(cat.txt("doc_id"), F.lit("\t"), tx.joined_text("doc_text"))).alias("line"))
    written_lines(docs, ["loaded_at", "line"], f"{at}/collection.tsv")
    queries, qrels = cat.query_lines(spark, folder).withColumn("line", one_line(F.col("line"))), cat.judgment_lines(spark, folder)
    for split in ("train", "dev"):
        written_lines(queries, ["loaded_at", "line"], f"{at}/queries.{split}.tsv")
        written_lines(qrels, ["judged_at", "loaded_at", "line"], f"{at}/qrels.{split}.tsv")
    return stats_rows(spark, builds.tab_separated(spark, at, f"{at}/out", say=log.info))


SQL_BUILT_PARAGRAPHS = f"""{WS}, {SQL_PARAGRAPH_DOCS},
o AS (SELECT loaded_at, trim(coalesce(query_id, ''), ws) AS query_id, trim(coalesce(query_text, ''), ws) AS query_text FROM queries, w),
oq AS (SELECT query_id FROM o WHERE query_id <> '' AND query_text <> '' GROUP BY 1),
r AS (SELECT regexp_split_to_array(trim(line, ws), '\\s+') AS c FROM (SELECT concat_ws(' ', query_id, 'Q0', doc_id, relevance::VARCHAR) AS line FROM qrels), w),
g AS (SELECT DISTINCT c[1] AS query_id, c[3] AS doc_id FROM r WHERE len(c) = 4 AND c[1] IN (FROM oq) AND c[3] IN (SELECT doc_id FROM pd))
SELECT 'docs' AS part, 'doc_count' AS metric, count(*) AS "value" FROM pd UNION ALL SELECT 'docs', 'skipped_count', (SELECT count(*) FROM docs) - count(*) FROM pd
UNION ALL SELECT 'train', 'query_count', count(*) FROM oq UNION ALL SELECT 'train', 'skipped_query_count', (SELECT count(*) FROM queries) - count(*) FROM oq
UNION ALL SELECT 'train', 'qrels_count', count(*) FROM g UNION ALL SELECT 'train', 'skipped_qrels_count', (SELECT count(*) FROM qrels) - count(*) FROM g
UNION ALL SELECT 'train', 'positive_query_count', count(DISTINCT query_id) FROM g UNION ALL SELECT 'train', 'orphan_query_count', (SELECT count(*) FROM oq) - count(DISTINCT query_id) FROM g"""


@query(f"WITH {SQL_BUILT_PARAGRAPHS}")
def built_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    written_lines(paragraph_objects(spark, folder), ["loaded_at", "doc_id"], f"{at}/docs")
    outlines = table(spark, folder, "queries").select("loaded_at", "query_id", F.to_json(F.struct(F.col("query_id").alias("page_id"), F.col("query_text").alias("page_name"))).alias("line"))
    written_lines(outlines, ["loaded_at", "query_id"], f"{at}/outlines")
    lines = table(spark, folder, "qrels").select("judged_at", "loaded_at", F.concat_ws(" ", "query_id", F.lit("Q0"), "doc_id", F.col("relevance").cast("string")).alias("line"))
    written_lines(lines, ["judged_at", "loaded_at", "line"], f"{at}/qrels")
    return stats_rows(spark, builds.paragraphs(spark, at, f"{at}/out", "granary.sources.decoders.json_lines", docs="docs", outlines="outlines", qrels="qrels", say=log.info))


SQL_BUILT_CLAIMS = f"""{WS},
d AS (SELECT loaded_at, trim(coalesce(doc_id, ''), ws) AS doc_id, {cat.SQL_CLEAN} AS t FROM docs, w),
dk AS (SELECT doc_id FROM d WHERE doc_id <> '' AND len(t) > 0 GROUP BY 1),
o AS (SELECT trim(coalesce(query_id, ''), ws) AS query_id, trim(coalesce(query_text, ''), ws) AS query_text FROM queries, w),
ok AS (SELECT query_id FROM o WHERE query_id <> '' AND query_text <> '' GROUP BY 1),
j AS (SELECT query_id, list(DISTINCT doc_id) AS ids FROM qrels WHERE query_id IS NOT NULL AND doc_id IS NOT NULL GROUP BY 1),
lines AS (SELECT o.query_id, coalesce(ids, []) AS ids FROM o LEFT JOIN j USING (query_id)),
each AS (SELECT query_id, unnest(ids) AS doc_id FROM lines WHERE query_id IN (FROM ok)),
g AS (SELECT DISTINCT query_id, doc_id FROM each WHERE doc_id IN (FROM dk)),
n AS (SELECT 'query_count' AS metric, count(*) AS "value" FROM ok UNION ALL SELECT 'skipped_query_count', (SELECT count(*) FROM o) - count(*) FROM ok
  UNION ALL SELECT 'qrels_count', count(*) FROM g UNION ALL SELECT 'skipped_qrels_count', (SELECT count(*) FROM each) - count(*) + (SELECT count(*) FROM lines WHERE query_id NOT IN (FROM ok)) FROM g
  UNION ALL SELECT 'positive_query_count', count(DISTINCT query_id) FROM g UNION ALL SELECT 'orphan_query_count', (SELECT count(*) FROM ok) - count(DISTINCT query_id) FROM g)
SELECT 'docs' AS part, 'doc_count' AS metric, count(*) AS "value" FROM dk UNION ALL SELECT 'docs', 'skipped_count', (SELECT count(*) FROM docs) - count(*) FROM dk
UNION ALL SELECT 'train', * FROM n UNION ALL SELECT 'dev', * FROM n"""


@query(f"WITH {SQL_BUILT_CLAIMS}")
def built_claims(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    docs = table(spark, folder, "docs").select("loaded_at", "doc_id", F.to_json(F.struct("doc_id", "title", F.coalesce("doc_text", F.array().cast("array<string>")).alias("abstract"))).alias("line"))
    written_lines(docs, ["loaded_at", "doc_id"], f"{at}/corpus.jsonl")
    q = table(spark, folder, "qrels").where("query_id is not null and doc_id is not null").groupBy("query_id").agg(F.collect_set("doc_id").alias("ids"))
    told = table(spark, folder, "queries").select("loaded_at", "query_id", "query_text").join(q, "query_id", "left")
    evidence = F.map_from_entries(F.transform(F.coalesce("ids", F.array().cast("array<string>")), lambda x: F.struct(x, F.array(F.lit(1)))))
    lines = told.select("loaded_at", "query_id", F.to_json(F.struct(F.col("query_id").alias("id"), F.col("query_text").alias("claim"), evidence.alias("evidence"))).alias("line"))
    for split in ("train", "dev"):
        written_lines(lines, ["loaded_at", "query_id"], f"{at}/claims_{split}.jsonl")
    return stats_rows(spark, builds.claims(spark, at, f"{at}/out", say=log.info))


@query(f"""WITH {cat.SQL_HOPS}, p AS (SELECT DISTINCT query_id FROM facts SEMI JOIN good_docs USING (query_id, title)),
n AS (SELECT 'doc_count' AS metric, count(*) AS "value" FROM good_docs UNION ALL SELECT 'query_count', count(*) FROM q1 UNION ALL SELECT 'qrels_count', count(*) FROM facts SEMI JOIN good_docs USING (query_id, title)
  UNION ALL SELECT 'positive_query_count', count(*) FROM p UNION ALL SELECT 'orphan_query_count', (SELECT count(*) FROM q1) - count(*) FROM p UNION ALL SELECT 'skipped_query_count', count(*) - (SELECT count(*) FROM q1) FROM q
  UNION ALL SELECT 'skipped_qrels_count', count(*) FROM facts ANTI JOIN good_docs USING (query_id, title) UNION ALL SELECT 'skipped_doc_count', count(*) FROM ctx WHERE len(t) = 0)
SELECT 'train' AS part, * FROM n UNION ALL SELECT 'dev', * FROM n UNION ALL SELECT 'overall', metric, 2 * "value" FROM n""")
def built_nested_samples(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_folder(spark)
    write_array(f"{at}/samples.json", cat.sample_lines(spark, folder).orderBy("loaded_at", "q").select("line"))
    return stats_rows(spark, builds.nested_samples(spark, at, f"{at}/out", "samples.json", "samples.json", say=log.info))


# Encoding runs

_MODELS = ("stand/in", "stand/in-2")


@query(f"""WITH {WS}, d AS (SELECT count(*) FILTER (len(c) > 0) AS docs FROM (SELECT {cat.SQL_CLEAN} AS c FROM docs, w) WHERE len(c) > 0), q AS (SELECT count(*) AS n FROM queries, w WHERE query_id IS NOT NULL AND trim(coalesce(query_text, ''), ws) <> '')
SELECT model, docs::BIGINT AS documents, true AS chunks_ranked, n AS queries, true AS unit_vectors FROM d, q, (VALUES ('{_MODELS[0]}'), ('{_MODELS[1]}')) m(model)""")
def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run of two models over a dataset that lies as files: manifest, candidates, both tables of each model."""
    at, dim = scratch_folder(spark), cat.DIM
    docs = table(spark, folder, "docs").where(F.size(tx.clean_items("doc_text")) > 0)
    docs.select(F.concat_ws("/", F.coalesce("doc_id", F.lit("none")), F.col("loaded_at").cast("string"), F.monotonically_increasing_id().cast("string")).alias("doc_id"), "doc_text").write.json(f"{at}/in/toy/docs.jsonl")
    queries = table(spark, folder, "queries").where(F.col("query_id").isNotNull() & ~tx.is_blank("query_text")).select("query_id", "query_text")
    queries.write.json(f"{at}/in/toy/train/queries.jsonl")
    sinks.write_manifest(f"{at}/in/toy/dataset.json", sinks.manifest("toy", {}, ("train",)))
    run = config.settings({"datasets": ["toy"], "experiment": {"embedding_dim": dim, "max_length": 600}, "models": [{"model_id": m, "provider": "stand-in"} for m in _MODELS]})
    em.run(spark, f"{at}/in", run, f"{at}/out", f"{at}/work", make=lambda *_: cat.STAND_IN)
    out = []
    for m in _MODELS:
        base = sinks.output_path(f"{at}/out", m, "toy")
        chunks, told = spark.read.parquet(sinks.doc_table(base, dim)), spark.read.parquet(sinks.query_table(base, dim))
        ranked = chunks.groupBy("doc_id").agg((F.sort_array(F.collect_list("chunk_rank")) == F.sequence(F.lit(1).cast("long"), F.count(F.lit(1)))).alias("ok"), F.max("chunk_rank").alias("most"))
        per = ranked.agg(F.count(F.lit(1)).alias("documents"), F.bool_and(F.col("ok") & (F.col("most") <= 3)).alias("chunks_ranked"))
        length = lambda c: F.abs(vx.norm(F.col(c)) - 1) < 1e-9
        unit = told.agg(F.count(F.lit(1)).alias("queries"), F.bool_and(length("query_embedding")).alias("u")).crossJoin(chunks.agg(F.bool_and(length("chunk_vector")).alias("v")))  # a row each
        out.append(per.crossJoin(unit).select(F.lit(m).alias("model"), "documents", "chunks_ranked", "queries", (F.col("u") & F.col("v")).alias("unit_vectors")))
    return out[0].unionByName(out[1])


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings), s AS (SELECT vec_id, round(a, 4) AS a, round(b, 4) AS b FROM p)
SELECT vec_id, abs(a - b) <= 1e-8 + 1e-5 * abs(b) AS apart, abs(a - (a + 1e-9)) <= 1e-8 + 1e-5 * abs(a + 1e-9) AS beside, abs(a * 1.00002 - a) <= 1e-8 + 1e-5 * abs(a) AS relative FROM s""")
def close_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The tie predicate of the selection: absolute and relative closeness."""
    first = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double"), 4)
    s = table(spark, folder, "embeddings").select("vec_id", first(0).alias("a"), first(1).alias("b"))
    a, b = F.col("a"), F.col("b")
    return s.select("vec_id", vx.close(a, b).alias("apart"), vx.close(a, a + 1e-9).alias("beside"), vx.close(a * 1.00002, a).alias("relative"))
