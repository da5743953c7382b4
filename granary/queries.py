"""The core's queries and, where SQL can say the same, their DuckDB text. Each query takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import parse_failures
from .runtime import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Stripped code points, as DuckDB writes them.
SQL_WHITE = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
_FIELD = '("(?:[^"]|"")*"|[^",\\r\\n]*)'

SQL_P3 = f"""
WITH w AS (SELECT {SQL_WHITE} AS ws),
raw AS (SELECT line_id, lower(trim(layout, ws)) AS layout, line, ws FROM corpus_lines, w WHERE trim(coalesce(line, ''), ws) <> ''),
csv AS (SELECT line_id, regexp_extract(line, '^{_FIELD},{_FIELD},{_FIELD}\\z', ['a', 'b', 'c']) AS f, regexp_matches(line, '^{_FIELD},{_FIELD},{_FIELD}\\z') AS ok, ws FROM raw WHERE layout = 'csv'),
js AS (SELECT line_id, ws, CASE WHEN json_valid(line) AND NOT regexp_matches(regexp_replace(line, '"(?:[^"\\\\]|\\\\.)*"', '""', 'g'), ',\\s*[}}\\]]') THEN line::JSON END AS j FROM raw WHERE layout = 'jsonl'),
good AS (
  SELECT line_id FROM csv WHERE ok AND trim(f.a, ws || '"') <> '' AND trim(f.c, ws || '"') <> ''
  UNION ALL
  SELECT line_id FROM raw WHERE layout = 'tsv' AND strpos(line, chr(9)) > 0
    AND trim(substr(line, 1, strpos(line, chr(9)) - 1), ws) <> '' AND trim(substr(line, strpos(line, chr(9)) + 1), ws) <> ''
  UNION ALL
  SELECT line_id FROM js WHERE j IS NOT NULL AND json_type(j) = 'OBJECT'
    AND (json_type(j, '$.doc_id') IN ('UBIGINT', 'BIGINT', 'HUGEINT') OR (json_type(j, '$.doc_id') = 'VARCHAR' AND trim(j->>'$.doc_id', ws) <> ''))
    AND json_type(j, '$.abstract') = 'ARRAY'
    AND len(list_filter(json_extract(j, '$.abstract[*]'), lambda x: json_type(x) NOT IN ('VARCHAR', 'NULL'))) = 0
    AND len(list_filter(json_extract_string(j, '$.abstract[*]'), lambda x: trim(coalesce(x, ''), ws) <> '')) > 0
)
"""
SQL_P3_FOUND = SQL_P3 + "SELECT line_id FROM raw WHERE line_id NOT IN (SELECT line_id FROM good)"
_QUOTED = '"(?:[^"]|"")*"'
_N = f"^(?:{_QUOTED}|[^\",\\r\\n]*)(?:,(?:{_QUOTED}|[^\",\\r\\n]*))*\\z"
SQL_P3_REASONS = (
    SQL_P3
    + f"""
SELECT layout, CASE layout
  WHEN 'csv' THEN CASE WHEN NOT regexp_matches(line, '{_N}') THEN 'broken_quoting' WHEN NOT (SELECT ok FROM csv c WHERE c.line_id = raw.line_id) THEN 'wrong_column_count' WHEN trim((SELECT f.a FROM csv c WHERE c.line_id = raw.line_id), ws || '"') = '' THEN 'blank_doc_id' ELSE 'blank_abstract' END
  WHEN 'tsv' THEN CASE WHEN strpos(line, chr(9)) = 0 THEN 'wrong_column_count' WHEN trim(substr(line, 1, strpos(line, chr(9)) - 1), ws) = '' THEN 'blank_doc_id' ELSE 'blank_text' END
  WHEN 'jsonl' THEN (SELECT CASE WHEN j IS NULL THEN 'invalid_json' WHEN json_type(j) <> 'OBJECT' THEN 'not_an_object' WHEN json_type(j, '$.doc_id') IS NULL OR json_type(j, '$.doc_id') = 'NULL' THEN 'missing_doc_id'
    WHEN json_type(j, '$.doc_id') NOT IN ('UBIGINT', 'BIGINT', 'HUGEINT', 'VARCHAR') THEN 'invalid_doc_id' WHEN trim(j->>'$.doc_id', js.ws) = '' THEN 'blank_doc_id' WHEN json_type(j, '$.abstract') IS NULL OR json_type(j, '$.abstract') <> 'ARRAY' THEN 'invalid_abstract'
    WHEN len(list_filter(json_extract(j, '$.abstract[*]'), lambda x: json_type(x) NOT IN ('VARCHAR', 'NULL'))) > 0 THEN 'invalid_abstract_item' ELSE 'blank_abstract' END FROM js WHERE js.line_id = raw.line_id)
  ELSE 'unknown_layout' END AS reason, count(*) AS failed_lines FROM raw WHERE line_id NOT IN (SELECT line_id FROM good) GROUP BY 1, 2"""
)


@query(SQL_P3_FOUND)
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return parse_failures.failed_lines(table(spark, folder, "corpus_lines")).select("line_id")


@query(SQL_P3_REASONS)
def p3_reasons(spark: SparkSession, folder: str) -> DataFrame:
    failed = parse_failures.failed_lines(table(spark, folder, "corpus_lines"))
    return failed.groupBy("layout", "reason").agg(F.count(F.lit(1)).alias("failed_lines"))


_UNQUOTED = "CASE WHEN {0} LIKE '\"%' THEN replace(substr({0}, 2, length({0}) - 2), '\"\"', '\"') ELSE {0} END"
SQL_P3_LOADED = (
    SQL_P3
    + f"""SELECT file, line_num, line_id, 'csv' AS layout, trim({_UNQUOTED.format("f.a")}, csv.ws) AS doc_id, {_UNQUOTED.format("f.b")} AS title, {_UNQUOTED.format("f.c")} AS texts FROM csv JOIN corpus_lines USING (line_id) WHERE line_id IN (FROM good)
UNION ALL SELECT file, line_num, line_id, 'tsv', trim(substr(r.line, 1, strpos(r.line, chr(9)) - 1), ws), NULL, substr(r.line, strpos(r.line, chr(9)) + 1) FROM raw r JOIN corpus_lines USING (line_id) WHERE r.layout = 'tsv' AND line_id IN (FROM good)
UNION ALL SELECT file, line_num, line_id, 'jsonl', trim(j->>'$.doc_id', js.ws), CASE WHEN json_type(j, '$.title') = 'VARCHAR' THEN j->>'$.title' END, array_to_string(list_transform(json_extract_string(j, '$.abstract[*]'), lambda x: coalesce(x, '(null)')), '|') FROM js JOIN corpus_lines USING (line_id) WHERE line_id IN (FROM good)"""
)


@query(SQL_P3_LOADED)
def p3_loaded(spark: SparkSession, folder: str) -> DataFrame:
    loaded = parse_failures.strict_load(table(spark, folder, "corpus_lines")).drop("line_hash")
    return loaded.withColumn("texts", F.array_join("texts", "|", "(null)"))
