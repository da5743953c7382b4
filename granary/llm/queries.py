"""The queries of the training-data operators and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..queries import SQL_WHITE, Query, table
from .encoding import encode_corpus
from .mixing import Mix
from .near_duplicates import NearDuplicates
from .neighbours import Neighbours, similar_pairs
from .segments import items_of, split_oversized
from .split_overlaps import SplitOverlaps
from .subjects import Subjects
from .token_budget import texts_of_docs, texts_of_queries, token_budget

QUERIES: dict[str, Query] = {}
#: Where the tokenizer files lie on the driver and on every executor; the operators take paths.
TOKENIZERS = os.environ.get("GRANARY_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


#: Each doc once, by its first delivery with a text.
SQL_DOC_TEXTS = f"""
w AS (SELECT {SQL_WHITE} AS ws),
delivered AS (SELECT doc_id, loaded_at, array_to_string(list_filter(list_transform(coalesce(doc_text, []), lambda x: trim(x, ws)), lambda x: x IS NOT NULL AND x <> ''), ' ') AS text FROM docs, w WHERE doc_id IS NOT NULL),
doc_texts AS (SELECT doc_id, text FROM delivered QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY text = '', loaded_at IS NULL, loaded_at, text) = 1)
"""

def sql_alike(n: int, least: float) -> str:
    """CTEs up to alike (a, b, likeness), a < b, over the n-word sequences of docs."""
    return f"""{SQL_DOC_TEXTS},
spelt AS (SELECT doc_id, regexp_extract_all(lower(text), '[一-鿿]|[\\p{{L}}\\p{{N}}]+') AS rough FROM doc_texts),
worded AS (SELECT doc_id, flatten(list_transform(rough, lambda r: regexp_extract_all(regexp_replace(r, '([一-鿿])', ' \\1 ', 'g'), '[^ ]+'))) AS ws FROM spelt),
grams AS (SELECT DISTINCT doc_id, ws[i:i+{n - 1}] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM worded)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
alike AS (SELECT a, b, c / (x.n + y.n - c) AS likeness FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE c / (x.n + y.n - c) >= {least})"""


SQL_P1 = f"WITH {sql_alike(3, 0.6)} SELECT a AS doc_id_a, b AS doc_id_b FROM alike"

SQL_P1_GROUPS = f"""WITH RECURSIVE {sql_alike(5, 0.8)},
short AS (SELECT doc_id, ws FROM worded WHERE len(ws) BETWEEN 1 AND 4),
linked AS (FROM alike UNION ALL SELECT a.doc_id, b.doc_id, 1.0 FROM short a JOIN short b ON a.ws = b.ws AND a.doc_id < b.doc_id),
both_ways AS (SELECT a, b, likeness FROM linked UNION ALL SELECT b, a, likeness FROM linked),
reach AS (SELECT DISTINCT a, a AS b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON w.a = r.b),
roots AS (SELECT a AS doc_id, min(b) AS group_id FROM reach GROUP BY 1),
same AS (SELECT a, count(*) FILTER (likeness = 1) + 1 AS copies, least(a, coalesce(min(b) FILTER (likeness = 1), a)) AS class FROM both_ways GROUP BY 1)
SELECT d.doc_id, coalesce(group_id, d.doc_id) AS group_id, coalesce(copies, 1) AS copies, (SELECT count(DISTINCT c.class) FROM both_ways w JOIN same c ON c.a = w.b WHERE w.a = d.doc_id AND w.likeness < 1) AS links
FROM doc_texts d LEFT JOIN roots USING (doc_id) LEFT JOIN same ON a = d.doc_id"""


@query(SQL_P1)
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return NearDuplicates(n=3, threshold=0.6).pairs(table(spark, folder, "docs"))


@query(SQL_P1_GROUPS)
def p1_groups(spark: SparkSession, folder: str) -> DataFrame:
    return NearDuplicates().groups(table(spark, folder, "docs"))


@query()
def p2_token_budget(spark: SparkSession, folder: str) -> DataFrame:
    texts = texts_of_docs(table(spark, folder, "docs")).unionByName(texts_of_queries(table(spark, folder, "queries")))
    return token_budget(texts, ["kind", "source", "lang", "domain"], BYTE_BPE)


SQL_P2_TEXTS = f"""WITH {SQL_DOC_TEXTS},
own AS (
  SELECT 'doc' AS kind, doc_id AS id, loaded_at, array_to_string(list_filter(list_transform(coalesce(doc_text, []), lambda x: trim(x, ws)), lambda x: x IS NOT NULL AND x <> ''), ' ') AS text, source, lang, domain, ws FROM docs, w WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'query', query_id, loaded_at, trim(query_text, ws), source, lang, domain, ws FROM queries, w WHERE query_id IS NOT NULL),
o AS (SELECT kind, id, loaded_at, text, nullif(lower(trim(source, ws)), '') AS source, nullif(lower(trim(lang, ws)), '') AS lang, nullif(lower(trim(domain, ws)), '') AS domain FROM own),
f AS (SELECT kind, id, arg_min(text, (coalesce(text, '') = '', loaded_at IS NULL, loaded_at, text)) AS text,
  arg_min(source, (loaded_at IS NULL, loaded_at, source)) FILTER (source IS NOT NULL) AS source, arg_min(lang, (loaded_at IS NULL, loaded_at, lang)) FILTER (lang IS NOT NULL) AS lang, arg_min(domain, (loaded_at IS NULL, loaded_at, domain)) FILTER (domain IS NOT NULL) AS domain FROM o GROUP BY 1, 2)
SELECT kind, source, lang, domain, count(*) AS texts, sum(coalesce(length(text), 0))::BIGINT AS chars FROM f GROUP BY 1, 2, 3, 4"""


@query(SQL_P2_TEXTS)
def p2_texts(spark: SparkSession, folder: str) -> DataFrame:
    return p2_token_budget(spark, folder).drop("tokens")


@query()
def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"), BYTE_BPE)


SQL_P4 = """
WITH v AS (
  SELECT DISTINCT query_id, query_embedding::DOUBLE[] AS e FROM query_vectors
  WHERE query_id IS NOT NULL AND len(query_embedding) = 128
    AND len(list_filter(query_embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(query_embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT a.query_id AS a, b.query_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.query_id <> b.query_id
  QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY c DESC, b.query_id) <= 5)
SELECT DISTINCT least(a, b) AS query_id_a, greatest(a, b) AS query_id_b FROM near WHERE c >= 0.85
"""


@query(SQL_P4)
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return similar_pairs(table(spark, folder, "query_vectors"), "query_id", "query_embedding", 0.85).toDF("query_id_a", "query_id_b")


@query()
def p4_recall(spark: SparkSession, folder: str) -> DataFrame:
    how = Neighbours()
    told = how.measured(how.classes(table(spark, folder, "query_vectors"), "query_id", "query_embedding")[1])
    return spark.createDataFrame([(how.k, *told)], "k int, leaves int, visited int, recall_of_choosing_probes double, recall double")


@query()
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return Subjects().found(table(spark, folder, "documents"), table(spark, folder, "subject_examples"))


@query()
def p9_composition(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    judged = Subjects().judge(documents, table(spark, folder, "subject_examples")).select("doc_id", "sentences", F.inline("mixture"))
    return judged.groupBy("subject").agg(
        F.count_if(F.col("share") >= 0.25).alias("documents"),
        F.round(F.sum(F.col("weight") * F.col("sentences")), 3).alias("sentence_mass"),
        F.sum(F.round(F.col("share") * F.col("sentences")).cast("long")).alias("sentences"),
    )


SQL_RECORDS = f"""{SQL_WHITE} AS ws),
q AS (SELECT query_id, loaded_at, trim(query_text, ws) AS text, nullif(lower(trim(split, ws)), '') AS split, nullif(lower(trim(source, ws)), '') AS source FROM queries, w WHERE query_id IS NOT NULL),
t AS (SELECT query_id, text FROM q QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY coalesce(text, '') = '', loaded_at IS NULL, loaded_at, text) = 1),
s AS (SELECT query_id, split FROM q WHERE split IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY loaded_at IS NULL, loaded_at, split) = 1),
o AS (SELECT query_id, source FROM q WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY loaded_at IS NULL, loaded_at, source) = 1),
r AS (SELECT query_id, split, source, trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS text FROM t JOIN s USING (query_id) LEFT JOIN o USING (query_id) WHERE split IN ('train', 'dev', 'test')),
g AS (SELECT DISTINCT query_id, split = 'train' AS tr, substr(text, i, 3) AS g FROM (SELECT *, unnest(range(1, length(text) - 1)) AS i FROM r)),
n AS (SELECT query_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.query_id AS a, b.query_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.tr AND NOT b.tr GROUP BY 1, 2),
f AS (SELECT a, b FROM c JOIN n x ON x.query_id = a JOIN n y ON y.query_id = b WHERE c / (x.n + y.n - c) >= 0.75),
j AS (SELECT query_id FROM qrels, w WHERE query_id IS NOT NULL GROUP BY 1 HAVING bool_or(lower(trim(split, ws)) = 'train') AND bool_or(lower(trim(split, ws)) IN ('dev', 'test')))
"""
SQL_P5 = f"WITH w AS (SELECT {SQL_RECORDS} SELECT least(a, b) AS query_id_a, greatest(a, b) AS query_id_b FROM f UNION ALL SELECT query_id, query_id FROM j"
SQL_P5_COUNTS = f"""WITH w AS (SELECT {SQL_RECORDS},
e AS (SELECT r.*, EXISTS (SELECT 1 FROM r t WHERE t.split = 'train' AND t.text = r.text AND r.text <> '') AS same, query_id IN (SELECT b FROM f) AS alike FROM r WHERE split <> 'train')
SELECT split, source, count(*) AS queries, count(*) FILTER (same) AS exact, count(*) FILTER (alike AND NOT same) AS near, count(*) FILTER (query_id IN (FROM j)) AS judged_under_both FROM e GROUP BY 1, 2"""

SQL_P5_JUDGED = f"WITH w AS (SELECT {SQL_RECORDS} SELECT split, source, count(*) AS judged_under_both FROM j LEFT JOIN s USING (query_id) LEFT JOIN o USING (query_id) GROUP BY 1, 2"


@query(SQL_P5)
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    how = SplitOverlaps()
    both = how.judged_under_both(table(spark, folder, "qrels"))
    return how.pairs(table(spark, folder, "queries")).unionByName(both.select(F.col("query_id").alias("query_id_a"), F.col("query_id").alias("query_id_b")))


@query(SQL_P5_COUNTS)
def p5_counts(spark: SparkSession, folder: str) -> DataFrame:
    return SplitOverlaps().counts(table(spark, folder, "queries"), table(spark, folder, "qrels"))


SQL_P5_EXACT = f"""WITH w AS (SELECT {SQL_RECORDS} SELECT split, source, count(*) AS exact FROM r WHERE split <> 'train' AND text <> '' AND text IN (SELECT text FROM r WHERE split = 'train') GROUP BY 1, 2"""


@query(SQL_P5_EXACT)
def p5_exact(spark: SparkSession, folder: str) -> DataFrame:
    return SplitOverlaps().exact_counts(table(spark, folder, "queries"))


@query(SQL_P5_JUDGED)
def p5_judged(spark: SparkSession, folder: str) -> DataFrame:
    return SplitOverlaps().judged_counts(table(spark, folder, "queries"), table(spark, folder, "qrels"))


SQL_P6 = f"""
WITH {SQL_DOC_TEXTS},
items AS (SELECT 'doc' AS item_kind, doc_id, 0 AS cand_order, text FROM doc_texts
  UNION ALL SELECT 'candidate', doc_id, c."order", c."text" FROM (SELECT doc_id, unnest(candidates) AS c FROM doc_candidates)),
sized AS (SELECT *, len(regexp_replace(text, '[^一-鿿]', '', 'g')) AS cjk FROM items)
SELECT item_kind, doc_id, cand_order::INT AS cand_order FROM sized WHERE cjk + (length(text) - cjk) // 4 > 600
"""


@query(SQL_P6)
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    items = items_of(table(spark, folder, "docs"), table(spark, folder, "doc_candidates"))
    pieces = split_oversized(items, ["item_kind", "doc_id", "cand_order"])
    return pieces.where("piece = 1 and pieces > 1").select("item_kind", "doc_id", "cand_order")


@query()
def p6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    items = items_of(table(spark, folder, "docs"), table(spark, folder, "doc_candidates"))
    return split_oversized(items, ["item_kind", "doc_id", "cand_order"])


@query()
def p8_selection(spark: SparkSession, folder: str) -> DataFrame:
    return Mix(BYTE_BPE).select(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


@query()
def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return Mix(BYTE_BPE).report(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


@query()
def p8_capped_shares(spark: SparkSession, folder: str) -> DataFrame:
    """With as many tokens as the sources have, so that max_repeats binds and shares fall short."""
    return Mix(BYTE_BPE, total="all").report(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


SQL_P8_CHECKED = f"""
WITH w AS (SELECT {SQL_WHITE} AS ws),
t AS (SELECT lower(trim(source, ws)) AS source, arg_max(weight, (weight, max_repeats)) AS weight, arg_max(max_repeats, (weight, max_repeats)) AS max_repeats FROM mix_targets, w WHERE trim(source, ws) <> '' AND weight > 0 AND max_repeats > 0 GROUP BY 1),
d AS (SELECT DISTINCT lower(trim(source, ws)) AS source FROM documents, w WHERE trim(coalesce(text, ''), ws) <> ''),
a AS (SELECT t.source, weight, d.source IS NOT NULL AS has_texts FROM t LEFT JOIN d ON d.source = t.source)
SELECT source, CASE WHEN has_texts THEN round(weight / (SELECT sum(weight) FROM a WHERE has_texts), 6) ELSE 0.0 END AS wanted_share, true AS reached, true AS within_repeats FROM a"""


@query(SQL_P8_CHECKED)
def p8_checked(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the mix: each source's tokens reach its scaled weight of all, but for the longest texts drawn, and no
    text is passed more often than its source allows."""
    report, drawn = p8_shares(spark, folder), p8_selection(spark, folder).groupBy("source").agg(F.max("tokens").alias("longest"), F.max("passes").alias("passes"))
    each = report.join(drawn, "source", "left").na.fill(0)
    every = Window.partitionBy()  # a row a target
    scaled = F.when(F.col("available_tokens") > 0, F.col("weight")).otherwise(0.0)
    wanted = F.when(F.sum(scaled).over(every) > 0, scaled / F.sum(scaled).over(every)).otherwise(0.0)
    off = F.abs(F.col("drawn_tokens") - wanted * F.sum("drawn_tokens").over(every))
    return each.select("source", F.round(wanted, 6).alias("wanted_share"), (off <= F.sum("longest").over(every)).alias("reached"), (F.col("passes") <= F.col("max_repeats")).alias("within_repeats"))


SQL_P6_CHECKED = f"""
WITH {SQL_DOC_TEXTS},
items AS (SELECT 'doc' AS item_kind, text FROM doc_texts UNION ALL SELECT 'candidate', c."text" FROM (SELECT unnest(candidates) AS c FROM doc_candidates)),
sized AS (SELECT *, len(regexp_replace(text, '[^一-鿿]', '', 'g')) AS cjk FROM items WHERE text IS NOT NULL)
SELECT item_kind, count(*) AS items, count(*) FILTER (cjk + (length(text) - cjk) // 4 > 600) AS cut_items, sum(length(text))::BIGINT AS chars, true AS within_limit, true AS within_overlap, true AS in_sequence FROM sized GROUP BY 1"""


@query(SQL_P6_CHECKED)
def p6_checked(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the pieces: their bodies tile each text, none is beyond the limit or overlaps by too much."""
    tokens = lambda c: token_estimate(c)
    repeated = F.substring(F.col("text"), F.lit(1), F.col("body") - F.col("start"))
    told = p6_pieces(spark, folder).select("item_kind", "piece", "pieces", "start", "body", "end", tokens("text").alias("n"), tokens(repeated).alias("again"), F.char_length("text").alias("chars"))
    return told.groupBy("item_kind").agg(
        F.count_if(F.col("piece") == 1).alias("items"),
        F.count_if((F.col("piece") == 1) & (F.col("pieces") > 1)).alias("cut_items"),
        F.sum(F.col("end") - F.col("body")).cast("long").alias("chars"),
        F.bool_and(F.col("n") <= 600).alias("within_limit"),
        F.bool_and(F.col("again") <= 60).alias("within_overlap"),
        F.bool_and((F.col("start") <= F.col("body")) & (F.col("chars") == F.col("end") - F.col("start")) & ((F.col("piece") > 1) | (F.col("body") == 0))).alias("in_sequence"),
    )
