"""Documents to selected, encoded chunks; queries to vectors. Narrow plans: neither shuffles."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Model, ProcessingError, Settings
from ..functions.text import chunk_id, clean_items, prepared, strip
from ..operators.chunking import Chunker, chunk_candidates, segmenter
from ..operators.encoders import Factory, encode_lists, encode_texts, factory_for, model_cache
from ..operators.selection import representatives
from ..sinks import tables as sinks
from ..sources import json_records as js
from ..sources import manifests
from ..sources.lines import numbered_lines

log = logging.getLogger("granary")


def required(name: str, c: Column) -> Column:
    """c; the query fails on a row without it."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.raise_error(F.lit(f"a row without {name}")).cast("string")).otherwise(c)


def docs_of_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, doc_text array): of JSON objects whose doc_text is a text or a list; a missing id and an empty text fail the
    run. A null id is the text None, as the format's other readers have it."""
    v = F.col("v")
    own, text = js.member(v, "doc_id"), js.member(v, "doc_text")
    kind = js.python_type(text)
    parts = F.when(kind == "str", F.array(strip(F.try_variant_get(text, "$", "string")))).when(kind == "list", F.transform(F.try_variant_get(text, "$", "array<variant>"), js.as_text))
    doc_id = F.when(own.isNotNull() & (js.python_type(own) == "NoneType"), "None").otherwise(js.as_text(own))
    rows = js.json_objects(lines).select(required("doc_id", doc_id).alias("doc_id"), clean_items(parts).alias("doc_text"))
    return rows.withColumn("doc_text", F.when(F.size("doc_text") == 0, F.raise_error(F.lit("a row without doc_text")).cast("array<string>")).otherwise(F.col("doc_text")))


def queries_of_lines(lines: DataFrame) -> DataFrame:
    """(query_id, query_text): of JSON objects; a missing one fails the run."""
    v = F.col("v")
    return js.json_objects(lines).select(*[required(n, js.as_text(js.member(v, n))).alias(n) for n in ("query_id", "query_text")])


def doc_candidates(docs: DataFrame, chunker: Chunker = Chunker()) -> DataFrame:
    """(doc_id, candidate_count, candidates) of docs (doc_id, doc_text array)."""
    return docs.select("doc_id", chunk_candidates("doc_text", chunker).alias("candidates")).select("doc_id", F.size("candidates").alias("candidate_count"), "candidates")


def selected_chunks(rows: DataFrame, top_n: int = 3, weight: float = 0.7, dim: int | None = None) -> DataFrame:
    """The chosen chunks of rows (doc_id, candidates, vectors): centroid scores and MMR within the row. Rows with the same
    doc_id stay apart; a row whose candidates and vectors differ in number fails the run; none gives none."""
    count = F.when(F.size("candidates") != F.size("vectors"), F.raise_error(F.lit("vectors don't match candidate count")).cast("array<array<double>>")).otherwise(F.col("vectors"))
    some = rows.where(F.size("candidates") > 0).select("doc_id", "candidates", F.size("candidates").alias("total"), count.alias("vectors"))
    chosen = some.withColumn("chosen", representatives(top_n, weight, dim)("vectors"))
    picked = chosen.select("doc_id", "candidates", "total", F.inline("chosen"))
    own = F.get("candidates", F.col("index"))
    return picked.select(
        "doc_id", chunk_id(F.col("doc_id"), own["order"], F.col("total")).alias("chunk_id"), own["text"].alias("chunk_text"),
        F.col("vector").alias("chunk_vector"), F.col("score").alias("chunk_score"), F.col("rank").cast("long").alias("chunk_rank"),
    )


def embed_docs(candidates: DataFrame, name: str, factory: Factory, model: Model) -> DataFrame:
    e = model.experiment
    texts = F.transform("candidates", lambda c: prepared(c["text"], e.doc_prefix, e.instruction_template))
    return selected_chunks(candidates.withColumn("vectors", encode_lists(name, factory, e.embedding_dim)(texts)), dim=e.embedding_dim)


def embed_queries(queries: DataFrame, name: str, factory: Factory, model: Model) -> DataFrame:
    e = model.experiment
    text = prepared(F.col("query_text"), e.query_prefix, e.instruction_template)
    return queries.select("query_id", "query_text", encode_texts(name, factory, e.embedding_dim, True)(text).alias("query_embedding"))


def in_cache(factory: Factory, variables: dict[str, str]) -> Factory:
    """factory, run with the cache's environment variables where a worker hasn't set them."""

    def made():
        for name, value in variables.items():
            os.environ.setdefault(name, value)
        return factory()

    return made


def run(spark: SparkSession, dataset_root: str, settings: Settings, out: str, work: str, make: object = factory_for, shard_rows: int = 100_000) -> None:
    """Each model over each dataset, models first. A dataset's candidates are written once for each size limit and reused;
    a run without any chunk fails before it writes. Executors get the driver's model cache folders where they have none."""
    cached = model_cache()[1]
    ready: dict[tuple[str, int], DataFrame] = {}
    for model in settings.models:
        factory = in_cache(make(model, model.inference, model.experiment.embedding_dim, model.experiment.max_length), cached)
        for name in settings.datasets:
            data = manifests.dataset(dataset_root, name)
            key = (name, model.experiment.max_length)
            if key not in ready:
                path = f"{work}/{name}-{model.experiment.max_length}"
                docs = docs_of_lines(numbered_lines(spark, data.docs))
                doc_candidates(docs, Chunker(hard=model.experiment.max_length, segment=segmenter())).write.mode("overwrite").parquet(path)
                ready[key] = spark.read.parquet(path)
            if ready[key].where("candidate_count > 0").limit(1).count() == 0:
                raise ProcessingError(f"{name} has no chunks")
            base = sinks.output_path(out, model.model_id, name)
            dim = model.experiment.embedding_dim
            sinks.write_shards(embed_docs(ready[key], model.model_id, factory, model), sinks.doc_table(base, dim), sinks.DOC_COLUMNS, shard_rows)
            sinks.write_shards(embed_queries(queries_of_lines(numbered_lines(spark, data.queries)), model.model_id, factory, model), sinks.query_table(base, dim), sinks.QUERY_COLUMNS, shard_rows)
            log.info("%s over %s: done", model.model_id, name)


def main(spark: SparkSession, dataset_root: str, settings_file: str, out: str, work: str) -> int:
    """0, or 1 after logging what went wrong."""
    from ..config import GranaryError, load
    from ..operators.encoders import EncoderError

    try:
        manifests.require_inputs(dataset_root, settings_file)
        run(spark, dataset_root, load(settings_file), out, work)
        return 0
    except (GranaryError, EncoderError) as e:
        log.error("%s", e)
    except Exception:
        log.exception("the run failed")
    return 1


def cli() -> None:
    """granary-embed --datasets FOLDER --settings FILE --output FOLDER --work FOLDER; exits with 0 or 1."""
    parser = argparse.ArgumentParser(prog="granary-embed", description="Encodes datasets: selected chunks of their documents, and their queries.")
    for name, text in (("datasets", "folder of the datasets"), ("settings", "YAML or JSON file of models"), ("output", "folder of the tables"), ("work", "shared folder of the candidates")):
        parser.add_argument(f"--{name}", required=True, help=text)
    given = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    raise SystemExit(main(SparkSession.builder.appName("granary-embed").getOrCreate(), given.datasets, given.settings, given.output, given.work))
