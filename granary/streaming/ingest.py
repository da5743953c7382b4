"""Docs as a stream. Validation, chunking and selection work row by row and run unchanged on a stream; a repeated id is
dropped within a watermark. Unlike the batch build, a stream keeps the row that arrives first, not the first line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import clean_items, strip
from ..operators.chunking import Chunker
from ..operators.rules import Rule, good, judged
from ..plans.embedding import doc_candidates


def stream_parquet(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def validated_docs(docs: DataFrame, delay: str, event_time: str = "loaded_at") -> DataFrame:
    """(doc_id, doc_text, event time) of a stream of docs: rows with an id and a text, each id once within the delay, for which
    its ids are kept as state."""
    rows = docs.select(F.coalesce(strip("doc_id"), F.lit("")).alias("doc_id"), clean_items("doc_text").alias("doc_text"), event_time)
    rules = [Rule("missing_doc_id", F.col("doc_id") == ""), Rule("empty_doc_text", F.size("doc_text") == 0)]
    return good(judged(rows, rules)).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["doc_id"])


def candidate_stream(docs: DataFrame, delay: str, chunker: Chunker = Chunker()) -> DataFrame:
    return doc_candidates(validated_docs(docs, delay), chunker)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what the source has by now as Parquet and stops; a restart goes on from the checkpoint."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
