"""JSON lines, sharded Parquet, build logs and manifests. Spark's commit protocol leaves either the old output or the whole
new one; a failed run writes nothing half."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage

#: The columns of the output tables, in order.
DOC_COLUMNS = ("doc_id", "chunk_id", "chunk_text", "chunk_vector", "chunk_score", "chunk_rank")
QUERY_COLUMNS = ("query_id", "query_text", "query_embedding")


def write_json_lines(df: DataFrame, path: str) -> None:
    """A JSON object a row, null columns left out; replaces what is there."""
    df.write.mode("overwrite").json(path)


def write_shards(df: DataFrame, path: str, columns: tuple[str, ...], shard_rows: int = 100_000) -> None:
    """Parquet files of at most shard_rows rows; replaces what is there."""
    if shard_rows <= 0:
        raise ValueError("shard_rows must be positive")
    df.select(*columns).write.mode("overwrite").option("maxRecordsPerFile", shard_rows).parquet(path)


def with_call_shards(df: DataFrame, call: str, shard_calls: int) -> DataFrame:
    """df with `shard`: shards hold shard_calls write calls each, calls being numbered from 1, whatever their rows."""
    if shard_calls <= 0:
        raise ValueError("shard_calls must be positive")
    return df.withColumn("shard", F.floor((F.col(call) - 1) / shard_calls).cast("int"))


def write_call_shards(df: DataFrame, path: str, columns: tuple[str, ...], call: str, shard_calls: int) -> None:
    """One folder a shard of calls (with_call_shards); rows are sent to their shard's task by a range shuffle."""
    sharded = with_call_shards(df, call, shard_calls)
    sharded.repartitionByRange("shard").select(*columns, "shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def output_path(root: str, model_id: str, dataset: str) -> str:
    return f"{root}/{model_id.replace('/', '_')}/{dataset}"


def doc_table(root: str, dim: int) -> str:
    return f"{root}/docs_dim{dim}"


def query_table(root: str, dim: int) -> str:
    return f"{root}/queries_dim{dim}"


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False, indent=2)


def stats_tree(stats: DataFrame) -> dict[str, dict[str, int]]:
    """A (part, metric, value) table, which has a few rows a split, as nested dicts."""
    out: dict[str, dict[str, int]] = {}
    for r in stats.collect():
        out.setdefault(r.part, {})[r.metric] = r.value
    return out


def write_build_log(path: str | Path, issues: DataFrame, stats: dict, issue_folder: str | None = None) -> dict[str, int]:
    """Writes one JSON object {stats, error_summary, issue_logs} that lists every issue, however many; returns the summary. The
    issues come to the driver a partition at a time and go straight into the file. issue_folder gets them as JSON lines too,
    written by the executors, from which the log is then made."""
    if issue_folder:
        write_json_lines(issues, issue_folder)
        issues = issues.sparkSession.read.schema(issues.schema).json(issue_folder)
    summary = {r.issue_type: r["count"] for r in issues.groupBy("issue_type").count().orderBy("issue_type").collect()}
    place = [c for c in ("record_type", "split", "file", "line_num") if c in issues.columns]

    def parts() -> Iterator[str]:
        yield _json({"stats": stats, "error_summary": summary})[:-2] + ',\n  "issue_logs": ['
        between = "\n"
        for r in (issues.orderBy(*place) if place else issues).toLocalIterator():
            yield between + "    " + json.dumps({k: v for k, v in r.asDict().items() if v is not None}, ensure_ascii=False)
            between = ",\n"
        yield ("\n  " if between != "\n" else "") + "]\n}"

    storage.write_text(path, parts())
    return summary


def manifest(name: str, stats: dict, splits: tuple[str, ...], docs_per_split: bool = False, subset: str = "", domain: str = "general", version: str = "v1", task: str = "doc_retrieval") -> dict:
    # The keys of a manifest and the names of a dataset's files.
    own = ("docs", "queries", "qrels") if docs_per_split else ("queries", "qrels")
    files = {s: {f"{f}_file": f"{s}/{f}.jsonl" for f in own} for s in splits}
    shared = {} if docs_per_split else {"docs_file": "docs.jsonl"}
    meta = {"domain": domain, "language": "en", "source_dataset": name, "source_subset": subset, "version": version}
    return {"dataset_name": name, "version": version, "subset": subset, "task": task, **shared, "splits": files, "metadata": meta, "stats": stats}


def write_manifest(path: str | Path, value: dict) -> None:
    storage.write_text(path, [_json(value)])


def report(stats: dict, summary: dict) -> str:
    """The lines that a build prints."""
    lines = [f"{part}.{k} = {v}" for part, m in stats.items() for k, v in (m.items() if isinstance(m, dict) else [("", m)])]
    return "\n".join(lines + [f"issue {k}: {n}" for k, n in sorted(summary.items())])
