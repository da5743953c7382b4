"""The four collections as runnable builds: raw files in; docs, queries and judgments as JSON lines out, with a log of every
issue, a manifest of the dataset, and a printed report.

Each part is written once and read back as the reference of the next, so nothing is validated twice; counts come from what
was written. Every output is a folder of part files under the name that the manifest gives it."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GranaryError
from ..runtime import checkpointed
from ..sinks import tables as sinks
from ..sources import manifests
from ..sources.json_arrays import json_array_files
from ..sources.lines import numbered_lines
from ..sources.paragraphs import ORDER, read_paragraphs
from . import collections as co

log = logging.getLogger("granary")

SCHEMAS = {"docs": "doc_id string, title string, doc_text {}", "queries": "query_id string, query_text string", "qrels": "query_id string, doc_id string, relevance long"}
LOG = "file string, line_num long, issue_type string, action string, record_type string, record_id string, split string, detail string"


@dataclass
class Build:
    """What a build has written so far."""

    spark: SparkSession
    out: str
    say: Callable[[str], None] = print
    issues: list[str] = field(default_factory=list)
    counts: dict[tuple[str | None, str], tuple[int, int]] = field(default_factory=dict)

    def path(self, part: str, split: str | None) -> str:
        return f"{self.out}/{split}/{part}.jsonl" if split else f"{self.out}/{part}.jsonl"

    def add(self, part: str, checked: co.Checked, split: str | None = None, skips: DataFrame | None = None, notes: DataFrame | None = None, listed: bool = False) -> DataFrame:
        """Writes a part and its issues. skips: issues that count as skipped besides those of its rows; notes: issues that
        skip nothing. Gives the part as written."""
        at, here = self.path(part, split), f"{self.out}/issues/{split or 'all'}-{part}"
        sinks.write_json_lines(checked.accepted, at)
        skipped = checked.issues if skips is None else checked.issues.unionByName(skips)
        marked = skipped.withColumn("counted", F.lit(True))
        if notes is not None:
            marked = marked.unionByName(notes.withColumn("counted", F.lit(False)))
        sinks.write_json_lines(marked, here)
        self.issues.append(here)
        written = self.spark.read.schema(SCHEMAS[part].format("array<string>" if listed else "string")).json(at)
        lost = self.spark.read.schema(f"{LOG}, counted boolean").json(here).where("counted").count()
        self.counts[split, part] = (written.count(), lost)
        return written

    def split_stats(self, split: str, queries: DataFrame, qrels: DataFrame, docs: bool = False) -> dict[str, int]:
        n = lambda part: self.counts[split, part]
        out = {"query_count": n("queries")[0], "qrels_count": n("qrels")[0], "positive_query_count": qrels.select("query_id").distinct().count(),
               "orphan_query_count": co.orphans(queries, qrels).count(), "skipped_query_count": n("queries")[1], "skipped_qrels_count": n("qrels")[1]}
        return {"doc_count": n("docs")[0]} | out | {"skipped_doc_count": n("docs")[1]} if docs else out

    def doc_stats(self) -> dict[str, int]:
        written, skipped = self.counts[None, "docs"]
        return {"doc_count": written, "skipped_count": skipped}

    def finish(self, name: str, stats: dict[str, dict[str, int]], **about) -> dict[str, dict[str, int]]:
        """Writes the manifest and the log of all issues, and prints the report."""
        splits = tuple(s for s in stats if s not in ("docs", "overall"))
        sinks.write_manifest(f"{self.out}/dataset.json", sinks.manifest(name, stats, splits, **about))
        issues = reduce(DataFrame.unionByName, [self.spark.read.schema(LOG).json(p) for p in self.issues])
        summary = sinks.write_build_log(f"{self.out}/build_log.json", issues, stats)
        self.say(sinks.report(stats, summary))
        return stats


# Fixed values below: the file names of the deliveries, and the names and tasks of their datasets.


def tab_separated(spark: SparkSession, root: str, out: str, say: Callable[[str], None] = print) -> dict[str, dict[str, int]]:
    lines = lambda name: numbered_lines(spark, f"{root}/{name}")
    splits = ("train", "dev")
    manifests.require(f"{root}/collection.tsv", *[f"{root}/{part}.{s}.tsv" for part in ("queries", "qrels") for s in splits])
    b = Build(spark, out, say)
    docs = b.add("docs", co.tsv_docs(lines("collection.tsv")))
    stats = {"docs": b.doc_stats()}
    for s in splits:
        queries = b.add("queries", co.tsv_queries(lines(f"queries.{s}.tsv"), s), s)
        qrels = b.add("qrels", co.tsv_qrels(lines(f"qrels.{s}.tsv"), queries, docs, s), s)
        stats[s] = b.split_stats(s, queries, qrels)
    return b.finish("msmarco", stats)


def claims(spark: SparkSession, root: str, out: str, corpus: str = "corpus.jsonl", train: str = "claims_train.jsonl", dev: str = "claims_dev.jsonl", say: Callable[[str], None] = print) -> dict[str, dict[str, int]]:
    given = {"train": f"{root}/{train}", "dev": f"{root}/{dev}"}
    manifests.require(f"{root}/{corpus}", *given.values())
    b = Build(spark, out, say)
    docs = b.add("docs", co.json_docs(numbered_lines(spark, f"{root}/{corpus}")), listed=True)
    stats = {"docs": b.doc_stats()}
    for s, path in given.items():
        queries = b.add("queries", co.json_queries(numbered_lines(spark, path), s), s)
        checked, whole = co.evidence_qrels(numbered_lines(spark, path), queries, docs, s)
        stats[s] = b.split_stats(s, queries, b.add("qrels", checked, s, skips=whole))
    return b.finish("scifact", stats, domain="scientific", task="scientific_doc_retrieval")


def nested_samples(spark: SparkSession, root: str, out: str, train: str = "hotpot_train_v1.1.json", dev: str = "hotpot_dev_distractor_v1.json", say: Callable[[str], None] = print) -> dict[str, dict[str, int]]:
    given = {"train": f"{root}/{train}", "dev": f"{root}/{dev}"}
    manifests.require(*given.values())
    b = Build(spark, out, say)
    stats: dict[str, dict[str, int]] = {}
    for s, path in given.items():
        samples, broken = json_array_files(spark, path)
        null = F.lit(None).cast("string")
        files = broken.select("file", F.lit(None).cast("long").alias("line_num"), "issue_type", F.lit("skip").alias("action"), F.lit("query").alias("record_type"), null.alias("record_id"), F.lit(s).alias("split"), "detail")
        hops = co.multi_hop(samples, s, keep=checkpointed)
        queries = b.add("queries", hops.queries, s, notes=files)
        b.add("docs", hops.docs, s, notes=hops.notes, listed=True)
        stats[s] = b.split_stats(s, queries, b.add("qrels", hops.qrels, s), docs=True)
    stats["overall"] = {k: sum(stats[s][k] for s in given) for k in stats["train"]}
    return b.finish("hotpotqa", stats, docs_per_split=True, subset="distractor")


def paragraphs(
    spark: SparkSession, root: str, out: str, decoder: str, outline_decoder: str | None = None, docs: str = "base.train.cbor-paragraphs.cbor",
    outlines: str = "base.train.cbor-outlines.cbor", qrels: str = "base.train.cbor-article.qrels", say: Callable[[str], None] = print,
) -> dict[str, dict[str, int]]:
    """decoder, outline_decoder: importable functions that yield the objects of an open file (sources.paragraphs)."""
    manifests.require(*[f"{root}/{name}" for name in (docs, outlines, qrels)])
    b = Build(spark, out, say)
    known = b.add("docs", co.paragraph_docs(read_paragraphs(spark, f"{root}/{docs}", decoder), ORDER))
    queries = b.add("queries", co.outline_queries(read_paragraphs(spark, f"{root}/{outlines}", outline_decoder or decoder), "train", ORDER), "train")
    judged = b.add("qrels", co.spaced_qrels(numbered_lines(spark, f"{root}/{qrels}"), queries, known, "train"), "train")
    stats = {"docs": b.doc_stats(), "train": b.split_stats("train", queries, judged)}
    return b.finish("trec_car", stats, subset="article", task="article_paragraph_retrieval")


LAYOUTS: dict[str, Callable[..., dict]] = {"tab-separated": tab_separated, "claims": claims, "nested-samples": nested_samples, "paragraphs": paragraphs}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """granary-build LAYOUT --input FOLDER --output FOLDER [--set name=value ...]; 0, or 1 after logging what went wrong."""
    parser = argparse.ArgumentParser(prog="granary-build", description="Validates a raw collection and writes it as a dataset.")
    parser.add_argument("layout", choices=sorted(LAYOUTS))
    parser.add_argument("--input", default=".", help="folder of the raw files")
    parser.add_argument("--output", required=True, help="folder of the dataset")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a file name of the layout, or decoder")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    try:
        LAYOUTS[given.layout](spark or SparkSession.builder.appName("granary-build").getOrCreate(), given.input, given.output, **dict(x.split("=", 1) for x in given.set))
        return 0
    except (GranaryError, FileNotFoundError, TypeError, ValueError) as e:
        log.error("%s", e)
    except Exception:
        log.exception("the build failed")
    return 1


def cli() -> None:
    raise SystemExit(main())
