"""Text files as numbered lines.

The text source gives no row numbers. Lines are numbered within their split by a monotonically increasing id, taken
right at the scan; the line counts of the splits, one small row each, are summed up per file and joined back. Only those
counts are ever ordered, never the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip


#: Splits that a file's counts may have to be sent to all tasks: some 40 MB there, and 6 TB of text at 64 MB a split.
MOST_BLOCKS = 100_000


def numbered_lines(spark: SparkSession, path: str | list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """(file, line_num, line): every physical line, blank ones too, numbered from 1 in its file.

    The counts of the splits, a row each, are taken in a pass over the text. Up to most_blocks of them are sent to all tasks, so
    no line is shuffled; more are joined by a shuffle."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")
    )
    # Within a partition of the scan the id grows by one a line; a file's block is read by one partition, without a gap.
    sizes = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    starts = sizes.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    few = raw.rdd.getNumPartitions() + len(raw.inputFiles()) <= most_blocks
    return raw.join(F.broadcast(starts) if few else starts, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_num"), "line")


def not_blank(lines: DataFrame) -> DataFrame:
    return lines.where(~is_blank("line"))


def tsv_pair(lines: DataFrame) -> DataFrame:
    """lines with cells: the text before and after the first tab, or one cell if there is none."""
    return not_blank(lines).withColumn("cells", F.split(F.rtrim(F.col("line"), F.lit("\n")), "\t", 2))


def tsv_cells(lines: DataFrame) -> DataFrame:
    """lines with cells: all texts between tabs."""
    return not_blank(lines).withColumn("cells", F.split("line", "\t", -1))


def blank_separated(lines: DataFrame) -> DataFrame:
    """lines with cells: the texts between runs of white space."""
    return not_blank(lines).withColumn("cells", F.split(strip("line"), r"(?U)[\s\x1c-\x1f]+", -1))
