"""Session-level helpers: lineage cuts, parallelism of Python stages, skew-safe joins of a key with itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application, so that they need no path of the driver's."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='granary-code-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def slots(spark: SparkSession) -> int:
    """Partitions that a CPU-bound stage should have: never fewer than the cores, else as many as shuffles have."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


#: Logical operators whose execution shuffles, or may.
_SHUFFLING = {"Aggregate", "Join", "Window", "Sort", "Distinct", "Deduplicate", "Repartition", "RepartitionByExpression", "RebalancePartitions", "GlobalLimit", "Except", "Intersect", "FlatMapGroupsInArrow", "FlatMapGroupsInPandas"}


def _shuffles(plan) -> bool:
    """Whether a logical plan has a node of an operator that shuffles."""
    if plan.getClass().getSimpleName() in _SHUFFLING:
        return True
    children = plan.children()
    return any(_shuffles(children.apply(i)) for i in range(children.size()))


def widened(df: DataFrame) -> DataFrame:
    """df with enough partitions for a CPU-bound stage. What comes straight from a large scan has them and isn't shuffled; a
    small scan, which fits one or two splits, is spread. What comes from a shuffle is spread by a fixed number, as adaptive
    execution sizes its partitions by bytes; it isn't asked for its partitions, which would run it."""
    ship(df.sparkSession)
    if _shuffles(df._jdf.queryExecution().optimizedPlan()):
        return df.repartition(slots(df.sparkSession))
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def spread(df: DataFrame, *cols: str | Column) -> DataFrame:
    """df hashed by cols into a fixed number of partitions, which adaptive execution doesn't coalesce: bytes say
    little about the cost of a Python stage."""
    ship(df.sparkSession)
    return df.repartition(slots(df.sparkSession), *cols)


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables that all executors share: the session's spark.checkpoint.dir. A
    temporary one is used only where that is unset and Spark is local; on a cluster without the setting this raises, as a
    machine-local folder would not survive there."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="granary-checkpoint-")
            atexit.register(shutil.rmtree, folder, True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A new name in the shared folder, for tables that this application writes and reads back; removed when it ends."""
    from . import storage

    at = f"{shared_folder(spark)}/granary-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            storage.remove(at)
        except Exception:  # noqa: BLE001 - the session may be gone; what is left is in the shared folder
            pass

    atexit.register(remove)
    return at


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Plans made and run inside remove their shuffle files when they end; else these lie until the driver collects its
    garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder, so that a lost executor costs a read only. Spark deletes a
    checkpoint that nothing refers to any more if the session has spark.cleaner.referenceTracking.cleanCheckpoints."""
    ship(df.sparkSession)
    shared_folder(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, whose shuffles nothing else reads


@dataclass(frozen=True)
class Stored:
    """A table of which its maker knows when it is done with: compressed in the shared folder, removed by drop, at the latest
    when the application ends."""

    rows: DataFrame
    at: str

    def drop(self) -> None:
        from . import storage

        storage.remove(self.at)


def stored(df: DataFrame) -> Stored:
    """df, computed once, as compressed Parquet; for what doesn't outlive an operator. A result that is read later, by plans that
    haven't run yet, must be checkpointed."""
    spark = df.sparkSession
    ship(spark)
    at = scratch_folder(spark)
    with shuffles_removed(spark):
        df.select("*").write.option("compression", "zstd").parquet(at)
    return Stored(spark.read.schema(df.schema).parquet(at), at)


def with_blocks(df: DataFrame, key: str, block_rows: int, salt: str) -> DataFrame:
    """The rows of df whose key other rows share, with (_n, _b): the number of blocks of the key's rows and the row's
    block. A key of up to block_rows rows has one block; the rows of a hotter one are dealt to blocks of about that size
    by a hash of the salt column. Keys are counted before the shuffle; those of one row go no further."""
    shared = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    blocks = shared.select(F.col(key).alias("_shared"), F.ceil(F.col("_c") / block_rows).cast("int").alias("_n"))
    return df.join(blocks, F.col(key) == F.col("_shared")).drop("_shared").withColumn("_b", F.pmod(F.xxhash64(F.lit(17), salt), F.col("_n")).cast("int"))


def pairs_within_key(df: DataFrame, key: str, id_col: str, carry: list[str], on: Column | None = None, block_rows: int = 512) -> DataFrame:
    """Every pair a < b of different ids under the same key, as (id_a, id_b, carry_a..., carry_b...).

    A hot key's rows are cut into blocks and each pair of blocks is its own join key, so no task holds more than
    2 * block_rows rows of a key; no pair is lost. on: a further condition over columns `<carry>_a`, `<carry>_b`.
    An id given twice under a key gives its pairs more than once."""
    blocked = with_blocks(df.select(key, id_col, *carry), key, block_rows, id_col)
    upto = F.sequence(F.lit(0), F.col("_b"))
    since = F.sequence(F.col("_b"), F.col("_n") - 1)
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in (id_col, *carry)]
    left = blocked.select(F.col(key).alias("_k"), F.col("_b").alias("_i"), F.explode(since).alias("_j"), *side("a"))
    right = blocked.select(F.col(key).alias("_k"), F.explode(upto).alias("_i"), F.col("_b").alias("_j"), *side("b"))
    a, b = F.col(f"{id_col}_a"), F.col(f"{id_col}_b")
    joined = left.join(right, ["_k", "_i", "_j"]).where(F.when(F.col("_i") == F.col("_j"), a < b).otherwise(a != b))
    if on is not None:
        joined = joined.where(on)
    turned = a > b
    pick = lambda c, s, o: F.when(turned, F.col(f"{c}_{o}")).otherwise(F.col(f"{c}_{s}")).alias(f"{c}_{s}")
    return joined.select(*[pick(c, "a", "b") for c in (id_col, *carry)], *[pick(c, "b", "a") for c in (id_col, *carry)])


def pairs_across(left: DataFrame, right: DataFrame, key: str, id_col: str, block_rows: int = 512) -> DataFrame:
    """Every (id of left, id of right) under the same key, as (id_a, id_b).

    Keys that only one side has are dropped before the join. Where a side has more than block_rows rows of a key they
    are cut into blocks, and each pair of blocks is its own join key; no pair is lost."""
    counted = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(right.select(key, F.lit(0), F.lit(1)))
    sizes = counted.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r")).where("l > 0 and r > 0")
    blocks = sizes.select(F.col(key).alias("_k"), *[F.ceil(F.col(c) / block_rows).cast("int").alias(f"_{c}") for c in ("l", "r")])
    own = lambda n: F.pmod(F.xxhash64(F.lit(17), F.col(id_col)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.select(key, id_col).join(blocks, F.col(key) == F.col("_k")).select("_k", own("_l").alias("_i"), every("_r").alias("_j"), F.col(id_col).alias(f"{id_col}_a"))
    b = right.select(key, id_col).join(blocks, F.col(key) == F.col("_k")).select("_k", every("_l").alias("_i"), own("_r").alias("_j"), F.col(id_col).alias(f"{id_col}_b"))
    return a.join(b, ["_k", "_i", "_j"]).select(f"{id_col}_a", f"{id_col}_b")
