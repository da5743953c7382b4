"""Records of evaluation splits that also occur, exactly or nearly, in the training split.

Two operators over canonical texts (lower case, runs of other characters than letters and digits one space, trimmed):

* ExactOverlaps, the method named: every record that isn't blank is hashed; evaluation hashes are joined with training hashes
  and the matches counted by split and source. Both sides are counted per hash before they are joined, so a text that a third
  of all records have is one row a split and source.
* NearOverlaps, for texts that aren't equal, which a hash of the record can't find: a canonical text has `bands` hashes of
  `rows` min-wise symbols of its character n-grams each; the evaluation hashes are joined with the training hashes, and what
  meets is checked exactly. Texts of likeness s share a hash with probability 1 - (1 - s ** rows) ** bands: 0.99985 at 0.75,
  more above. A row carries which of 128 bins hold an odd number of its n-grams; the bins in which two texts differ are at most
  the n-grams that only one of them has, so pairs beyond the likeness are refused where they meet, and none within it is. The
  hashes are joined round_bands at a time, or as many as make round_rows rows. (The index of near_duplicates was tried in its place: over questions, which are alike throughout, its shorter
  keys made 20 to 70 times as many pairs.)

SplitOverlaps puts both together with the ids that have judgments under both.

Defined cases: splits compare trimmed and in lower case, null ones don't count; texts without a letter or digit match nothing;
texts shorter than an n-gram have exact matches only; a record delivered again is one record (its first text, split and
source); null ids are left out; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical, label, strip
from ..operators.deliveries import first_delivery
from ..runtime import Stored, checkpointed, pairs_across, slots, stored
from .meetings import met_pairs
from .signatures import flat, fold, gram_hashes, min_hashes, similarity


@dataclass(frozen=True)
class Splits:
    train: str = "train"
    evaluation: tuple[str, ...] = ("dev", "test")

    def records(self, queries: DataFrame) -> DataFrame:
        """(query_id, split, source, text, h): each record of a known split once, its text canonical, with its hash of 128 bits
        (null without a letter or digit); checkpointed."""
        once = first_delivery(queries, "query_id", strip("query_text"), {"split": label("split"), "source": label("source")})
        known = once.where(F.col("split").isin(self.train, *self.evaluation)).select("query_id", "split", "source", F.explode(F.array(canonical("text"))).alias("text"))
        h = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(5), F.col("text")).alias("b"))
        return checkpointed(known.withColumn("h", F.when(F.col("text") != "", h)))

    def sides(self, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The evaluation and the training records that have a hash."""
        known = records.where(F.col("h").isNotNull())
        return known.where(F.col("split") != self.train), known.where(F.col("split") == self.train)


@dataclass(frozen=True)
class ExactOverlaps:
    splits: Splits = Splits()

    def matches(self, records: DataFrame) -> DataFrame:
        """(h, split, source, queries, trained): of each hash that both sides have, the evaluation records by split and source,
        and the training records."""
        evaluated, trained = self.splits.sides(records)
        left = evaluated.groupBy("h", "split", "source").agg(F.count(F.lit(1)).alias("queries"))
        right = trained.groupBy("h").agg(F.count(F.lit(1)).alias("trained"))
        return left.join(right, "h")

    def counts(self, records: DataFrame) -> DataFrame:
        """(split, source, exact): the evaluation records that have an equal training record."""
        return self.matches(records).groupBy("split", "source").agg(F.sum("queries").alias("exact"))

    def pairs(self, records: DataFrame) -> DataFrame:
        """(query_id_a, query_id_b): an evaluation record and an equal training record."""
        evaluated, trained = self.splits.sides(records)
        return pairs_across(evaluated, trained, "h", "query_id")


def across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of coded classes (4 * number + 1 if it trains + 2 if it evaluates): one of each side."""
    return ((a & 1) & (b >> 1 & 1) | (a >> 1 & 1) & (b & 1)).astype(bool)


def parities(values: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each run of values beginning at starts (none empty): which of 128 bins have an odd number of them, as two words."""
    mixed = values * np.uint64(0x9E3779B97F4A7C15)
    bit = np.uint64(1) << (mixed >> np.uint64(57) & np.uint64(63))
    low = (mixed >> np.uint64(63)).astype(bool)
    return [np.bitwise_xor.reduceat(np.where(own, bit, np.uint64(0)), starts).view(np.int64) for own in (low, ~low)]


@dataclass(frozen=True)
class NearOverlaps:
    threshold: float = 0.75
    n: int = 3
    rows: int = 6
    bands: int = 45
    block_rows: int = 512
    splits: Splits = field(default_factory=Splits)
    round_bands: int = 12
    round_rows: int = 1 << 18

    def classes(self, records: DataFrame) -> Stored:
        """(h, rid, grams) of each distinct canonical text with an n-gram; rid is coded as in across."""
        is_train = F.col("split") == self.splits.train
        known = records.where(F.col("h").isNotNull() & (F.char_length("text") >= self.n))
        each = known.groupBy("h").agg(F.max(is_train).alias("t"), F.max(~is_train).alias("e"), F.first("text").alias("text"))
        coded = F.monotonically_increasing_id() * 4 + F.col("t").cast("long") + 2 * F.col("e").cast("long")
        even = each.repartition(slots(records.sparkSession), "h")  # bytes say little about the cost of the hashes
        return stored(even.select("h", coded.alias("rid"), gram_hashes(F.split("text", ""), self.n).alias("grams")))

    def keys(self, classes: DataFrame, first: int, bands: int) -> DataFrame:
        """(key, rid, n, k0, k1): hashes of bands from the first on, the number of n-grams and the parities of their bins."""
        rows = self.rows

        def run(batches):
            for b in batches:
                if b.num_rows:
                    values, starts = flat(b.column("grams"))
                    symbols = min_hashes(values, starts, rows * bands, first=rows * first)
                    keys = np.stack([fold([symbols[:, j] for j in range(i * rows, (i + 1) * rows)], first + i) for i in range(bands)], axis=1)
                    each = [b.column("rid").to_numpy(), np.diff(np.r_[starts, len(values)]).astype(np.int64), *parities(values, starts)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *[pa.array(np.repeat(c, bands)) for c in each]], ["key", "rid", "n", "k0", "k1"])

        return classes.select("rid", "grams").mapInArrow(run, "key long, rid long, n long, k0 long, k1 long")

    def links(self, classes: DataFrame) -> DataFrame:
        """(a, b): two classes, one of each side, that are at least threshold alike. Checkpointed."""
        # Of x and y n-grams, alike by t or more, at most (x + y) (1 - t) / (1 + t) are not in both.
        share = (1 - self.threshold) / (1 + self.threshold)

        def wanted(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
            apart = sum(np.bitwise_count((a[i] ^ b[i]).view(np.uint64)).astype(np.int64) for i in (2, 3))
            return across(a[0], b[0]) & (apart <= (a[1] + b[1]) * share + 1e-6)

        code = lambda c, bit: F.col(c).bitwiseAND(F.lit(bit)) > 0
        apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("k0", "k1")), F.lit(0))
        sides = code("rid_a", 1) & code("rid_b", 2) | code("rid_a", 2) & code("rid_b", 1)
        step = max(self.round_bands, self.round_rows // max(1, classes.count()))
        rounds = (self.keys(classes, i, min(step, self.bands - i)) for i in range(0, self.bands, step))
        met = met_pairs(rounds, self.block_rows, ["n", "k0", "k1"], wanted, sides & (apart <= (F.col("n_a") + F.col("n_b")) * share + 1e-6))
        side = lambda s: classes.select(F.col("rid").alias(s), F.col("grams").alias(f"grams_{s}"))
        alike = similarity(F.col("grams_a"), F.col("grams_b")) >= self.threshold
        links = checkpointed(met.rows.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b"))
        met.drop()
        return links

    def _by_side(self, records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """links as (e, t) by classes, an evaluating one and a training one; and the classes' records of both sides."""
        classes = self.classes(records)
        both = self.links(classes.rows)
        turned = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("e", "t")
        linked = turned.where(F.col("e").bitwiseAND(F.lit(2)) > 0).where(F.col("t").bitwiseAND(F.lit(1)) > 0)
        evaluated, trained = self.splits.sides(records)
        own = checkpointed(classes.rows.select("h", "rid"))
        classes.drop()
        return linked, evaluated.join(own, "h"), trained.join(own, "h")

    def pairs(self, records: DataFrame) -> DataFrame:
        """(query_id_a, query_id_b): an evaluation record and a training record, alike but not equal."""
        linked, evaluated, trained = self._by_side(records)
        met = linked.join(evaluated.select(F.col("rid").alias("e"), F.col("query_id").alias("query_id_a")), "e")
        return met.join(trained.select(F.col("rid").alias("t"), F.col("query_id").alias("query_id_b")), "t").select("query_id_a", "query_id_b")

    def evaluated(self, records: DataFrame) -> DataFrame:
        """(h): hashes of evaluation records that have an alike, not equal, training record."""
        linked, evaluated, _ = self._by_side(records)
        return evaluated.join(linked.select(F.col("e").alias("rid")).distinct(), "rid", "left_semi").select("h").distinct()


@dataclass(frozen=True)
class SplitOverlaps:
    near: NearOverlaps = NearOverlaps()

    @property
    def splits(self) -> Splits:
        return self.near.splits

    @property
    def exact(self) -> ExactOverlaps:
        return ExactOverlaps(self.splits)

    def pairs(self, queries: DataFrame) -> DataFrame:
        """(query_id_a, query_id_b), a < b: one of the training split, one of an evaluation split, at least threshold alike by
        their n-grams. Texts without an n-gram are in no pair; counts has their exact matches."""
        records = self.splits.records(queries)
        equal = self.exact.pairs(records.where(F.char_length("text") >= self.near.n))
        met = equal.unionByName(self.near.pairs(records))
        return met.select(F.least("query_id_a", "query_id_b").alias("query_id_a"), F.greatest("query_id_a", "query_id_b").alias("query_id_b"))

    def judged_under_both(self, qrels: DataFrame) -> DataFrame:
        """(query_id): ids that have judgments under the training split and under an evaluation split."""
        split = label("split")
        sides = qrels.where(F.col("query_id").isNotNull()).groupBy("query_id").agg(F.max(split == self.splits.train).alias("t"), F.max(split.isin(*self.splits.evaluation)).alias("e"))
        return sides.where("t and e").select("query_id")

    def counts(self, queries: DataFrame, qrels: DataFrame) -> DataFrame:
        """(split, source, queries, exact, near, judged_under_both) of the evaluation splits: how many records there are,
        have an equal or else a nearly equal training record, and have judgments under both. Ids judged under both that are
        no evaluation record are only in judged_counts."""
        records = self.splits.records(queries)
        equal = self.exact.matches(records).select("h").distinct().withColumn("same", F.lit(1))
        near = self.near.evaluated(records).withColumn("alike", F.lit(1))
        each = records.where(F.col("split") != self.splits.train).select("query_id", "split", "source", "h")
        each = each.join(equal, "h", "left").join(near, "h", "left").join(self.judged_under_both(qrels).withColumn("judged", F.lit(1)), "query_id", "left")
        total = lambda c, name: F.count_if(c).alias(name)
        return each.groupBy("split", "source").agg(F.count(F.lit(1)).alias("queries"), total(F.col("same") == 1, "exact"), total(F.col("same").isNull() & (F.col("alike") == 1), "near"), total(F.col("judged") == 1, "judged_under_both"))

    def exact_counts(self, queries: DataFrame) -> DataFrame:
        """(split, source, exact), by the hash join alone."""
        return self.exact.counts(self.splits.records(queries))

    def judged_counts(self, queries: DataFrame, qrels: DataFrame) -> DataFrame:
        """(split, source, judged_under_both): all ids that have judgments under both, by their own split (training too) and
        source; null where queries doesn't tell."""
        own = first_delivery(queries, "query_id", strip("query_text"), {"split": label("split"), "source": label("source")}).drop("text")
        return self.judged_under_both(qrels).join(own, "query_id", "left").groupBy("split", "source").agg(F.count(F.lit(1)).alias("judged_under_both"))
