"""Groups and pairs of texts that share most of their word sequences.

Multi-index Hamming join. A text's set of hashed word n-grams becomes a signature of min-wise symbols of b = 15 bits each;
the Hamming distance of two signatures is the number of differing symbols. The symbols are split into chunks, and every way
to ignore the allowed errors of a chunk is enumerated as a lookup key over the remaining b-bit symbols, so by the pigeonhole
all pairs within the layout's distance meet under a key (signatures.Layout). A key's row carries three bits of each symbol,
in which two signatures differ at most as often as in the symbols; pairs that meet are tested on these with that same distance,
in the task that makes them, so no pair within it is refused and hardly another one passes. What passes is tested exactly on
its n-grams.

The layout follows from the threshold (signatures.layout_for): 8 chunks of 6 symbols, 3 errors each, for a likeness of 0.6,
which holds pairs that differ in up to 31 of 48 symbols; 8 chunks of 4, 1 error each, for 0.8. A pair of just the threshold's
likeness lies beyond the distance with a chance of 1.7e-4 (0.6) or 1.4e-4 (0.8); 0.05 above it with 8e-6 or 2e-6.

Texts with the same n-grams form a class, of which only the representative (the least id) is compared, so a text copied
into a third of all rows is one row of the join. Only (key, class, bits) rows are shuffled; a task reads its keys in order and
pairs the classes of one key. A key of more than block_rows classes is put aside there and joined block by block
(meetings.met_pairs); a class has many keys, so even a key that all classes share is a small part of the rows. No
pair, bucket or class is capped.

On disk lie the signatures, not the n-grams: those of the classes in a pair are made again from their texts. The keys are made
and joined round_keys of each class at a time, and what a step shuffled is removed when it ends.

Defined cases: a null id is in no pair and no group; texts with fewer words than an n-gram have no n-grams and so are in no
pair, but groups puts those of equal words into one class; texts without any word stand alone; an id delivered again counts
once, by its first delivery with a text; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_text, words
from ..operators.deliveries import first_delivery
from ..runtime import Stored, checkpointed, pairs_within_key, slots, stored
from .components import connected_components
from .meetings import met_pairs
from .signatures import Layout, columns, differences, differing, flat, gram_hashes, layout_for, min_hashes, multi_index_keys, packed, similarity, unpacked

#: Bits of each symbol that a key's row carries.
CARRIED = 3


@dataclass(frozen=True)
class NearDuplicates:
    """n words in a sequence, and the least likeness; bits of a symbol, and the chance that a pair just at the threshold
    lies beyond the signature distance; keys of a class that are joined at a time, or as many as make round_rows rows."""

    n: int = 5
    threshold: float = 0.8
    bits: int = 15
    miss: float = 2e-4
    block_rows: int = 512
    round_keys: int = 27
    round_rows: int = 1 << 18

    @property
    def layout(self) -> Layout:
        return layout_for(self.threshold, bits=self.bits, miss=self.miss)

    def _grams(self, docs: DataFrame) -> DataFrame:
        """(doc_id, grams, w) of the docs with a word: their n-grams; w has the words of those that are shorter than one."""
        texts = first_delivery(docs, "doc_id", joined_text("doc_text"), {})
        told = texts.select("doc_id", F.explode(F.array(words("text"))).alias("w")).where(F.size("w") > 0)
        return told.select("doc_id", gram_hashes(F.col("w"), self.n).alias("grams"), F.when(F.size("w") < self.n, F.col("w")).alias("w"))

    def _signed(self, sets: DataFrame) -> DataFrame:
        """sets (doc_id, x, y, grams) with the number of the grams, n, and their signature in place of them."""
        layout, names = self.layout, columns(self.layout)

        def run(batches):
            for b in batches:
                if b.num_rows:
                    values, starts = flat(b.column("grams"))
                    n = np.diff(np.r_[starts, len(values)])
                    symbols = np.zeros((b.num_rows, layout.symbols), np.uint64)
                    if n.any():
                        symbols[n > 0] = min_hashes(values, starts[n > 0], layout.symbols) & np.uint64(2**layout.bits - 1)
                    told = [b.column("doc_id"), b.column("x"), b.column("y"), pa.array(n, pa.int32())]
                    yield pa.RecordBatch.from_arrays([*told, *map(pa.array, packed(symbols, layout.bits))], ["doc_id", "x", "y", "n", *names])

        return sets.mapInArrow(run, ", ".join(["doc_id string, x long, y long, n int", *[f"{w} long" for w in names]]))

    def classes(self, docs: DataFrame) -> tuple[DataFrame, Stored]:
        """Of docs (doc_id, doc_text array): members (doc_id, rid, long), checkpointed, and classes (rid, doc_id, x, y, n, s0,
        s1, ...): a class, its least doc_id, the hash and the number of its n-grams, and their signature. Texts shorter than an
        n-gram (long is false, n is 0) form classes of equal words."""
        grams, names = self._grams(docs), columns(self.layout)
        own = F.when(F.size("grams") > 0, F.xxhash64(F.sort_array("grams"))).otherwise(F.xxhash64("w", F.lit("short")))
        more = F.when(F.size("grams") > 0, F.xxhash64(F.lit(self.n), F.sort_array("grams"), F.size("grams"))).otherwise(F.xxhash64(F.lit("short"), "w"))
        sets = stored(self._signed(grams.select("doc_id", own.alias("x"), more.alias("y"), "grams")))
        reps = sets.rows.groupBy("x", "y").agg(F.min("doc_id").alias("doc_id"), *[F.max(c).alias(c) for c in ("n", *names)])  # equal within a class
        numbered = stored(reps.repartition(slots(docs.sparkSession), "x").withColumn("rid", F.monotonically_increasing_id()))
        members = checkpointed(sets.rows.join(numbered.rows.select("x", "y", "rid"), ["x", "y"]).select("doc_id", "rid", (F.col("n") > 0).alias("long")))
        sets.drop()
        return members, numbered

    def keys(self, classes: DataFrame, which: slice) -> DataFrame:
        """(key, rid, k0, ...): some of the lookup keys of each signature, and the bits that are carried."""
        layout, names, carried = self.layout, columns(self.layout), self.carried

        def run(batches):
            for b in batches:
                if b.num_rows:
                    symbols = unpacked([b.column(w).to_numpy() for w in names], layout)
                    keys, rows = multi_index_keys(symbols, layout, which), [b.column("rid").to_numpy(), *packed(symbols & np.uint64(2**CARRIED - 1), CARRIED)]
                    for i in range(0, len(keys), 1000):  # some rows at a time, as each has many keys
                        part = keys[i : i + 1000]
                        yield pa.RecordBatch.from_arrays([pa.array(part.ravel()), *[pa.array(np.repeat(c[i : i + 1000], part.shape[1])) for c in rows]], ["key", "rid", *carried])

        return classes.where("n > 0").select("rid", *names).mapInArrow(run, ", ".join(["key long, rid long", *[f"{c} long" for c in carried]]))

    @property
    def carried(self) -> list[str]:
        return [f"k{i}" for i in range(-(-self.layout.symbols // (63 // CARRIED)))]

    def links(self, docs: DataFrame, classes: Stored) -> DataFrame:
        """(a, b, likeness) of each two classes, a < b, that are at least threshold alike; checkpointed. docs are read again
        for the n-grams of the classes that meet."""
        layout, carried = self.layout, self.carried
        if layout.bits < CARRIED:
            raise ValueError(f"symbols of fewer than {CARRIED} bits")
        within = lambda a, b: differences([*zip(a[1:], b[1:])], CARRIED) <= layout.distance
        alike = differing([(F.col(f"{c}_a"), F.col(f"{c}_b")) for c in carried], CARRIED) <= layout.distance
        step = max(self.round_keys, self.round_rows // max(1, classes.rows.count()))
        rounds = (self.keys(classes.rows, slice(i, i + step)) for i in range(0, layout.keys, step))
        met = met_pairs(rounds, self.block_rows, carried, within, alike)
        used = met.rows.select(F.col("a").alias("rid")).union(met.rows.select("b")).distinct()
        named = stored(classes.rows.select("rid", "doc_id").join(used, "rid"))
        again = docs.select("doc_id", "doc_text", "loaded_at").join(named.rows, "doc_id", "left_semi")
        grams = stored(self._grams(again).select("doc_id", "grams").join(named.rows, "doc_id").select("rid", "grams"))
        side = lambda s: grams.rows.select(F.col("rid").alias(s), F.col("grams").alias(f"grams_{s}"))
        checked = met.rows.join(side("a"), "a").join(side("b"), "b").withColumn("likeness", similarity(F.col("grams_a"), F.col("grams_b")))
        links = checkpointed(checked.where(F.col("likeness") >= self.threshold).select("a", "b", "likeness"))
        for x in (met, named, grams):
            x.drop()
        return links

    def pairs(self, docs: DataFrame) -> DataFrame:
        """(doc_id_a, doc_id_b), a < b, of every two docs that are at least threshold alike, copies included. Its size
        is that of the answer; where classes of copies are large, use groups, or links with the members."""
        every, classes = self.classes(docs)
        members = every.where("long").drop("long")
        within = pairs_within_key(members, "rid", "doc_id", []).select("doc_id_a", "doc_id_b")
        side = lambda s: members.select(F.col("rid").alias(s), F.col("doc_id").alias(f"doc_{s}"))
        links = self.links(docs, classes)
        classes.drop()
        across = links.join(side("a"), "a").join(side("b"), "b").select(F.least("doc_a", "doc_b").alias("doc_id_a"), F.greatest("doc_a", "doc_b").alias("doc_id_b"))
        return within.unionByName(across)

    def groups(self, docs: DataFrame) -> DataFrame:
        """(doc_id, group_id, copies, links) of each doc: the least doc_id of its group (its own if it has no partner), the
        docs of its class (itself included), and the other classes linked with its own."""
        members, classes = self.classes(docs)
        links = self.links(docs, classes).select("a", "b")
        classes.drop()
        roots = connected_components(links, "a", "b").select(F.col("node").alias("rid"), "root")
        degree = links.select(F.col("a").alias("rid")).union(links.select("b")).groupBy("rid").agg(F.count(F.lit(1)).alias("links"))
        per_class = members.groupBy("rid").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")).join(roots, "rid", "left").join(degree, "rid", "left")
        per_class = per_class.withColumn("root", F.coalesce("root", "rid"))
        named = per_class.join(per_class.groupBy("root").agg(F.min("least").alias("group_id")), "root")
        grouped = members.join(named.select("rid", "group_id", "copies", "links"), "rid").select(F.col("doc_id").alias("_id"), "group_id", "copies", "links")
        every = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        joined = every.join(grouped, F.col("doc_id") == F.col("_id"), "left")
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        return joined.select("doc_id", F.coalesce("group_id", "doc_id").alias("group_id"), F.coalesce("copies", one).alias("copies"), F.coalesce("links", none).alias("links"))
