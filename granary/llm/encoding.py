"""Token ids of every text of a corpus by a public byte-level tokenizer (bpe tells which files are honoured).

Corpus-level merge replay. The texts are split into pieces; each distinct piece of the corpus is encoded once, in
partitions of the vocabulary, by replaying the merges in rank order over an inverted index from token pair to positions
(bpe.Merges.replay). The ids return to the texts by blocks: a run of texts has numbered its distinct pieces, so one row
per distinct piece of a block is joined with the vocabulary, and the block's texts, kept as lists of those numbers, are
read after them from one sorted stream. A task holds one block's dictionary and one Arrow batch.

No text is split over tasks by content, so repeated rows, hot ids and hot texts lie as evenly as the input; a frequent
piece is one row per block, and adaptive execution splits its join.

Defined cases: a null and an empty text give an empty list; strings that look like special tokens are ordinary text;
every input row gives one row, repeated ones too; a null id stays null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed, spread, widened
from .bpe import merges


class Numbers(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def numbered_pieces(docs: DataFrame, key: str, text: str, path: str, block_chars: int) -> DataFrame:
    """(block, nr, piece, id, nrs): for each block of texts a row (nr, piece) per distinct piece and a row (id, nrs)
    per text, nrs being the numbers of its pieces in order."""
    rows = widened(docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        split, block, chars = merges(path).pieces, TaskContext.get().partitionId() << 32, 0
        known = Numbers()

        def out(before, ids, lists):
            fresh = list(islice(known, before, None))
            n, m = len(fresh), len(lists)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + m, block, np.int64)), pa.array(np.r_[np.arange(before, before + n), np.zeros(m, np.int64)].astype(np.int32), mask=np.r_[np.zeros(n, bool), np.ones(m, bool)]), pa.array(fresh + [None] * m, pa.string()),
                 pa.concat_arrays([pa.nulls(n, ids.type), ids]), pa.array([None] * n + lists, pa.list_(pa.int32()))],
                ["block", "nr", "piece", "id", "nrs"],
            )

        for b in batches:
            ids = b.column("id")
            lists, done, before = [], 0, len(known)
            for i, t in enumerate(b.column("text").to_pylist()):
                lists.append(list(map(known.__getitem__, split(t))) if t else [])
                chars += len(t or "")
                if chars >= block_chars or i + 1 == len(ids):
                    yield out(before, ids.slice(done, len(lists)), lists)
                    done, lists = i + 1, []
                    if chars >= block_chars:
                        block, chars, known = block + 1, 0, Numbers()
                    before = len(known)

    return rows.mapInArrow(run, f"block long, nr int, piece string, id {kind}, nrs array<int>")


def vocabulary_ids(pieces: DataFrame, path: str, chunk_chars: int = 4_000_000) -> DataFrame:
    """(piece, ids) of a table of distinct pieces, a partition's vocabulary at once, or chunk_chars of it if it is larger."""

    def run(batches):
        encode = merges(path).replay

        def out(words):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(encode(words), pa.list_(pa.int32()))], ["piece", "ids"])

        words, chars = [], 0
        for b in batches:
            for w in b.column("piece").to_pylist():
                words.append(w)
                chars += len(w)
                if chars >= chunk_chars:
                    yield out(words)
                    words, chars = [], 0
        if words:
            yield out(words)

    return pieces.mapInArrow(run, "piece string, ids array<int>")


class Dictionary:
    """The ids of a block's pieces, by their numbers 0, 1, ..., which come in order."""

    def __init__(self):
        self.lengths, self.values, self.starts = [np.empty(0, np.int64)], [np.empty(0, np.int32)], None

    def add(self, own: pa.Array) -> None:
        offsets = own.offsets.to_numpy()
        self.lengths.append(np.diff(offsets).astype(np.int64))
        self.values.append(own.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]])
        self.starts = None

    def read(self, nrs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of lists of numbers: the ids of all of them, one after another, and how many each list has."""
        if self.starts is None:
            self.lengths, self.values = [np.concatenate(self.lengths)], [np.concatenate(self.values)]
            self.starts = np.cumsum(self.lengths[0]) - self.lengths[0]
        offsets = nrs.offsets.to_numpy()
        pieces = nrs.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        n = self.lengths[0][pieces]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(n) else 0) + np.repeat(self.starts[pieces] - (ends - n), n)
        upto = np.r_[0, ends][offsets - offsets[0]]
        return self.values[0][at], np.diff(upto)


def _assemble(batches):
    block, known = None, Dictionary()
    for b in batches:
        if not b.num_rows:
            continue
        at, is_text = b.column("block").to_numpy(), b.column("nr").is_null().to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((at[1:] != at[:-1]) | (is_text[1:] != is_text[:-1])) + 1
        ids, values, counts = [], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for start, end in zip([0, *cuts], [*cuts, len(at)]):
            if at[start] != block:
                block, known = at[start], Dictionary()
            if is_text[start]:
                got, n = known.read(b.column("nrs").slice(start, end - start))
                ids.append(b.column("id").slice(start, end - start))
                values.append(got)
                counts.append(n)
            else:
                known.add(b.column("own").slice(start, end - start))
        offsets = np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))
        yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids) if ids else b.column("id").slice(0, 0), lists], ["id", "ids"])


def encode_corpus(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", block_chars: int = 2_000_000) -> DataFrame:
    """(key, ids): the token ids of each text by the tokenizer file at path, which every executor must have; a file that
    can't be honoured is refused here (bpe.NotHonoured)."""
    merges(path)
    table = checkpointed(numbered_pieces(docs, key, text, path, block_chars))
    own = table.where(F.col("piece").isNotNull()).select("block", "nr", "piece")
    vocabulary = vocabulary_ids(spread(own.select("piece").distinct(), "piece"), path)
    kind = table.schema["id"].dataType.simpleString()
    encoded = own.join(vocabulary, "piece").select("block", "nr", F.lit(None).cast(kind).alias("id"), F.col("ids").alias("own"), F.lit(None).cast("array<int>").alias("nrs"))
    texts = table.where(F.col("piece").isNull()).select("block", "nr", "id", F.lit(None).cast("array<int>").alias("own"), "nrs")
    ordered = spread(encoded.unionByName(texts), "block").sortWithinPartitions("block", F.col("nr").asc_nulls_last())
    return ordered.mapInArrow(_assemble, f"id {kind}, ids array<int>").withColumnRenamed("id", key)
