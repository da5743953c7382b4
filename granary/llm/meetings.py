"""Pairs of rows that share a lookup key, in rounds, with one shuffle of (key, id, carried columns) a round.

A task reads its keys in order, a batch at a time, and holds the rows of one key, at most block_rows of them. A key with more
is put aside: its rows stream by, and its pairs are made in a second join, block by block, if there is any such key. Pairs are
tested on the carried columns where they are made, so of those that meet by chance, whose number grows with the square of the
table, none is shuffled. Each round's shuffle is removed before the next, so the disk holds a part of the keys at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import Stored, pairs_within_key, spread, stored

#: Which pairs count: of the columns [rid, *carry] of either side, one array each.
Wanted = Callable[[list[np.ndarray], list[np.ndarray]], np.ndarray]
#: Pairs that are tested at a time.
SLICE = 1 << 18


def runs_to_pairs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each two positions, the smaller first, of every run of equal keys."""
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    size = np.diff(np.r_[start, len(key)])
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in np.unique(size[size > 1]):
        first = start[size == n][:, None]
        i, j = np.triu_indices(n, 1)
        left.append((first + i).ravel())
        right.append((first + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def meeting(keys: DataFrame, block_rows: int, wanted: Wanted | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(a, b) of keys (key, rid, carry...): each two rids of a key (that are wanted), some more than once; and (key, null) for
    each key of more than block_rows rows, whose pairs are not made here."""
    names = ["rid", *carry]

    def paired(key: np.ndarray, cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        left, right = runs_to_pairs(key)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in range(0, len(left), SLICE):
            one, other = [c[left[s : s + SLICE]] for c in cols], [c[right[s : s + SLICE]] for c in cols]
            keep = one[0] != other[0]
            if wanted is not None:
                keep &= wanted(one, other)
            a.append(np.minimum(one[0][keep], other[0][keep]))
            b.append(np.maximum(one[0][keep], other[0][keep]))
        return np.concatenate(a), np.concatenate(b)

    def run(batches):
        held_key, held, hot = np.empty(0, np.int64), [np.empty(0, np.int64) for _ in names], None
        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            cols = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names)]
            if hot is not None:
                first = np.searchsorted(key, hot, side="right")
                key, cols = key[first:], [c[first:] for c in cols]
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
            size = np.diff(np.r_[start, len(key)])
            put_aside = key[start[size > block_rows]]
            if len(put_aside):
                kept = np.repeat(size <= block_rows, size)
                hot = put_aside[-1] if put_aside[-1] == key[-1] else None
                key, cols = key[kept], [c[kept] for c in cols]
            last = np.searchsorted(key, key[-1]) if len(key) and (hot is None or key[-1] > hot) else len(key)
            held_key, held = key[last:], [c[last:] for c in cols]  # its run may go on in the next batch
            a, b = paired(key[:last], [c[:last] for c in cols])
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[a, put_aside]), pa.array(np.r_[b, put_aside], mask=np.r_[np.zeros(len(b), bool), np.ones(len(put_aside), bool)])], ["a", "b"])
        a, b = paired(held_key, held)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return spread(keys.select("key", *names), "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def met_pairs(rounds: Iterable[DataFrame], block_rows: int, carry: Sequence[str], wanted: Wanted, alike: Column) -> Stored:
    """(a, b) once for each two rids that share a key (key, rid, carry...) of a round and are wanted; alike says the same as
    wanted, over rid_a, rid_b and `<carry>_a`, `<carry>_b`, where a < b."""
    parts: list[Stored] = []
    for keys in rounds:
        parts.append(stored(meeting(keys, block_rows, wanted, carry).distinct()))
        hot = parts[-1].rows.where("b is null").select(F.col("a").alias("key"))
        if hot.limit(1).count():
            pairs = pairs_within_key(keys.join(hot, "key"), "key", "rid", [*carry], on=alike, block_rows=block_rows)
            parts.append(stored(pairs.select(F.col("rid_a").alias("a"), F.col("rid_b").alias("b")).distinct()))
    met = stored(reduce(DataFrame.unionByName, [p.rows.where("b is not null") for p in parts]).distinct())
    for p in parts:
        p.drop()
    return met
