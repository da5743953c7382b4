"""Representative vectors of a document, as Arrow batches: unit vectors, their centroid, scores against it, and maximal
marginal relevance (functions.vectors.mmr says the same as a Catalyst expression, and serves as its test).

All vectors of a batch are normalised and scored by matrix products at once; only the greedy picks go document by document."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.vectors import CLOSE_ABS, CLOSE_REL

PICKS = "array<struct<index:int,score:double,rank:int,vector:array<double>>>"


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows / np.where(norms == 0, 1, norms)


def best(gain: list[float], picked: list[int]) -> int:
    """Going up the indices, a candidate replaces the best so far only if it is greater and not close to it."""
    at = -1
    for i, g in enumerate(gain):
        if i not in picked and (at < 0 or (g > gain[at] and abs(g - gain[at]) > CLOSE_ABS + CLOSE_REL * abs(gain[at]))):
            at = i
    return at


def picks(vectors: np.ndarray, scores: np.ndarray, top_n: int, weight: float) -> tuple[list[int], list[float]]:
    """The indices and scores of the greedy choice: first the highest score, then the highest
    weight * score - (1 - weight) * (greatest similarity to a pick)."""
    picked, gained = [], []
    gain, nearest = scores, None
    while len(picked) < min(top_n, len(scores)):
        at = best(gain.tolist(), picked)
        picked.append(at)
        gained.append(float(gain[at]))
        near = vectors @ vectors[at]
        nearest = near if nearest is None else np.maximum(nearest, near)
        gain = weight * scores - (1 - weight) * nearest
    return picked, gained


def representatives(top_n: int, weight: float, dim: int | None) -> Callable[[Column], Column]:
    """A column function array<array<double>> -> the chosen vectors, at length 1, with index, score and rank. It fails on
    vectors of different lengths in a list, and on more than dim numbers."""

    def run(column: pa.Array) -> pa.Array:
        starts = column.offsets.to_numpy()
        inner = column.values.slice(starts[0], starts[-1] - starts[0])
        ends = inner.offsets.to_numpy() if len(inner) else np.zeros(1, np.int32)
        numbers = inner.values.to_numpy(zero_copy_only=False) if len(inner) else np.empty(0)
        sizes, of_doc = np.diff(ends), np.diff(starts)
        if dim is not None and (sizes > dim).any():
            raise ValueError(f"vector of more than {dim} numbers")
        index, score, rank, vectors, lengths, counts = [], [], [], [], [], []
        at = 0
        same = len(sizes) > 0 and (sizes == sizes[0]).all()
        if same:
            unit = unit_rows(numbers[ends[0] : ends[-1]].reshape(len(sizes), -1))
            some = np.flatnonzero(of_doc)
            middle = unit_rows(np.add.reduceat(unit, (np.cumsum(of_doc) - of_doc)[some], axis=0) / of_doc[some][:, None])
            every = np.einsum("ij,ij->i", unit, np.repeat(middle, of_doc[some], axis=0))
        for n in of_doc:
            if n:
                if same:
                    u, s = unit[at : at + n], every[at : at + n]
                else:
                    if (sizes[at : at + n] != sizes[at]).any():
                        raise ValueError("vectors of one document differ in length")
                    u = unit_rows(numbers[ends[at] : ends[at + n]].reshape(n, -1))
                    s = u @ unit_rows(u.mean(0)[None])[0]
                chosen, gained = picks(u, s, top_n, weight)
                index += chosen
                score += gained
                rank += range(1, len(chosen) + 1)
                vectors.append(u[chosen].ravel())
                lengths += [u.shape[1]] * len(chosen)
                counts.append(len(chosen))
            else:
                counts.append(0)
            at += n
        offsets = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets(lengths), pa.array(np.concatenate(vectors) if vectors else np.empty(0)))
        cells = [pa.array(index, pa.int32()), pa.array(score, pa.float64()), pa.array(rank, pa.int32()), lists]
        return pa.ListArray.from_arrays(offsets(counts), pa.StructArray.from_arrays(cells, ["index", "score", "rank", "vector"]))

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, PICKS)
