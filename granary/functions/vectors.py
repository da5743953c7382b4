"""Vector functions over array<double>, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

#: Two scores are equal within these (absolute, and relative to the second).
CLOSE_ABS, CLOSE_REL = 1e-8, 1e-5


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def normalized(v: Column) -> Column:
    """v at length 1; a zero vector stays zero."""
    return let(v.cast("array<double>"), lambda d: let(norm(d), lambda n: F.transform(d, lambda x: x / F.when(n == 0, 1.0).otherwise(n))))


def centroid(vectors: Column) -> Column:
    """The mean of an array of vectors at length 1; null of an empty one."""
    zero = F.transform(F.get(vectors, F.lit(0)), lambda x: x * 0.0)
    total = F.aggregate(vectors, zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    return normalized(let(F.size(vectors), lambda n: F.transform(total, lambda x: x / n)))


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(CLOSE_ABS) + F.lit(CLOSE_REL) * F.abs(b)


def checked_dim(v: Column, dim: int) -> Column:
    """v; the query fails if it has more than dim numbers."""
    return F.when(F.size(v) > dim, F.raise_error(F.concat(F.lit("vector of more than "), F.lit(str(dim)), F.lit(" numbers"))).cast("array<double>")).otherwise(v)


def mmr(vectors: Column, scores: Column, top_n: int = 3, weight: float = 0.7) -> Column:
    """array<struct<index, score, rank>>: maximal marginal relevance, greedily.

    The first pick has the highest score; each further one the highest weight * score - (1 - weight) * (greatest
    similarity to a pick). Going up the indices, a candidate replaces the best so far only if it is greater and not close
    to it. All in one row: state is (picked indices, their scores, greatest similarity of each candidate to a pick)."""
    state = "struct<picked:array<int>,gained:array<double>,nearest:array<double>>"
    start = F.struct(F.array().alias("picked"), F.array().alias("gained"), F.transform(scores, lambda _: F.lit(0.0)).alias("nearest")).cast(state)

    def pick(s: Column, turn: Column) -> Column:
        def gain(i: Column) -> Column:
            own = F.get(scores, i)
            return F.when(turn == 1, own).otherwise(weight * own - (1 - weight) * F.get(s["nearest"], i))

        none = F.struct(F.lit(-1).alias("i"), F.lit(0.0).alias("gain"))

        def better(best: Column, i: Column) -> Column:
            g = gain(i)
            wins = ~F.array_contains(s["picked"], i) & ((best["i"] < 0) | ((g > best["gain"]) & ~close(g, best["gain"])))
            return F.when(wins, F.struct(i.alias("i"), g.alias("gain"))).otherwise(best)

        best = F.aggregate(F.sequence(F.lit(0), F.size(scores) - 1), none, better)

        def after(b: Column) -> Column:
            def nearest(v: Column, i: Column) -> Column:
                d = dot(v, F.get(vectors, b["i"]))
                return F.when(turn == 1, d).otherwise(F.greatest(F.get(s["nearest"], i), d))

            return F.struct(F.concat(s["picked"], F.array(b["i"])).alias("picked"), F.concat(s["gained"], F.array(b["gain"])).alias("gained"), F.transform(vectors, nearest).alias("nearest"))

        return let(best, after).cast(state)

    turns = F.when(F.size(scores) > 0, F.sequence(F.lit(1), F.least(F.size(scores), F.lit(top_n)))).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(turns, start, pick)
    return let(done, lambda s: F.transform(s["picked"], lambda i, at: F.struct(i.alias("index"), F.get(s["gained"], at).alias("score"), (at + 1).alias("rank"))))
